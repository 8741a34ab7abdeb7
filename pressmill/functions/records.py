"""Output lines: O4-O6. Each is one value for the text writer, which ends it with a
newline, so a record's last, blank line comes from the empty final part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_id(date: Column, source: Column, article_no: Column, sentence_no: Column) -> Column:
    """``<date> <source>-<7 digits or more>-<n>``."""
    return F.format_string("%s %s-%07d-%d", date, source, article_no, sentence_no)


def sentence_record(rid: Column, sentence: Column) -> Column:
    """Id, sentence without line breaks, blank line."""
    return F.concat_ws("\n", rid, F.replace(sentence, F.lit("\n")), F.lit(""))


def index_line(rid: Column, title: Column, url: Column) -> Column:
    """Id, quoted title, URL on one line."""
    quoted = F.replace(title, F.lit("'"), F.lit("\\'"))
    quoted = F.replace(F.replace(quoted, F.lit("- Xinhua ")), F.lit("\n"))
    return F.concat(rid, F.lit(" '"), quoted, F.lit("' "), url)
