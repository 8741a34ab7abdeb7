"""Per-source article rules on raw text: F1-F9.

Word boundaries are spelled out as ASCII look-arounds, since Java's ``\\b`` counts
accented letters as word characters and the rules must not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words and title openings that rule an article out.
REUTERS_URL_WORDS = ("MW", "BW")
REUTERS_CONTENT_WORDS = ("PRNewswire", "(Reuters Life!)")
REUTERS_TITLE_WORDS = ("UPDATE", "REFILE")
REUTERS_TITLE_OPENINGS = ("REG ", "RCS ", "DIARY")
UPI_WORDS = ("COL", "NBA ", "NHL", "MLB", "NFL", "Nadal", "UPI NewsTrack")
XNA_TITLE_OPENING = "FLASH:"
BBC_TITLE_PART = "World News for Schools"
BBC_URL_PART = "magazine"

_WORD = "A-Za-z0-9_"


def _is_word_char(ch: str) -> bool:
    return ch.isascii() and (ch.isalnum() or ch == "_")


def _bounded(word: str) -> str:
    """``word``, a pattern, with an ASCII word boundary on both sides.

    The boundary depends on the outermost character the pattern matches; brackets
    around it only group.
    """
    seen = word.strip("()")
    left = f"(?<![{_WORD}])" if _is_word_char(seen[0]) else f"(?<=[{_WORD}])"
    right = f"(?![{_WORD}])" if _is_word_char(seen[-1]) else f"(?=[{_WORD}])"
    return f"{left}{word}{right}"


def has_word(c: Column, *words: str) -> Column:
    """any of ``words`` as a whole word, case-sensitive. Words are patterns.

    Most texts hold none of them, and a plain search finds that out far sooner than
    the pattern does.
    """
    tests = [F.contains(c, F.lit(w.strip("()"))) & c.rlike(_bounded(w)) for w in words]
    return reduce(lambda a, b: a | b, tests)


def _opens_with(c: Column, openings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(o) for o in openings])


def reject_rule(source: Column, url: Column, title: Column, content: Column) -> Column:
    """Name of the first rule that drops the article, NULL if it is kept."""
    rules = [
        ("Reuters", "reuters_url", lambda: has_word(url, *REUTERS_URL_WORDS)),
        ("Reuters", "reuters_content", lambda: has_word(content, *REUTERS_CONTENT_WORDS)),
        (
            "Reuters",
            "reuters_title",
            lambda: has_word(title, *REUTERS_TITLE_WORDS) | _opens_with(title, REUTERS_TITLE_OPENINGS),
        ),
        ("UPI", "upi_words", lambda: has_word(title, *UPI_WORDS) | has_word(content, *UPI_WORDS)),
        ("XNA", "xna_flash", lambda: F.upper(title).startswith(XNA_TITLE_OPENING)),
        (
            "BBC",
            "bbc_section",
            lambda: F.contains(title, F.lit(BBC_TITLE_PART)) | F.contains(url, F.lit(BBC_URL_PART)),
        ),
    ]
    first, *rest = [((source == s) & test(), F.lit(name)) for s, name, test in rules]
    return reduce(lambda c, rule: c.when(*rule), rest, F.when(*first))


def is_kept(source: Column, url: Column, title: Column, content: Column) -> Column:
    """True if no rule drops the article; sources without rules always pass."""
    return reject_rule(source, url, title, content).isNull()
