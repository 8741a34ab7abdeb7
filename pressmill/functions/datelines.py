"""Agency datelines cut from article bodies: E17, E18, E20."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import space_out, strip

# What separates the dateline from the story.
UPI_MARK = "(UPI) --"
XNA_MARK = "--"
REUTERS_MARK = "(Reuters) -"


def _split(c: Column, mark: str) -> Column:
    return F.split(c, rf"\Q{mark}\E", -1)


def _after_first(parts: Column) -> Column:
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "")


def cut_upi(c: Column) -> Column:
    """Text after the first marker, further markers dropped; no marker, no text."""
    return space_out(strip(_after_first(_split(c, UPI_MARK))))


def cut_xna(c: Column) -> Column:
    """Text between the first two dashes; without any, all of it as it is."""
    return F.coalesce(space_out(strip(F.get(_split(c, XNA_MARK), F.lit(1)))), c)


def cut_reuters(c: Column) -> Column:
    """Text after a single marker. Several markers leave the text in place and
    repeat what follows the first; none leaves it unchanged."""
    parts = _split(c, REUTERS_MARK)
    return (
        F.when(F.size(parts) == 2, F.get(parts, F.lit(1)))
        .when(F.size(parts) > 2, F.concat(c, _after_first(parts)))
        .otherwise(c)
    )


def has_keyword(c: Column, keywords: tuple[str, ...]) -> Column:
    """Any keyword occurs in the text, case-sensitive."""
    if not keywords:
        return F.lit(False)
    found = F.contains(c, F.lit(keywords[0]))
    for k in keywords[1:]:
        found = found | F.contains(c, F.lit(k))
    return found
