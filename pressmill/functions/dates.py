"""Publication dates: E5-E8. Zone names on pages are literals, never converted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import strip

# Text removed from a date line before it is parsed.
_UPI_NOISE = r"(?d).*\s{2,3}?|.* Updated|Updated?"
_VOA_NOISE = r"(?d).*\s{2,3}?|.* updated on:|Updated?"

# The date formats of each source, most usual first. The bars are put
# in by the clean-up below, so that only a whole date line fits.
FORMATS = {
    "AP": ("MMM. d, yyyy",),
    "BBC": ("d MMMM yyyy",),
    "BBC old": ("H:m 'GMT|'d MMMM yyyy",),
    "Reuters": ("MMM d, yyyy h:ma'|'",),
    "UPI": ("MMMM d, yyyy h:m a", "MMM. d, yyyy h:m a"),
    "VOA": ("MMMM d, yyyy H:m'|'",),
    "XNA": ("yyyy-M-d H:m:s",),
}
_WEEKDAY = "(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day"
_WEEKDAY_SHORT = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"


def clean_date_text(c: Column, source: str) -> Column:
    """E5: what is left of a date line once labels, weekday and zone are gone.

    ``source`` is a key of :data:`FORMATS`. Runs of whitespace become one space,
    because the formats match exactly one.
    """
    if source == "UPI":
        c = F.replace(strip(F.replace(strip(c), F.lit("|"))), F.lit(" at "), F.lit(" "))
        c = F.regexp_replace(c, _UPI_NOISE, "")
    elif source == "VOA":
        c = F.regexp_replace(strip(c), _VOA_NOISE, "")
    c = F.regexp_replace(strip(c), r"\s+", " ")
    if source == "BBC old":
        # A second clock may follow the date: its first six words are enough.
        c = F.regexp_replace(c, rf"(?i)^(\S+ GMT), {_WEEKDAY}, (\S+ \S+ \S+)(?: .*)?$", "$1|$2")
    elif source == "Reuters":
        c = F.regexp_replace(c, rf"(?i)^{_WEEKDAY_SHORT} (.*) E[DS]T$", "$1|")
    elif source == "VOA":
        # The clock is a 24 hour one, so AM or PM says nothing.
        c = F.regexp_replace(c, r"(?i) [AP]M$", "|")
    return c


def parse_date(c: Column, source: str) -> Column:
    """The timestamp in a cleaned date text, NULL if its format does not fit.

    Only the abbreviated month of the second format ends in a full stop, so the
    text says which format to use; failing on the first would cost far more.
    """
    first, *more = FORMATS[source]
    parsed = F.try_to_timestamp(c, F.lit(first))
    for other in more:
        plain = F.regexp_replace(F.replace(c, F.lit("Sept."), F.lit("Sep.")), r"[^\x00-\x7F]+", "")
        parsed = F.when(F.contains(c, F.lit(".")), F.try_to_timestamp(plain, F.lit(other))).otherwise(
            parsed
        )
    return parsed


def render_date(ts: Column, date_format: str) -> Column:
    """The date as stored text."""
    return F.date_format(ts, date_format)


def scraped_at(ts: Column | None = None) -> Column:
    """Time of extraction as UTC text; pass the fetch time if there is one."""
    return F.date_format(
        F.to_utc_timestamp(F.current_timestamp() if ts is None else ts, F.current_timezone()),
        "yyyy-MM-dd HH:mm:ss",
    )
