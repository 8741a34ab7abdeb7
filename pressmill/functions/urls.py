"""URL helpers: L2, L4, L6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""

    def add(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(
                segment == "..",
                F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))),
            )
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(path, "/", -1)
    # A final dot segment names a directory: keep its slash.
    closed = F.when(
        path.rlike(r"/\.\.?\z"), F.concat(segments, F.array(F.lit("")))
    ).otherwise(segments)
    resolved = F.array_join(
        F.aggregate(closed, F.array().cast("array<string>"), add), "/"
    )
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), resolved).otherwise(path)


def resolve_url(href: Column, base: Column) -> Column:
    """L2: the absolute form of ``href`` found on the page at ``base``."""
    origin = F.regexp_extract(base, _ORIGIN, 1)
    no_fragment = F.regexp_replace(base, r"#.*", "")
    page = F.regexp_replace(no_fragment, r"\?.*", "")
    path = F.regexp_replace(page, _ORIGIN, "")
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    wanted = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]*:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, _without_dots(wanted), rest))
        .when(href == "", no_fragment)
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, wanted)), rest))
    )


def host_of(url: Column) -> Column:
    """Lower-case host, NULL if the URL cannot be read."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def domain_of(host: Column, domains: tuple[str, ...]) -> Column:
    """L4: the one of ``domains`` that ``host`` equals or lies below, else empty."""
    listed = "|".join(d.replace(".", r"\.") for d in sorted(domains, key=len, reverse=True))
    return F.regexp_extract(host, rf"(?:^|\.)({listed})\z", 1)


def host_in(host: Column, domains: tuple[str, ...]) -> Column:
    """L4: host equals one of ``domains`` or lies below it."""
    return domain_of(host, domains) != ""


def url_date(url: Column) -> Column:
    """The first ``yyyy/MM/dd`` in a URL, NULL if there is none."""
    return F.try_to_timestamp(
        F.regexp_extract(url, r"\d{4}/\d{2}/\d{2}", 0), F.lit("yyyy/MM/dd")
    ).cast("date")


def url_year(url: Column) -> Column:
    """First four digits in a link as a year, NULL if there are none."""
    return F.regexp_extract(url, r"\d{4}", 0).try_cast("int")
