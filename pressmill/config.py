"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobConfig:
    """What a run can choose.

    ``start`` and ``end`` are inclusive ISO dates. ``batch`` names the columns
    within which article numbers restart: one source and one search.
    """

    keywords: tuple[str, ...] = ()
    start: str = "1900-01-01"
    end: str = "2999-12-31"
    date_format: str = "yyyyMMdd"
    batch: tuple[str, ...] = ("source", "query")

    @property
    def years(self) -> tuple[int, int]:
        return int(self.start[:4]), int(self.end[:4])
