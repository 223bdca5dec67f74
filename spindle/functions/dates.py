"""Date parsing and parts (SCL-01, SCL-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the original data's date text layout, month/day/4-digit year with
# one- or two-digit month and day.
US_DATE_PATTERN = "M/d/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_us_date(x, strict: bool = False) -> Column:
    """SCL-01: ``MM/dd/yyyy`` (``1/2/2015`` too) -> date.

    Bad or null text gives null (so a later year filter drops the row);
    ``strict=True`` raises on bad text like the original job."""
    x = _col(x)
    if strict:
        return F.to_date(x, US_DATE_PATTERN)
    return F.try_to_date(x, US_DATE_PATTERN)


def format_us_date(d) -> Column:
    return F.date_format(_col(d), "MM/dd/yyyy")


def date_parts(d, prefix: str = "") -> dict[str, Column]:
    """SCL-02: day of week (Sunday = 1), month, year as columns."""
    d = _col(d)
    return {
        f"{prefix}day": F.dayofweek(d),
        f"{prefix}month": F.month(d),
        f"{prefix}year": F.year(d),
    }
