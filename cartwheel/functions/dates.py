"""Date and timestamp column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four export date layouts, tried in this order; the first that parses
# wins. Single letters accept one- or two-digit day and month, as strptime does.
EXPORT_DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "M-d-yyyy", "yyyy/M/d"]

CLICK_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def month_bucket(c: Column | str) -> Column:
    """'yyyy-MM' text of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")


def elapsed_whole_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed days, as CAST(julianday(a) - julianday(b) AS INT) for a >= b.

    ``datediff`` counts midnights, which differs for times of day.
    """
    return ((F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 86400).cast("bigint")


def parse_first_format(c: Column, formats: list[str] = EXPORT_DATE_FORMATS) -> Column:
    """First format that parses, else NULL (F4, G1), with no Python per row."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def parse_fixed(c: Column, fmt: str = CLICK_TS_FORMAT) -> Column:
    """Fixed-layout parse; bad text becomes NULL with ANSI mode left on."""
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_iso_utc(c: Column) -> Column:
    """ISO-8601 text (optional zone suffix) to a UTC timestamp; bad text to NULL."""
    return c.try_cast("timestamp")


def date_key(c: Column | str) -> Column:
    """yyyymmdd as BIGINT."""
    return F.date_format(c, "yyyyMMdd").cast("bigint")
