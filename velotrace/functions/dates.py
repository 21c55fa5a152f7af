"""Day spellings: YYYY/MM/DD in object paths, YYYY-MM-DD in folders, YYYYMMDD in file names."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """The day a text names in any of the three spellings, or null."""
    digits = F.regexp_replace(text, "[/-]", "")
    shaped = F.when(digits.rlike("^[0-9]{8}$"), digits)
    return F.to_date(F.try_to_timestamp(shaped, F.lit("yyyyMMdd")))


def is_day(text: Column) -> Column:
    return F.coalesce(parse_day(text).isNotNull(), F.lit(False))


def slash_day(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def dash_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def compact_day(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def epoch_day(seconds: Column) -> Column:
    """The UTC day of an instant in Unix seconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def day_of_path(path: Column) -> Column:
    """The day in ``.../YYYY/MM/DD/<file>``, or null."""
    found = F.regexp_extract(path, r"(?:^|/)([0-9]{4}/[0-9]{1,2}/[0-9]{1,2})/[^/]+$", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy/M/d")))


def as_day(text: str) -> date:
    """A day given on the driver; raises ValueError if it is not one."""
    digits = text.replace("/", "").replace("-", "")
    if len(digits) != 8 or not (digits.isascii() and digits.isdigit()):
        raise ValueError(f"not a day: {text!r}")
    return datetime.strptime(digits, "%Y%m%d").date()


def today(as_of: datetime | None = None) -> date:
    return (as_of or datetime.now(timezone.utc)).date()


def yesterday(as_of: datetime | None = None) -> date:
    return today(as_of) - timedelta(days=1)
