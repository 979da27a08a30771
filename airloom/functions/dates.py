"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name date mark, text date format, zones, strict input format.
GRANULE_DATE = r"A(\d{4})(\d{3})"
TEXT_DATE = "MM/dd/yyyy"
SOURCE_ZONE = "UTC"
LOCAL_ZONE = "Europe/Istanbul"
STRICT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LENIENT_FORMATS = (
    STRICT_FORMAT,
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
)

# Months of each season.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}


def ordinal_date(year: Column, day_of_year: Column) -> Column:
    """Date of a day number; numbers past the year's end roll over."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day_of_year - 1)


def granule_date(path: Column) -> Column:
    """Date marked in a file path as A, year, day of year; null without a mark."""
    marked = path.rlike(GRANULE_DATE)
    year = F.regexp_extract(path, GRANULE_DATE, 1).try_cast("int")
    day = F.regexp_extract(path, GRANULE_DATE, 2).try_cast("int")
    return F.when(marked, ordinal_date(year, day))


def to_local(ts: Column, source: str = SOURCE_ZONE, target: str = LOCAL_ZONE) -> Column:
    """Zone-less timestamp shifted from one zone's wall clock to another's."""
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def parse_timestamp(text: Column, formats: Sequence[str] = LENIENT_FORMATS) -> Column:
    """First format that reads the text; null if none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def date_text(date: Column) -> Column:
    return F.date_format(date, TEXT_DATE)


def season(date: Column) -> Column:
    month = F.month(date)
    out = None
    for name, months in SEASON_MONTHS.items():
        test = month.isin(*months)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def date_parts(date: Column) -> list[Column]:
    return [
        F.year(date).alias("Year"),
        F.month(date).alias("Month"),
        F.dayofmonth(date).alias("Day"),
    ]
