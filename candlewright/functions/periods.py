"""Names of day, month and year periods (``YYYYMMDD`` / ``YYYYMM`` / ``YYYY``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The file name format of the bar files and the kind of each period length.
FILE_PREFIX = "ohlcv_data"
FILE_NAME_PATTERN = r"^ohlcv_data_(\d{4}(?:\d{2}(?:\d{2})?)?)\.csv$"
PERIOD_KINDS = {4: "year", 6: "month", 8: "day"}


def file_name(period: Column) -> Column:
    return F.concat(F.lit(f"{FILE_PREFIX}_"), period, F.lit(".csv"))


def period_of_file(name: Column) -> Column:
    """Period inside a file name; null when it is not a bar file."""
    found = F.regexp_extract(name, FILE_NAME_PATTERN, 1)
    return F.when(found != "", found)


def period_kind(period: Column) -> Column:
    size = F.length(period)
    kind = F.lit(None).cast("string")
    for length, name in PERIOD_KINDS.items():
        kind = F.when(size == length, F.lit(name)).otherwise(kind)
    return kind


def first_date(period: Column) -> Column:
    padded = F.concat(period, F.substring(F.lit("0101"), F.length(period) - 3, F.lit(4)))
    return F.to_date(F.try_to_timestamp(padded, F.lit("yyyyMMdd")))


def last_date(period: Column) -> Column:
    start = first_date(period)
    return (
        F.when(F.length(period) == 4, F.make_date(F.year(start), F.lit(12), F.lit(31)))
        .when(F.length(period) == 6, F.last_day(start))
        .otherwise(start)
    )


def period_for_date(day: Column, now: Column) -> Column:
    """Past years -> year, past months of this year -> month, everything else -> day."""
    return (
        F.when(F.year(day) < F.year(now), F.date_format(day, "yyyy"))
        .when((F.year(day) == F.year(now)) & (F.month(day) < F.month(now)), F.date_format(day, "yyyyMM"))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )


def organized_period(period: Column, now: Column) -> Column:
    """Where a file belongs. A file only ever moves to a longer span, never to a shorter one."""
    target = period_for_date(first_date(period), now)
    return F.when(F.length(target) < F.length(period), target).otherwise(period)
