"""Shaping of the typed zone tables: column names, Monday-Friday weeks and the timezone pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.functions import times as T
from candlewright.operators import calendar as C
from candlewright.session import NEW_YORK

QATAR = "Asia/Qatar"
ZONES = {"ny": NEW_YORK, "qatar": QATAR}
TIME_COLUMN = "ny_timestamp"
ZONE_COLUMNS = ["ny_timestamp", "open", "high", "low", "close", "volume", "stock_splits"]


def canonical_columns(frame: DataFrame) -> DataFrame:
    """Lower-case names with underscores, the date column as ``ny_timestamp``, no dividends.

    A zoned timestamp becomes New York wall clock; a clock without a zone stays as it is.
    """
    if "timestamp" in frame.columns:
        return frame
    named = frame.toDF(*[c.lower().replace(" ", "_") for c in frame.columns])
    for name in ("date", "datetime"):
        if name in named.columns:
            named = named.withColumnRenamed(name, TIME_COLUMN)
    kind = dict(named.dtypes)[TIME_COLUMN]
    if kind == "timestamp":
        named = named.withColumn(TIME_COLUMN, T.wall(F.col(TIME_COLUMN)))
    return named.withColumn(TIME_COLUMN, F.col(TIME_COLUMN).cast("timestamp_ntz")).drop("dividends")


def week_label(day: Column) -> Column:
    monday, friday = C.work_week(day)
    return F.concat(F.date_format(monday, "yyyyMMdd"), F.lit("-"), F.date_format(friday, "yyyyMMdd"))


def week_slices(frame: DataFrame, time_column: str = TIME_COLUMN) -> DataFrame:
    """Rows of Monday 09:30 to Friday 15:59 (weeknights included) with their week label.

    A ``..._unix`` column holds epoch seconds and is read on the clock of its zone.
    """
    if "unix" in time_column:
        local = T.epoch_to_wall(F.col(time_column), ZONES[time_column.split("_")[0]])
    else:
        local = F.col(time_column).cast("timestamp")
    monday, friday = C.work_week(F.to_date(local))
    start = F.concat(F.date_format(monday, "yyyy-MM-dd"), F.lit(" 09:30:00")).cast("timestamp")
    end = F.concat(F.date_format(friday, "yyyy-MM-dd"), F.lit(" 15:59:00")).cast("timestamp")
    return frame.where(local.between(start, end)).withColumn("week", week_label(F.to_date(local)))


def tz_pair(frame: DataFrame, time_column: str = TIME_COLUMN, current: str = "ny") -> DataFrame:
    """The same instant on the Qatar and the New York clock, as the first two columns."""
    if current not in ZONES:
        raise ValueError("current must be 'ny' or 'qatar'")
    other = "qatar" if current == "ny" else "ny"
    local = F.col(time_column).cast("timestamp_ntz")
    converted = F.convert_timezone(F.lit(ZONES[current]), F.lit(ZONES[other]), local)
    clocks = {current: local, other: converted}
    rest = [c for c in frame.columns if "timestamp" not in c and c != time_column]
    return frame.select(clocks["qatar"].alias("qatar_timestamp"), clocks["ny"].alias("ny_timestamp"), *rest)


def work_zone(frame: DataFrame) -> DataFrame:
    return tz_pair(frame).select("qatar_timestamp", *ZONE_COLUMNS)


def loaded_weeks(file_names: DataFrame, prefix: str, column: str = "file_name_str") -> DataFrame:
    """Week ranges that already have a file, from the names alone."""
    text = F.regexp_extract(F.col(column), f"{prefix}(\\d{{8}}-\\d{{8}})\\.csv$", 1)
    return file_names.select(text.alias("week")).where(F.col("week") != "").distinct()


def required_ranges(wanted: DataFrame, loaded: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return wanted.join(loaded, [*(keys or []), "week"], "left_anti")
