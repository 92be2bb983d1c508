"""Exchange sessions, closed / finished rules, forward as-of lookups and weekday plans.

A calendar has one row per session: ``date, first_bar_ts, last_bar_ts, bar_count_int``. Holidays and
early closes are inputs (``date`` / ``date, close_time``); no exchange rule is built in.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from candlewright.functions import times as T

# Session hours, closing rules and download limits.
OPEN_TIME = "09:30"
CLOSE_TIME = "16:00"
CLOSE_BUFFER_MINUTES = 5
FINISHED_TIME = "17:00:00"
QUERY_SPAN_DAYS = 8
QUERY_AGE_DAYS = 30

# A calendar is broadcast only while its day span proves it small (one short row per day).
MAX_BROADCAST_DAYS = 100_000


def _as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def days(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    """One row per calendar day, both ends included."""
    start, end = _as_date(first), _as_date(last)
    count = max((end - start).days + 1, 0)
    return spark.range(count, numPartitions=1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")
    )


def weekdays(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    return days(spark, first, last).where(F.weekday("date") < 5)


def small(frame: DataFrame, first: str | date, last: str | date) -> DataFrame:
    span = (_as_date(last) - _as_date(first)).days
    return F.broadcast(frame) if span <= MAX_BROADCAST_DAYS else frame


def sessions(
    spark: SparkSession,
    first: str | date,
    last: str | date,
    holidays: DataFrame | None = None,
    early_closes: DataFrame | None = None,
    open_time: str = OPEN_TIME,
    close_time: str = CLOSE_TIME,
    step_seconds: int = 60,
    every_day: bool = False,
) -> DataFrame:
    """Weekdays that are not holidays, with their first and last bar and the expected bar count."""
    frame = days(spark, first, last) if every_day else weekdays(spark, first, last)
    # The input frames carry no size promise, so Spark picks their join from their statistics.
    if holidays is not None:
        frame = frame.join(holidays.select("date"), "date", "left_anti")
    if early_closes is not None:
        early = early_closes.groupBy("date").agg(F.min("close_time").alias("close_time"))
        frame = frame.join(early, "date", "left").withColumn("close_time", F.coalesce("close_time", F.lit(close_time)))
    else:
        frame = frame.withColumn("close_time", F.lit(close_time))
    day = F.date_format("date", "yyyy-MM-dd")
    opening = T.from_wall(F.concat(day, F.lit(f" {open_time}:00")))
    # "24:00" closes a round-the-clock session at the next midnight.
    closing = T.from_wall(
        F.when(F.col("close_time") == "24:00", F.concat(F.date_format(F.date_add("date", 1), "yyyy-MM-dd"), F.lit(" 00:00:00")))
        .otherwise(F.concat(day, F.lit(" "), F.col("close_time"), F.lit(":00")))
    )
    step = step_seconds * T.MICROS_PER_SECOND
    frame = frame.select("date", opening.alias("first_bar_ts"), T.plus_micros(closing, -step).alias("last_bar_ts"))
    bars = F.floor((T.micros(F.col("last_bar_ts")) - T.micros(F.col("first_bar_ts"))) / F.lit(step)) + 1
    return small(frame.withColumn("bar_count_int", bars.cast("int")), first, last)


def session_minutes(calendar: DataFrame, step_seconds: int = 60) -> DataFrame:
    """Every expected bar start of every session."""
    grid = F.expr(f"sequence(first_bar_ts, last_bar_ts, interval {int(step_seconds)} seconds)")
    return calendar.select("date", F.explode(grid).alias("ts"))


def is_closed(now: Column, buffer_minutes: int = CLOSE_BUFFER_MINUTES, step_seconds: int = 60) -> Column:
    wait = (step_seconds + 60 * buffer_minutes) * T.MICROS_PER_SECOND
    return T.plus_micros(F.col("last_bar_ts"), wait) <= now


def closed_sessions(calendar: DataFrame, now: Column, buffer_minutes: int = CLOSE_BUFFER_MINUTES, step_seconds: int = 60) -> DataFrame:
    return calendar.where(is_closed(now, buffer_minutes, step_seconds))


def last_closed_session(calendar: DataFrame, now: Column) -> DataFrame:
    return closed_sessions(calendar, now).agg(F.max("date").alias("date"))


def is_finished(now: Column, done_time: str = FINISHED_TIME) -> Column:
    today = T.wall_date(now)
    done = F.date_format(T.wall(now), "HH:mm:ss") >= done_time
    return (F.col("date") < today) | ((F.col("date") == today) & done)


def finished_sessions(calendar: DataFrame, now: Column, done_time: str = FINISHED_TIME) -> DataFrame:
    return calendar.where(is_finished(now, done_time))


def split_requested(wanted: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Explicit dates -> (their sessions, the dates that are not sessions)."""
    dates = wanted.select("date").distinct()
    return calendar.join(dates, "date", "left_semi"), dates.join(calendar.select("date"), "date", "left_anti")


def next_session_lookup(calendar: DataFrame, first: str | date, last: str | date, within_days: int = 10) -> DataFrame:
    """``date -> next_date``: the first session on or after every day, at most ``within_days`` later.

    Each session owns the days after the previous session, so the as-of join of any table becomes
    an equi-join on the date with this lookup of at most one row per day of the span.
    """
    # The window runs over the calendar itself, one short row per session.
    ordered = calendar.withColumn("previous", F.lag("date").over(W.orderBy("date")))
    earliest = F.date_sub("date", within_days)
    owned = F.sequence(F.greatest(F.coalesce(F.date_add("previous", 1), earliest), earliest), F.col("date"))
    lookup = ordered.select(
        F.col("date").alias("next_date"), F.col("first_bar_ts").alias("next_first_bar_ts"), F.explode(owned).alias("date")
    )
    return small(lookup.where(F.col("date").between(F.lit(_as_date(first)), F.lit(_as_date(last)))), first, last)


def with_next_session(frame: DataFrame, lookup: DataFrame, date_column: str = "date") -> DataFrame:
    renamed = lookup.withColumnRenamed("date", date_column)
    return frame.join(renamed, date_column, "left")


def with_market_status(frame: DataFrame, calendar: DataFrame, lookup: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds today's session, whether it is open, the next open and the seconds to open / close."""
    now = F.col(ts)
    today = calendar.select(
        F.col("date").alias("_today"), F.col("first_bar_ts").alias("_open"), F.col("last_bar_ts").alias("_last")
    )
    # After today's open the next open is the first one from tomorrow on.
    upcoming = lookup.select(F.col("date").alias("_tomorrow"), F.col("next_first_bar_ts").alias("_next"))
    minute = 60 * T.MICROS_PER_SECOND
    joined = (
        frame.withColumn("_today", T.wall_date(now))
        .withColumn("_tomorrow", F.date_add("_today", 1))
        .join(today, "_today", "left")
        .join(upcoming, "_tomorrow", "left")
    )
    market_open = F.coalesce((F.col("_open") <= now) & (now < T.plus_micros(F.col("_last"), minute)), F.lit(False))
    next_open = F.when(F.col("_open") > now, F.col("_open")).otherwise(F.col("_next"))
    seconds = lambda later: F.floor((T.micros(later) - T.micros(now)) / F.lit(T.MICROS_PER_SECOND))
    return (
        joined.withColumn("session_today_bool", F.col("_open").isNotNull())
        .withColumn("market_open_bool", market_open)
        .withColumn("first_bar_ts", F.col("_open"))
        .withColumn("last_bar_ts", F.col("_last"))
        .withColumn("next_first_bar_ts", next_open)
        .withColumn(
            "seconds_until_open_int",
            F.when(next_open.isNotNull() & ~F.col("market_open_bool"), seconds(next_open)).otherwise(F.lit(0)),
        )
        .withColumn(
            "seconds_until_close_int",
            F.when(F.col("market_open_bool"), seconds(T.plus_micros(F.col("_last"), minute))).otherwise(F.lit(0)),
        )
        .drop("_today", "_tomorrow", "_open", "_last", "_next")
    )


def weekday_minutes(dates: DataFrame, first_time: str = "09:30", last_time: str = "15:59") -> DataFrame:
    """Trading minutes (wall clock) of the weekdays of a date frame."""
    day = F.date_format("date", "yyyy-MM-dd")
    start = F.concat(day, F.lit(f" {first_time}:00")).cast("timestamp")
    end = F.concat(day, F.lit(f" {last_time}:00")).cast("timestamp")
    return dates.where(F.weekday("date") < 5).select(
        "date", F.explode(F.sequence(start, end, F.expr("interval 1 minute"))).alias("minute")
    )


def work_week(day: Column) -> tuple[Column, Column]:
    """Monday and Friday of the week of a date."""
    monday = F.to_date(F.date_trunc("week", day))
    return monday, F.date_add(monday, 4)


def range_is_valid(first: Column, last: Column, now: Column) -> Column:
    """Not empty, at most eight days, and every day younger than thirty days."""
    limit = F.date_sub(T.wall_date(now), QUERY_AGE_DAYS)
    span = F.datediff(last, first) + 1
    return (span >= 1) & (span <= QUERY_SPAN_DAYS) & (first > limit)


def _trading_minutes_between(start: Column, end: Column) -> Column:
    """Number of one-minute steps from ``start`` up to ``end`` that fall in weekday trading minutes.

    Both are wall clocks. The steps keep the seconds of ``start``, as a minute range does.
    """
    minute = 60 * T.MICROS_PER_SECOND
    day_span = F.sequence(F.to_date(start), F.to_date(end))
    weekdays_only = F.filter(day_span, lambda d: F.weekday(d) < 5)

    def steps(day: Column) -> Column:
        midnight = T.micros(day.cast("timestamp"))
        low = F.greatest(midnight + F.lit((9 * 60 + 30) * minute), T.micros(start))
        high = F.least(midnight + F.lit((15 * 60 + 59) * minute), T.micros(end))
        first_step = F.ceil((low - T.micros(start)) / F.lit(minute))
        last_step = F.floor((high - T.micros(start)) / F.lit(minute))
        return F.greatest(last_step - first_step + 1, F.lit(0)).cast("bigint")

    return F.aggregate(weekdays_only, F.lit(0).cast("bigint"), lambda total, d: total + steps(d))


def weekly_load_plan(series: DataFrame, loaded_weeks: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Mon-Fri ranges to request after the last loaded bar of every series.

    ``series`` holds ``keys`` and ``last_ts`` (instant). Every weekday between the last bar and now
    gives its week; a range is reported with whether it is allowed and whether it is already loaded
    (``loaded_weeks``: ``keys, week``). A series without new trading minutes gives no row.
    """
    start, end = T.wall(F.col("last_ts")), T.wall(now)
    day = 24 * 3600 * T.MICROS_PER_SECOND
    whole_days = F.floor((T.micros(end) - T.micros(start)) / F.lit(day)).cast("int")
    span = F.filter(
        F.sequence(F.to_date(start), F.date_add(F.to_date(start), F.greatest(whole_days, F.lit(0)))),
        lambda d: F.weekday(d) < 5,
    )
    mondays = F.array_distinct(F.transform(span, lambda d: F.to_date(F.date_trunc("week", d))))
    active = series.where(F.col("last_ts") <= now).where(_trading_minutes_between(start, end) > 1)
    weeks = active.select(*keys, F.explode(mondays).alias("first_date"))
    weeks = weeks.withColumn("last_date", F.date_add("first_date", 4)).withColumn(
        "week", F.concat(F.date_format("first_date", "yyyyMMdd"), F.lit("-"), F.date_format("last_date", "yyyyMMdd"))
    )
    known = loaded_weeks.select(*keys, "week").distinct().withColumn("loaded", F.lit(True))
    return weeks.join(known, [*keys, "week"], "left").select(
        *keys,
        "week",
        "first_date",
        "last_date",
        range_is_valid(F.col("first_date"), F.col("last_date"), now).alias("valid"),
        F.coalesce("loaded", F.lit(False)).alias("loaded"),
    )
