"""What is present, what is missing, and what to load next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from candlewright.functions import periods as P, times as T
from candlewright.operators import calendar as C

LOOK_BACK_DAYS = 400
YEAR_END_MARGIN_DAYS = 3
NOTHING_RECENT = "nothing present in the look-back window: give a first date"


def present_dates(bars: DataFrame, first: str | None = None, last: str | None = None, catalog: DataFrame | None = None) -> DataFrame:
    """Distinct (symbol, date) with at least one bar.

    Bars need ``symbol`` and ``date`` or ``ts``. Day periods of a ``catalog`` (``symbol, period_str``)
    count by name alone and are not read.
    """
    rows = bars if "date" in bars.columns else bars.withColumn("date", T.wall_date(F.col("ts")))
    dates = rows.select("symbol", "date")
    if catalog is not None:
        named = catalog.where(F.length("period_str") == 8)
        dates = dates.unionByName(named.select("symbol", P.first_date(F.col("period_str")).alias("date")))
    if first is not None:
        dates = dates.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        dates = dates.where(F.col("date") <= F.lit(last).cast("date"))
    return dates.distinct()


def gap_sessions(spans: DataFrame, calendar: DataFrame, present: DataFrame) -> DataFrame:
    """Sessions of ``spans`` (``symbol, begin, end``, one span per symbol) that are not present.

    Each present date is compared with the next one, and only the days between are made: series x days
    is never built, and nothing is looked up day by day.
    """
    held = present.select("symbol", "date").join(spans, "symbol").where(F.col("date").between(F.col("begin"), F.col("end")))
    start = spans.select("symbol", F.date_sub("begin", 1).alias("date"), "begin", "end")
    follows = F.lead("date").over(W.partitionBy("symbol").orderBy("date"))
    gaps = start.unionByName(held).withColumn("next", F.coalesce(follows, F.date_add("end", 1))).where(F.datediff("next", "date") > 1)
    days = F.sequence(F.date_add("date", 1), F.date_sub("next", 1))
    return gaps.select("symbol", F.explode(days).alias("date")).join(calendar.select("date"), "date").select("symbol", "date")


def _spans(series: DataFrame, last: Column) -> DataFrame:
    open_ended = series.where(F.col("start_date") <= last)
    return open_ended.groupBy("symbol").agg(F.min("start_date").alias("begin")).withColumn("end", last)


def missing_sessions(series: DataFrame, calendar: DataFrame, present: DataFrame, last: Column) -> DataFrame:
    """Closed sessions since the start that are neither in raw nor in staging."""
    return gap_sessions(_spans(series, last), calendar, present)


def missing_summary(series: DataFrame, calendar: DataFrame, present: DataFrame, last: Column, shown: int = 3) -> DataFrame:
    """Expected and missing session counts per series, with the first and last missing dates."""
    spans = _spans(series, last)
    there = present.select("symbol", "date").distinct().join(spans, "symbol").where(F.col("date").between(F.col("begin"), F.col("end")))
    there = there.join(calendar.select("date"), "date").select("symbol", F.lit(None).cast("date").alias("gap"))
    gaps = gap_sessions(spans, calendar, present).select("symbol", F.col("date").alias("gap"))
    # One entry per session date at most.
    grouped = gaps.unionByName(there).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("expected_count"), F.count("gap").alias("missing_count"), F.sort_array(F.collect_list("gap")).alias("gaps")
    )
    text = lambda dates: F.array_join(F.transform(dates, lambda d: d.cast("string")), " ")
    last_ones = F.slice("gaps", F.greatest(F.size("gaps") - shown + 1, F.lit(1)), F.lit(shown))
    return grouped.select(
        "symbol", "expected_count", "missing_count", text(F.slice("gaps", 1, shown)).alias("first_missing"), text(last_ones).alias("last_missing")
    )


def load_plan(
    series: DataFrame,
    calendar: DataFrame,
    present: DataFrame,
    now: Column,
    first: str | None = None,
    last: str | None = None,
    wanted: list[str] | None = None,
    from_start: bool = False,
    reload: bool = False,
    finished_rule: bool = False,
    clamp_to_start: bool = False,
    look_back_days: int | None = None,
) -> DataFrame:
    """Sessions to load: (range or explicit dates) that are over, minus the ones already present.

    Without ``first`` a series continues the day after its last present date, or at its start when
    nothing is present. ``finished_rule`` uses the fixed-hour rule instead of close + buffer.
    ``clamp_to_start`` moves an explicit first date up to the start. With ``look_back_days`` only
    recent dates count as present for the default start; a series without any gives one row without a
    date, and every row has a ``reason`` (empty, or why nothing can be planned).
    """
    today = T.wall_date(now)
    over = C.finished_sessions(calendar, now) if finished_rule else C.closed_sessions(calendar, now)
    present = present.select("symbol", "date")
    if wanted:
        dates = F.array(*[F.lit(d).cast("date") for d in sorted(set(wanted))])
        candidates = series.select("symbol", F.explode(dates).alias("date")).join(over.select("date"), "date", "left_semi")
    else:
        seen = present
        if look_back_days is not None:
            seen = seen.where(F.col("date").between(F.date_sub(today, look_back_days), today))
        newest = seen.groupBy("symbol").agg(F.max("date").alias("newest"))
        starts = series.join(newest, "symbol", "left")
        follow_on = F.date_add("newest", 1)
        if first is not None:
            begin = F.lit(first).cast("date")
        elif from_start:
            begin = F.col("start_date")
        elif look_back_days is not None:
            begin = follow_on
        else:
            begin = F.coalesce(follow_on, F.col("start_date"))
        if clamp_to_start:
            begin = F.greatest(begin, F.col("start_date"))
        end = F.lit(last).cast("date") if last is not None else today
        spans = starts.select("symbol", begin.alias("begin"), end.alias("end")).where(F.col("begin") <= F.col("end"))
        nothing = present.where(F.lit(False))
        candidates = gap_sessions(spans, over, nothing if reload else present)
    planned = candidates.select("symbol", "date")
    if wanted and not reload:
        planned = planned.join(present, ["symbol", "date"], "left_anti")
    if look_back_days is None or wanted or first is not None or from_start:
        return planned
    lost = starts.where(F.col("newest").isNull()).select("symbol", F.lit(None).cast("date").alias("date"), F.lit(NOTHING_RECENT).alias("reason"))
    return planned.withColumn("reason", F.lit("")).unionByName(lost)


def year_chunks(plan: DataFrame, calendar: DataFrame, now: Column) -> DataFrame:
    """One request per (symbol, year) of wanted dates, with every session inside its date span."""
    wanted = plan.withColumn("label", F.date_format("date", "yyyy"))
    chunks = wanted.groupBy("symbol", "label").agg(
        F.count(F.lit(1)).alias("wanted_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sort_array(F.collect_list("date")).alias("wanted_dates"),
    )
    facts = ["wanted_count", "first_date", "last_date", "wanted_dates"]
    inside = chunks.withColumn("date", F.explode(F.sequence("first_date", "last_date"))).join(calendar.select("date"), "date", "left_semi")
    spans = inside.groupBy("symbol", "label").agg(
        *[F.any_value(c).alias(c) for c in facts], F.count(F.lit(1)).alias("session_count"), F.sort_array(F.collect_list("date")).alias("session_dates")
    )
    end = T.from_wall(F.date_add("last_date", YEAR_END_MARGIN_DAYS))
    return spans.select(
        "symbol", "label", "wanted_count", "first_date", "last_date", "session_count", "wanted_dates", "session_dates",
        F.when(end < now, F.date_format(end, "yyyyMMdd-HH:mm:ss")).otherwise(F.lit("")).alias("end_str"),
    )


def coverage_grid(series: DataFrame, kinds: list[str], places: list[str]) -> DataFrame:
    """Every symbol x bar kind x place, by exploding the two fixed lists."""
    return series.select(
        "symbol", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("bar_kind")
    ).select("symbol", "bar_kind", F.explode(F.array(*[F.lit(p) for p in places])).alias("place"))


def place_summary(bars: DataFrame, by: list[str]) -> DataFrame:
    """Rows, distinct dates and date span per place. Dates are reduced before they are counted."""
    per_date = bars.groupBy(*by, "date").agg(F.count(F.lit(1)).alias("n"))
    return per_date.groupBy(*by).agg(
        F.sum("n").alias("row_count_int"),
        F.count(F.lit(1)).alias("date_count_int"),
        F.min("date").cast("string").alias("first_date_str"),
        F.max("date").cast("string").alias("last_date_str"),
    )


def file_summary(catalog: DataFrame, by: list[str]) -> DataFrame:
    """File count and megabytes per place, from the period catalog."""
    return catalog.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_count_int"), F.round(F.sum("length") / F.lit(1e6), 1).alias("size_mb_float")
    )


def coverage_status(grid: DataFrame, summary: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The grid with what each place holds; empty places stay with zeros."""
    keys = ["symbol", "bar_kind", "place"]
    result = grid.join(summary, keys, "left")
    filled = {"row_count_int": 0, "date_count_int": 0, "first_date_str": "", "last_date_str": ""}
    if files is not None:
        result = result.join(files, keys, "left")
        filled |= {"file_count_int": 0, "size_mb_float": 0.0}
    return result.withColumn("exists_bool", F.col("row_count_int").isNotNull()).fillna(filled)
