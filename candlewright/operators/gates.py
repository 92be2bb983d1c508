"""Decisions for staged days, in the order the rules apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.operators import checks as K

# The decision wording that merge logs and reports compare.
ADD = "add"
MERGE = "merge"
IN_RAW = "skip: date already in raw (raw data is never replaced)"
NOT_A_SESSION = "skip: not a closed NYSE session"
BAD_CANDLES = "skip: candlestick sanity issues"
NO_BARS = "skip: no bars"


def _partial(missing: Column) -> Column:
    return F.concat(F.lit("skip: partial ("), missing.cast("string"), F.lit(" missing minutes; use --include-partial)"))


def _issues(prices: Column, duplicates: Column, unit: str) -> Column:
    return F.concat(
        F.lit("skip: "), prices.cast("string"), F.lit(" price issue(s), "), duplicates.cast("string"), F.lit(f" duplicate {unit}(s)")
    )


def _with_raw(checked: DataFrame, raw_dates: DataFrame) -> DataFrame:
    there = raw_dates.select("symbol", "date").distinct().withColumn("in_raw", F.lit(True))
    return checked.join(there, ["symbol", "date"], "left").withColumn("in_raw_bool", F.coalesce("in_raw", F.lit(False)))


def merge_gate(
    staged: DataFrame,
    raw_dates: DataFrame,
    calendar: DataFrame,
    include_partial: bool = False,
    bad_tick: Column | None = None,
    step_seconds: int = 60,
) -> DataFrame:
    """One decision per staged (symbol, date).

    ``staged``: ``symbol, date, ts, open, high, low, close``; ``calendar``: closed sessions. Completeness,
    candle issues and bad ticks are counted in one pass over the staged bars. A bad tick is whatever
    the caller's boolean column says; it is counted and never blocks.
    """
    counters = {
        "sanity_issue_count_int": K.broken_candles(),
        "bad_tick_count_int": bad_tick if bad_tick is not None else F.lit(False),
    }
    checked = K.session_check(staged, calendar, None, step_seconds, 0, counters)
    # A day outside the calendar has no expected minutes, so its missing count is zero.
    missing = F.when(F.col("status_str") == "no_session", F.lit(0).cast("bigint")).otherwise(F.col("missing_count_int"))
    partial = F.col("status_str") == "partial"
    decision = (
        F.when(F.col("in_raw_bool"), F.lit(IN_RAW))
        .when(F.col("status_str") == "no_session", F.lit(NOT_A_SESSION))
        .when(F.col("sanity_issue_count_int") > 0, F.lit(BAD_CANDLES))
        .when(partial & F.lit(not include_partial), _partial(missing))
        .otherwise(F.lit(ADD))
    )
    return _with_raw(checked, raw_dates).select(
        "symbol", "date", F.col("status_str").alias("check_status_str"), "bar_count_int", missing.alias("missing_count_int"),
        "sanity_issue_count_int", "bad_tick_count_int", "in_raw_bool", decision.alias("decision_str"),
    )


def merge_gate_index(
    staged: DataFrame,
    raw_dates: DataFrame,
    include_partial: bool = False,
    core_first: str = K.CORE_FIRST,
    core_last: str = K.CORE_LAST,
    step_seconds: int = 60,
) -> DataFrame:
    """Decision per staged one-minute session of an index: core hours only, duplicates block.

    Price issues count over every staged row; duplicates are repeated instants of the whole file.
    """
    counters = {"price_issue_count_int": K.broken_candles()}
    checked = K.core_hours_check(staged, None, core_first, core_last, step_seconds, counters=counters)
    # Repeats among rows of another date never decide: those rows block one rule earlier.
    prices, repeats, extra = F.col("price_issue_count_int"), F.col("duplicate_count_int"), F.col("extra_count_int")
    decision = (
        F.when(F.col("in_raw_bool"), F.lit(IN_RAW))
        .when(extra > 0, F.concat(F.lit("skip: "), extra.cast("string"), F.lit(" bar(s) of another date")))
        .when((prices > 0) | (repeats > 0), _issues(prices, repeats, "minute"))
        .when(F.col("status_str") == "empty", F.lit(NO_BARS))
        .when((F.col("status_str") == "partial") & F.lit(not include_partial), _partial(F.col("missing_count_int")))
        .otherwise(F.lit(ADD))
    )
    rows = F.col("bar_count_int") + repeats + extra
    return _with_raw(checked, raw_dates).select(
        "symbol", "date", "status_str", rows.alias("row_count_int"), "missing_count_int", "price_issue_count_int",
        repeats.alias("duplicate_count_int"), "in_raw_bool", decision.alias("decision_str"),
    )


def merge_gate_daily(staged: DataFrame, by: list[str]) -> DataFrame:
    """Decision per staged file of daily bars: price issues or a repeated date block the file."""
    per_label = staged.groupBy(*by, "ts").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(K.broken_candles()).alias("issues")
    )
    files = per_label.groupBy(*by).agg(
        F.sum("n").alias("row_count_int"),
        F.sum("issues").alias("price_issue_count_int"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_count_int"),
    )
    prices, repeats = F.col("price_issue_count_int"), F.col("duplicate_count_int")
    decision = F.when((prices > 0) | (repeats > 0), _issues(prices, repeats, "date")).otherwise(F.lit(MERGE))
    return files.withColumn("decision_str", decision)


def decision_counts(decisions: DataFrame, by: list[str] | None = None, column: str = "decision_str", whole: bool = False) -> DataFrame:
    """How many days per decision; by default only the part before the colon is compared."""
    text = F.col(column)
    label = text if whole else F.substring_index(text, ":", 1)
    return decisions.groupBy(*(by or []), label.alias("decision")).agg(F.count(F.lit(1)).alias("count"))
