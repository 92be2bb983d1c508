"""Daily against intraday bars, and the lead / lag of one series against a reference series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.functions import times as T

# Lags, tolerance and thresholds of the alignment check.
LAGS = [-3, -2, -1, 0, 1, 2, 3]
PRICE_TOLERANCE = 0.005
MIN_PAIRS = 100
MARGIN = 0.03

PRICES = ["open", "high", "low", "close"]
KEYS = ["symbol", "date"]


def first_daily(daily: DataFrame, order: str) -> DataFrame:
    """One daily bar per (symbol, date): the first in file order."""
    return daily.groupBy(*KEYS).agg(*[F.min_by(c, order).alias(f"daily_{c}") for c in [*PRICES, "volume"]])


def daily_vs_minute(minute: DataFrame, daily: DataFrame, order: str, daily_order: str) -> DataFrame:
    """Rolled-up intraday bars next to the daily bar of the same date; dates of one side only drop out."""
    rolled = minute.groupBy(*KEYS).agg(
        F.min_by("open", order).alias("minute_open"),
        F.max("high").alias("minute_high"),
        F.min("low").alias("minute_low"),
        F.max_by("close", order).alias("minute_close"),
        F.sum("volume").alias("minute_volume"),
    )
    both = first_daily(daily, daily_order).join(rolled, KEYS)
    ratio = F.when(F.col("minute_volume") != 0, F.round(F.col("daily_volume") / F.col("minute_volume"), 4))
    pairs = [name for c in [*PRICES, "volume"] for name in (f"daily_{c}", f"minute_{c}")]
    return both.select(*KEYS, *pairs, ratio.alias("volume_ratio_float"))


def last_common_dates(left: DataFrame, right: DataFrame, limit: int = 10) -> DataFrame:
    """The newest dates present on both sides. Sort and limit become one top-k per task."""
    return left.select("date").intersect(right.select("date")).orderBy(F.col("date").desc()).limit(limit)


def alignment_check(minute: DataFrame, daily: DataFrame, daily_order: str, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Does the daily bar match the first / last / highest / lowest intraday bar of its date?

    Minute bars pick up their daily bar in a left join, which adaptive execution may split when one
    (symbol, date) is large; daily bars without minutes join the same aggregate as empty groups.
    """
    days = first_daily(daily, daily_order).drop("daily_volume").withColumn("has_daily", F.lit(True))
    bars = minute.select(*KEYS, "ts", *PRICES).join(days, KEYS, "left")
    alone = days.select(
        *KEYS, F.lit(None).cast("timestamp").alias("ts"), *[F.lit(None).cast("double").alias(p) for p in PRICES],
        *[f"daily_{p}" for p in PRICES], "has_daily",
    )
    near = lambda a, b: F.abs(a - b) <= tolerance
    open_hit = F.when(near(F.col("open"), F.col("daily_open")), F.col("ts"))
    close_hit = F.when(near(F.col("close"), F.col("daily_close")), F.col("ts"))
    grouped = bars.unionByName(alone).groupBy(*KEYS).agg(
        F.count("ts").alias("minute_bars"),
        F.max("has_daily").alias("has_daily"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max("daily_open").alias("daily_open"),
        F.min_by("open", "ts").alias("first_bar_open"),
        F.min(open_hit).alias("open_hit"),
        F.max("daily_close").alias("daily_close"),
        F.max_by("close", "ts").alias("last_bar_close"),
        F.max(close_hit).alias("close_hit"),
        F.max("daily_high").alias("daily_high"),
        F.max("high").alias("minute_max_high"),
        F.max("daily_low").alias("daily_low"),
        F.min("low").alias("minute_min_low"),
    )
    has_daily, has_minutes = F.coalesce("has_daily", F.lit(False)), F.col("minute_bars") > 0
    note = F.concat_ws(
        " ", F.when(~has_daily, F.lit("no daily bar")), F.when(~has_minutes, F.lit("no minute bars"))
    )
    usable = has_daily & has_minutes
    label = lambda c: F.coalesce(F.when(usable, T.label_text(F.col(c), F.lit(False))), F.lit(""))
    shown = lambda c: F.when(usable, F.col(c)).alias(c)
    match = lambda a, b, name: F.when(usable, near(F.col(a), F.col(b))).alias(name)
    return grouped.select(
        *KEYS, note.alias("note"), "minute_bars", label("first_ts").alias("first_bar"), label("last_ts").alias("last_bar"),
        shown("daily_open"), shown("first_bar_open"), match("daily_open", "first_bar_open", "open_equals_first"),
        label("open_hit").alias("open_match_bar"),
        shown("daily_close"), shown("last_bar_close"), match("daily_close", "last_bar_close", "close_equals_last"),
        label("close_hit").alias("close_match_bar"),
        shown("daily_high"), shown("minute_max_high"), match("daily_high", "minute_max_high", "high_equals_max"),
        shown("daily_low"), shown("minute_min_low"), match("daily_low", "minute_min_low", "low_equals_min"),
    )


def _lag_name(position: int) -> str:
    return f"ref_{position}"


def lag_corr(
    returns: DataFrame, reference: DataFrame, step_seconds: int = 60, lags: list[int] = LAGS, min_pairs: int = MIN_PAIRS
) -> DataFrame:
    """Pooled correlation of each series' return at t with the reference return at t + lag.

    ``returns``: ``symbol, date, ts, ret``; ``reference``: ``date, ts, ret``. Only the reference is
    multiplied by the lags; it is laid out as one wide row per minute, so the large side is joined
    once and every lag is an aggregate over the same rows. Pairs never cross a date.
    """
    step = step_seconds * T.MICROS_PER_SECOND
    shifts = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(lag).alias("lag")) for i, lag in enumerate(lags)])
    spread = reference.select("date", "ts", "ret", F.explode(shifts).alias("shift")).select(
        "date", T.plus_micros(F.col("ts"), -F.col("shift.lag") * F.lit(step)).alias("ts"), F.col("shift.position").alias("position"), "ret"
    )
    wide = spread.groupBy("date", "ts").agg(
        *[F.max(F.when(F.col("position") == i, F.col("ret"))).alias(_lag_name(i)) for i in range(len(lags))]
    )
    joined = returns.select("symbol", "date", "ts", "ret").join(wide, ["date", "ts"], "left")
    both = lambda i: F.when(F.col("ret").isNotNull(), F.col(_lag_name(i)))
    pooled = joined.groupBy("symbol").agg(
        *[F.count(both(i)).alias(f"n_{i}") for i in range(len(lags))],
        *[F.corr("ret", _lag_name(i)).alias(f"c_{i}") for i in range(len(lags))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(lag).alias("lag"), F.col(f"n_{i}").alias("pairs"), F.when(F.col(f"n_{i}") >= min_pairs, F.col(f"c_{i}")).alias("corr")
            )
            for i, lag in enumerate(lags)
        ]
    )
    return pooled.select("symbol", F.explode(rows).alias("row")).select("symbol", "row.lag", "row.pairs", "row.corr")


def lag_verdict(lags: DataFrame, margin: float = MARGIN, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """The strongest lag of each series and what it means.

    The earliest lag wins a tie. A lag counts as a shift only when it beats lag 0 by the margin.
    """
    usable = F.col("corr").isNotNull()
    order = F.when(usable, F.struct(F.abs("corr"), -F.col("lag")))
    best = lags.groupBy("symbol").agg(
        F.max_by(F.struct("lag", "pairs", "corr"), order).alias("best"),
        F.max(F.when(F.col("lag") == 0, F.col("corr"))).alias("zero_corr"),
    )
    lag, corr = F.col("best.lag"), F.col("best.corr")
    no_shift = (lag == 0) | (F.abs(corr) - F.abs(F.col("zero_corr")) < margin)
    verdict = (
        F.when(corr.isNull(), F.lit("too few pairs"))
        .when(F.coalesce(no_shift, F.lit(False)), F.lit("no shift"))
        .when(lag > 0, F.concat(F.lit("shift +"), lag.cast("string")))
        .otherwise(F.concat(F.lit("late by "), (-lag).cast("string")))
    )
    return best.select(
        "symbol",
        F.when(corr.isNotNull(), lag).alias("best_lag"),
        F.when(corr.isNotNull(), F.col("best.pairs")).alias("pairs"),
        corr.alias("best_corr"),
        "zero_corr",
        verdict.alias("verdict"),
    )


def check_verdict(checks: DataFrame) -> DataFrame:
    """Per series: how many sessions agree, and the distinct edge labels (``HH:mm``)."""
    usable = F.col("first_bar") != ""
    flag = lambda c, name: F.count_if(F.col(c)).alias(name)
    # Labels are clock minutes: the sets are bounded by the minutes of a day.
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(usable, F.right(F.col(c), F.lit(5))))), " ")
    return checks.groupBy("symbol").agg(
        F.count_if(usable).alias("session_count"),
        flag("open_equals_first", "open_matches"), flag("close_equals_last", "close_matches"),
        flag("high_equals_max", "high_matches"), flag("low_equals_min", "low_matches"),
        labels("first_bar").alias("first_labels"), labels("last_bar").alias("last_labels"),
        labels("open_match_bar").alias("open_labels"), labels("close_match_bar").alias("close_labels"),
    )


def verdict_lines(checks: DataFrame, lags: DataFrame, margin: float = MARGIN) -> DataFrame:
    """One report line per statement: ``symbol, line_no, line``."""
    counts = check_verdict(checks)
    verdicts = lag_verdict(lags, margin)
    rows = counts.join(verdicts, "symbol", "left")
    signed = lambda c: F.format_string("%+.3f", c)
    numbers = F.format_string(
        "%d sessions: open %d, close %d, high %d, low %d agree", "session_count", "open_matches", "close_matches", "high_matches", "low_matches"
    )
    edges = F.format_string(
        "first labels [%s], daily open at [%s]; last labels [%s], daily close at [%s]", "first_labels", "open_labels", "last_labels", "close_labels"
    )
    # A format writes a null as text, so series without a correlation are told apart first.
    strongest = F.when(
        F.col("best_corr").isNotNull(), F.concat(F.lit("strongest at lag "), F.format_string("%+d", "best_lag"), F.lit(": "), signed(F.col("best_corr")))
    )
    lines = F.when(F.col("session_count") == 0, F.array(F.lit("no session with both daily and intraday bars"))).otherwise(
        F.array(numbers, edges, F.coalesce(F.concat(strongest, F.lit(" -> "), F.col("verdict")), F.lit("too few pairs")))
    )
    return rows.select("symbol", F.posexplode(lines).alias("line_no", "line"))


def before_cutoff(frame: DataFrame, cutoff: str, column: str = "date") -> DataFrame:
    """Rows outside the hold-out window; a date comparison the scan can use."""
    return frame.where(F.col(column) < F.lit(cutoff).cast("date"))


def held_out(column: Column, cutoff: str) -> Column:
    return column >= F.lit(cutoff).cast("date")
