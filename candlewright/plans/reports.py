"""Report jobs: issues of whole zones, the alignment run, and the weekly zone load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewright.functions import times as T
from candlewright.operators import align as L, bars as B, calendar as C, checks as K, zones as O
from candlewright.plans import zone as Z
from candlewright.sources import sinks


def zone_issues(
    spark: SparkSession, zones: list[str], calendar: DataFrame, now: Column, last_date: str, start_date: str | None = None, report_path: str | None = None
) -> DataFrame:
    """Issue report over one or more zones.

    A start date skips the bars of the periods before it, but not their symbols: a series whose last bar
    lies in an older period is still expected. The symbols of those periods come from the zone's statistics;
    only periods without any are opened for them.
    """
    parts, known = [], []
    for zone in zones:
        stored = Z.periods(spark, zone)
        names = stored
        if start_date is not None:
            names = [p for p in stored if p.ljust(8, "9") >= start_date.replace("-", "")]
        known.append(Z.read_stats(spark, zone).select("symbol"))
        untold = Z.without_stats(spark, zone, stored)
        if untold:
            known.append(Z.read_zone(spark, zone, untold).select("symbol"))
        parts.append(Z.read_zone(spark, zone, names).select("symbol", "ts"))
    bars, symbols = reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, known).distinct()
    issues = K.issue_report(bars, C.closed_sessions(calendar, now), last_date, start_date, symbols=symbols)
    if report_path is not None:
        sinks.write_report(issues, report_path)
    return issues


def alignment_run(minute: DataFrame, daily: DataFrame, reference: str, order: str = "ts", cutoff: str | None = None) -> dict[str, DataFrame]:
    """Check, lag, edge and verdict tables of stored bars against one reference series.

    ``minute`` and ``daily``: ``symbol, date, ts, open, high, low, close`` (daily also ``volume``).
    Of repeated labels the first by ``order`` stays. With a cut-off, dates of the hold-out window are left
    out of every table.
    """
    if cutoff is not None:
        minute, daily = L.before_cutoff(minute, cutoff), L.before_cutoff(daily, cutoff)
    unique = B.first_per_label(minute, ["symbol", "date", "ts"], order, ["open", "high", "low", "close"])
    others = unique.where(F.col("symbol") != reference)
    returns = B.bar_returns(unique)
    lags = L.lag_corr(returns.where(F.col("symbol") != reference), returns.where(F.col("symbol") == reference))
    checks = L.alignment_check(others, daily.where(F.col("symbol") != reference), "ts")
    edges = B.edge_bars(unique).withColumn("label", T.label_text(F.col("ts"), F.lit(False)))
    return {"checks": checks, "lags": lags, "edges": edges, "verdict": L.verdict_lines(checks, lags)}


def load_weeks(raw: DataFrame, path: str) -> DataFrame:
    """Slice raw zone rows into weeks and write them behind the snapshot guard."""
    return sinks.write_weeks(O.week_slices(raw), path)
