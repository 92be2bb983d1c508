"""Period layout of a zone: targets of a roll-up, left-overs, overlaps and rebuild plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.functions import periods as P, times as T


def catalog_of(periods: DataFrame) -> DataFrame:
    """Add kind, bounds and file name to a frame with ``period_str``."""
    period = F.col("period_str")
    return (
        periods.withColumn("file_name_str", P.file_name(period))
        .withColumn("period_kind_str", P.period_kind(period))
        .withColumn("first_date", P.first_date(period))
        .withColumn("last_date", P.last_date(period))
    )


def ordered_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy("first_date", F.length("period_str"))


def covering(catalog: DataFrame, first: Column, last: Column) -> DataFrame:
    """Files whose span meets a date range."""
    return catalog.where((F.col("last_date") >= first) & (F.col("first_date") <= last))


def period_overlap(catalog: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Files that meet each date range of ``ranges`` (``keys, range_id, low, high``).

    A file overlaps a range exactly when it covers one of its months or is a day inside it, so both
    sides are spread over calendar months and joined on equality; the exact test follows. A pair that
    shares several months is kept only in the first month it shares.
    """
    def months(first: Column, last: Column) -> Column:
        return F.sequence(F.to_date(F.date_trunc("month", first)), F.to_date(F.date_trunc("month", last)), F.expr("interval 1 month"))

    files = catalog.select(*keys, "period_str", "first_date", "last_date", F.explode(months(F.col("first_date"), F.col("last_date"))).alias("month"))
    spans = ranges.where(F.col("low") <= F.col("high")).select(
        *keys, "range_id", "low", "high", F.explode(months(F.col("low"), F.col("high"))).alias("month")
    )
    first_shared = F.to_date(F.date_trunc("month", F.greatest("first_date", "low")))
    return (
        files.join(spans, [*keys, "month"])
        .where((F.col("last_date") >= F.col("low")) & (F.col("first_date") <= F.col("high")) & (F.col("month") == first_shared))
        .select(*keys, "range_id", "period_str", "first_date", "last_date")
    )


def orphan_periods(catalog: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Target of every period: the year that exists for it, else the month that does, else itself."""
    keys = keys or []
    known = catalog.select(*keys, "period_str").distinct()
    years = known.where(F.length("period_str") == 4).select(*keys, F.col("period_str").alias("year_period"))
    months = known.where(F.length("period_str") == 6).select(*keys, F.col("period_str").alias("month_period"))
    size = F.length("period_str")
    named = catalog.withColumn("year_period", F.when(size > 4, F.substring("period_str", 1, 4))).withColumn(
        "month_period", F.when(size == 8, F.substring("period_str", 1, 6))
    )
    found = named.join(years.withColumn("has_year", F.lit(True)), [*keys, "year_period"], "left").join(
        months.withColumn("has_month", F.lit(True)), [*keys, "month_period"], "left"
    )
    target = (
        F.when(F.col("has_year"), F.col("year_period")).when(F.col("has_month"), F.col("month_period")).otherwise(F.col("period_str"))
    )
    return found.withColumn("target_period_str", target).drop("year_period", "month_period", "has_year", "has_month")


def rollup_plan(catalog: DataFrame, now: Column) -> DataFrame:
    """Target of every period under the roll-up rule (``now`` is an instant)."""
    return catalog.withColumn("target_period_str", P.organized_period(F.col("period_str"), T.wall(now)))


def moves(planned: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per target that receives other periods."""
    moving = planned.where(F.col("target_period_str") != F.col("period_str"))
    return moving.groupBy(*(keys or []), "target_period_str").agg(
        F.count(F.lit(1)).alias("source_count"), F.min("period_str").alias("first_source"), F.max("period_str").alias("last_source")
    )


def with_target(rows: DataFrame, now: Column, date_column: str = "date") -> DataFrame:
    return rows.withColumn("target_period_str", P.period_for_date(F.col(date_column), T.wall(now)))


def rebuild_plan(merged: DataFrame, existing: DataFrame, now: Column, remove_stale: bool, keys: list[str] | None = None) -> DataFrame:
    """Rows per rebuilt period and what happens to each file of the target zone.

    ``merged`` has one row per bar with its ``date``; ``existing`` lists the target's periods.
    """
    keys = keys or []
    built = with_target(merged, now).groupBy(*keys, "target_period_str").agg(F.count(F.lit(1)).alias("rows"))
    there = existing.select(*keys, F.col("period_str").alias("target_period_str")).distinct().withColumn("there", F.lit(True))
    plan = built.join(there, [*keys, "target_period_str"], "full")
    action = (
        F.when(F.col("rows").isNull(), F.lit("remove (stale)"))
        .when(F.col("there"), F.lit("replace"))
        .otherwise(F.lit("create"))
    )
    plan = plan.select(
        *keys,
        P.file_name(F.col("target_period_str")).alias("file_name_str"),
        F.coalesce("rows", F.lit(0)).alias("row_count_int"),
        action.alias("action_str"),
    )
    return plan if remove_stale else plan.where(F.col("action_str") != "remove (stale)")
