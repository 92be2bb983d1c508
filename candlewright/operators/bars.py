"""Roll-ups, returns and edge bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from candlewright.functions import times as T

# Bars per window partition of the return computation.
BUCKET_STEPS = 64


def ohlcv_rollup(bars: DataFrame, by: list[str], order: str = "ts") -> DataFrame:
    """Open of the first bar, highest high, lowest low, close of the last bar, summed volume.

    ``order`` must be unique inside a group for a repeatable open and close; every buffer has a
    fixed width, so the map side combines in a hash table.
    """
    return bars.groupBy(*by).agg(
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("bar_count_int"),
    )


def daily_coverage(bars: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First and last timestamp and row count per New York date."""
    return (
        bars.withColumn("date", T.wall_date(F.col("ts")))
        .groupBy(*(by or []), "date")
        .agg(F.min("ts").alias("min_timestamp"), F.max("ts").alias("max_timestamp"), F.count(F.lit(1)).alias("row_count"))
    )


def first_per_label(bars: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """First row per key. An aggregate, so copies of one hot key are reduced before the shuffle."""
    return bars.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values])


def bar_returns(bars: DataFrame, step_seconds: int = 60, bucket_steps: int = BUCKET_STEPS) -> DataFrame:
    """Log return of the close where the previous bar is exactly one step earlier.

    Returns never cross a date, and the previous bar that counts lies at most one step back. A window
    therefore only needs a short stretch of time: bars are split by (symbol, date, time bucket), and
    the bars of the last step of a bucket also go to the next one as context.
    """
    step = step_seconds * T.MICROS_PER_SECOND
    width = F.lit(step * bucket_steps)
    at = T.micros(F.col("ts"))
    bucket = F.floor(at / width)
    at_end = F.pmod(at, width) >= width - F.lit(step)
    buckets = F.when(at_end, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    spread = bars.select("symbol", "date", "ts", "close", bucket.alias("own"), F.explode(buckets).alias("bucket"))
    nearby = W.partitionBy("symbol", "date", "bucket").orderBy("ts")
    previous = spread.withColumn("prev_ts", F.lag("ts").over(nearby)).withColumn("prev_close", F.lag("close").over(nearby))
    consecutive = previous.where((F.col("own") == F.col("bucket")) & (at - T.micros(F.col("prev_ts")) == step))
    positive = consecutive.where((F.col("close") > 0) & (F.col("prev_close") > 0))
    value = F.log("close") - F.log("prev_close")
    finite = ~F.isnan("ret") & (F.abs("ret") != F.lit(float("inf")))
    return positive.select("symbol", "date", "ts", value.alias("ret")).where(F.col("ret").isNotNull() & finite)


def edge_bars(bars: DataFrame, count: int = 3) -> DataFrame:
    """First and last bars of every (symbol, date); a short session lists a bar twice.

    A bar stands in both lists, each with its own order, so one scan and one rank make them; the rank
    filter is a limit Spark applies before the shuffle.
    """
    keys = ["symbol", "date", "edge"]
    at = T.micros(F.col("ts"))
    lists = F.array(F.struct(F.lit("first").alias("edge"), at.alias("place")), F.struct(F.lit("last").alias("edge"), (-at).alias("place")))
    both = bars.select("symbol", "date", "ts", "open", "high", "low", "close", F.inline(lists))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("place"))
    return both.withColumn("position", rank).where(F.col("position") <= count).drop("place")
