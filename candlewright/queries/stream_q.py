"""The events file as a live stream of bar versions.

The arrival of a version is its time plus 0 to 7 minutes, so some versions come before their minute
is visible and some after the look-back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import times as T
from candlewright.queries import adapters as A
from candlewright.session import run_folder, stream_session
from candlewright.streaming import live as S


def _versions(spark, sf_dir):
    schema = A.table(spark, sf_dir, "events").schema
    return _version_columns(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def _version_columns(source):
    local = F.col("ts").cast("timestamp")
    instant = T.from_wall(local)
    wait = F.pmod("event_id", F.lit(7)) * F.lit(70 * T.MICROS_PER_SECOND)
    price = F.col("value")
    return source.select(
        F.col("event_type").alias("symbol"), T.floor_to(instant, 60).alias("ts"), T.plus_micros(instant, wait).alias("arrival_ts"),
        *[price.alias(c) for c in ("open", "high", "low", "close")], F.lit(1.0).alias("volume"),
    )


def stream_live(spark, sf_dir):
    """Newest version of every minute after the stream has read everything available."""
    folder = S.run_live(_versions(stream_session(spark), sf_dir), "live")
    bars = S.live_table(spark, f"{folder}/bars")
    return bars.select("symbol", A.text("ts").alias("minute"), "close", A.text("arrival_ts").alias("arrival"))


def stream_gaps(spark, sf_dir):
    """Missing minutes so far of every session the stream has touched."""
    own = stream_session(spark)
    folder = S.run_live(_versions(own, sf_dir), "live-gaps", A.calendar(own))
    return S.poll_table(spark, folder)


def _dealt():
    """Number of the file an event comes in."""
    return F.when(F.col("event_type") == F.lit(LAGGING), F.lit(7)).otherwise(6 - F.pmod("event_id", F.lit(7))).cast("int")


def stream_multi_batch(spark, sf_dir):
    """The same versions from eight files, one for each micro-batch, out of order, with one symbol behind.

    Files are dealt by number, so every batch reaches from the first to the last day; the versions of the
    lagging symbol come in the last file.
    """
    own = stream_session(spark)
    folder = run_folder(spark, "version-files")
    events, part = A.table(spark, sf_dir, "events"), _dealt()
    for k in range(8):  # one file after the other, so that the stream reads them in this order
        events.where(part == k).coalesce(1).write.mode("append").parquet(folder)
    source = own.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    bars = S.live_table(spark, f"{S.run_live(_version_columns(source), 'live-batches')}/bars")
    return bars.select("symbol", A.text("ts").alias("minute"), "close", A.text("arrival_ts").alias("arrival"))


def stream_backfill(spark, sf_dir):
    """The first poll reads the session from its start: versions that arrive up to then have no look-back limit."""
    folder = S.run_live(_versions(stream_session(spark), sf_dir), "live-backfill", backfill_until=T.instant_literal(FIRST_POLL))
    bars = S.live_table(spark, f"{folder}/bars")
    return bars.select("symbol", A.text("ts").alias("minute"), "close", A.text("arrival_ts").alias("arrival"))


def stream_compacted(spark, sf_dir):
    """The multi-batch stream, stopped half way, its finished dates folded, and gone on with."""
    own = stream_session(spark)
    source = run_folder(spark, "version-files")
    events, part = A.table(spark, sf_dir, "events"), _dealt()
    folder = None
    for half in (range(4), range(4, 8)):
        for k in half:
            events.where(part == k).coalesce(1).write.mode("append").parquet(source)
        stream = own.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        folder = S.run_live(_version_columns(stream), "live-compacted", folder=folder)
        S.compact(spark, folder, "2024-01-20")
    bars = S.live_table(spark, f"{folder}/bars")
    return bars.select("symbol", A.text("ts").alias("minute"), "close", A.text("arrival_ts").alias("arrival"))


def stream_minute_bars(spark, sf_dir):
    """Five-minute bars of the event stream from eight files, one for each batch, each reaching over all days: late ticks count."""
    own = stream_session(spark)
    source = run_folder(spark, "tick-files")
    events, part = A.table(spark, sf_dir, "events"), _dealt()
    for k in range(8):
        events.where(part == k).coalesce(1).write.mode("append").parquet(source)
    stream = own.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    ticks = stream.select(
        F.col("event_type").alias("symbol"), T.from_wall(F.date_trunc("second", F.col("ts"))).alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("volume"),
        F.col("event_id").alias("seq"),
    )
    folder = S.run_bars(ticks, "minute-bars", "5 minutes")
    S.compact(spark, folder, "2024-01-10", S.merge_partials)
    return S.bar_table(spark, f"{folder}/bars").select("symbol", A.text("ts").alias("bar"), "open", "high", "low", "close", "volume")


#: The symbol whose versions come last.
LAGGING = "click"

#: New York time of the first poll of the back-filled stream.
FIRST_POLL = "2024-01-17 12:00:00"

VERSIONS = """WITH v AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, ts + (event_id % 7) * INTERVAL 70 SECOND AS arrival, value AS close FROM events),
polled AS (SELECT *, date_trunc('minute', arrival - INTERVAL 30 SECOND) - INTERVAL 1 MINUTE AS reach FROM v),
newest AS (SELECT symbol, ts, arg_max(close, arrival) AS close, max(arrival) AS arrival FROM polled WHERE ts <= reach AND ts >= reach - INTERVAL 4 MINUTE GROUP BY 1, 2)"""

REPORTS = {
    "stream_live": (
        stream_live,
        VERSIONS + " SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, close, strftime(arrival, '%Y-%m-%d %H:%M:%S') AS arrival FROM newest",
    ),
    "stream_backfill": (
        stream_backfill,
        VERSIONS.replace("ts >= reach - INTERVAL 4 MINUTE", f"(ts >= reach - INTERVAL 4 MINUTE OR arrival <= TIMESTAMP '{FIRST_POLL}')")
        + " SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, close, strftime(arrival, '%Y-%m-%d %H:%M:%S') AS arrival FROM newest",
    ),
    "stream_multi_batch": (
        stream_multi_batch,
        VERSIONS + " SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, close, strftime(arrival, '%Y-%m-%d %H:%M:%S') AS arrival FROM newest",
    ),
    "stream_compacted": (
        stream_compacted,
        VERSIONS + " SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, close, strftime(arrival, '%Y-%m-%d %H:%M:%S') AS arrival FROM newest",
    ),
    "stream_gaps": (
        stream_gaps,
        VERSIONS.replace("newest AS", "any_newest AS")
        + f""", {A.SQL_MINUTE_CALENDAR},
kept AS (SELECT p.* FROM polled p JOIN cal c ON c.date = CAST(p.ts AS DATE) AND p.ts BETWEEN first_ts AND last_ts AND arrival <= last_ts + INTERVAL 390 SECOND),
newest AS (SELECT symbol, ts, max(arrival) AS arrival FROM kept WHERE ts <= reach AND ts >= reach - INTERVAL 4 MINUTE GROUP BY 1, 2),
clock AS (SELECT CAST(ts AS DATE) AS date, date_trunc('minute', max(arrival) - INTERVAL 30 SECOND) - INTERVAL 1 MINUTE AS reach FROM newest GROUP BY 1),
so_far AS (SELECT c.date, first_ts, least(last_ts, reach) AS last_ts FROM cal c JOIN clock k ON k.date = c.date WHERE least(last_ts, reach) >= first_ts),
pairs AS (SELECT symbol, CAST(ts AS DATE) AS date, count(*) AS n FROM newest GROUP BY 1, 2),
grid AS (SELECT p.symbol, s.date, n, unnest(generate_series(first_ts, last_ts, INTERVAL 1 MINUTE)) AS ts FROM pairs p JOIN so_far s ON s.date = p.date),
gaps AS (SELECT g.symbol, g.date, any_value(n) AS n, count(*) FILTER (w.ts IS NULL) AS missing, list(strftime(g.ts, '%H:%M') ORDER BY g.ts) FILTER (w.ts IS NULL) AS m
  FROM grid g LEFT JOIN newest w ON w.symbol = g.symbol AND w.ts = g.ts GROUP BY 1, 2)
SELECT symbol, date, n AS total_bar_count_int, missing AS missing_count_int,
  COALESCE(array_to_string(m[1:10], ', '), '') || CASE WHEN missing > 10 THEN ' (+' || (missing - 10) || ' more)' ELSE '' END AS missing_str FROM gaps""",
    ),
    "stream_minute_bars": (
        stream_minute_bars,
        """WITH ticks AS (SELECT *, CAST(epoch(date_trunc('second', ts)) AS HUGEINT) * 1000000000000 + event_id AS place FROM events)
SELECT event_type AS symbol, strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS bar, arg_min(value, place) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, place) AS close, CAST(count(*) AS DOUBLE) AS volume FROM ticks GROUP BY 1, 2""",
    ),
}
