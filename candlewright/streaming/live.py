"""Live minute bars: only complete minutes, healed by later versions, the newest version wins.

A source row is one version of one minute: ``symbol, ts, arrival_ts`` and the bar values, with ``seq``
where the source numbers its versions. What a poll accepts depends on the version alone, so the stream
keeps no state and no event-time limit: a version of one symbol is never late because another symbol is
ahead. Every micro-batch is reduced to its newest versions and written under its own batch id, so a
batch that is repeated after a lost executor replaces itself, and the newest written version wins when
the table is read. The live table is never merged into the raw zone.

Bars of ticks are kept as partial bars of each batch and merged when they are read. The batch folders of
finished dates can be folded into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewright.functions import times as T
from candlewright.operators import checks as K, merge as M
from candlewright.plans import publish as PB
from candlewright.session import run_folder
from candlewright.sources import files as FS

# Delay before a minute is asked for, look-back of a poll, and grace after the close.
BAR_DELAY_SECONDS = 30
LOOK_BACK_SECONDS = 300
CLOSE_GRACE_MINUTES = 5

VALUES = ["open", "high", "low", "close", "volume"]
MINUTE = 60


def last_complete_minute(clock: Column) -> Column:
    """Label of the newest minute that ended at least the delay ago."""
    late = T.plus_micros(clock, -BAR_DELAY_SECONDS * T.MICROS_PER_SECOND)
    return T.plus_micros(T.floor_to(late, MINUTE), -MINUTE * T.MICROS_PER_SECOND)


def is_visible(ts: Column, arrival: Column) -> Column:
    """A bar counts once its minute is over and the delay has passed."""
    return ts <= last_complete_minute(arrival)


def in_look_back(ts: Column, arrival: Column) -> Column:
    """A poll asks for the last few minutes only; older minutes are not asked for again."""
    reach = (LOOK_BACK_SECONDS - MINUTE) * T.MICROS_PER_SECOND
    return ts >= T.plus_micros(last_complete_minute(arrival), -reach)


def accepted(versions: DataFrame, backfill_until: Column | None = None) -> DataFrame:
    """Versions a poll would have received.

    Versions that arrive up to ``backfill_until`` belong to the first poll, which reads the session
    from its start and therefore has no look-back limit.
    """
    ts, arrival = F.col("ts"), F.col("arrival_ts")
    recent = in_look_back(ts, arrival)
    if backfill_until is not None:
        recent = recent | (arrival <= backfill_until)
    return versions.where(is_visible(ts, arrival) & recent)


def until_session_end(versions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Versions inside their session that arrive before the stream of the session ends."""
    inside = K.in_session(versions, calendar)
    ends = calendar.select("date", F.col("last_bar_ts").alias("_last"))
    wait = (MINUTE + BAR_DELAY_SECONDS + 60 * CLOSE_GRACE_MINUTES) * T.MICROS_PER_SECOND
    return inside.join(ends, "date").where(F.col("arrival_ts") <= T.plus_micros(F.col("_last"), wait)).drop("_last")


def version_order(versions: DataFrame) -> Column:
    """Arrival, then the number of the source or a hash of the values, in one number of fixed width."""
    tie = F.col("seq") if "seq" in versions.columns else F.shiftright(F.xxhash64(*VALUES), 2)
    return T.micros(F.col("arrival_ts")).cast("decimal(18,0)") * F.lit(Decimal(10**19)) + tie.cast("decimal(19,0)")


def newest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of every minute; the opposite precedence of a raw merge."""
    order = version_order(versions)
    kept = [*VALUES, "arrival_ts", *(["seq"] if "seq" in versions.columns else [])]
    return versions.groupBy("symbol", "ts").agg(*[F.max_by(v, order).alias(v) for v in kept])


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """One folder per session date and batch; writing a batch again replaces it."""
    (
        batch.withColumn("session_date", T.wall_date(F.col("ts")))
        .withColumn("batch", F.lit(batch_id))
        .hint("rebalance", "session_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("session_date", "batch")
        .parquet(path)
    )


def live_table(spark: SparkSession, path: str) -> DataFrame:
    """Current bars: the newest written version of every minute."""
    return newest_versions(spark.read.parquet(path).drop("batch", "session_date"))


def gaps_so_far(bars: DataFrame, calendar: DataFrame, clock: DataFrame, max_listed: int = K.MAX_LISTED) -> DataFrame:
    """Missing minutes of every session from its open to the last complete minute.

    ``clock`` has one row per date: ``date, arrival_ts`` of the newest version received.
    """
    reached = calendar.join(clock, "date").withColumn(
        "last_bar_ts", F.least("last_bar_ts", last_complete_minute(F.col("arrival_ts")))
    )
    begun = reached.where(F.col("last_bar_ts") >= F.col("first_bar_ts"))
    count = (F.unix_seconds("last_bar_ts") - F.unix_seconds("first_bar_ts")) / MINUTE + 1
    so_far = begun.select("date", "first_bar_ts", "last_bar_ts", count.cast("int").alias("bar_count_int"))
    checked = K.session_check(bars.withColumn("date", T.wall_date(F.col("ts"))), so_far, max_listed=max_listed)
    return checked.where(F.col("status_str") != "no_session").select(
        "symbol", "date", F.col("bar_count_int").alias("total_bar_count_int"), "missing_count_int", "missing_str"
    )


def run_live(
    versions: DataFrame,
    label: str,
    calendar: DataFrame | None = None,
    backfill_until: Column | None = None,
    trigger: dict | None = None,
    wait: bool = True,
    folder: str | None = None,
) -> str:
    """Start the live stream; returns the folder that holds ``bars`` and, with a calendar, ``polls``.

    With the ``folder`` of an earlier run the stream goes on where that one ended.

    With a calendar only bars inside their session count, and a session stops taking versions a few
    minutes after its close. ``trigger`` defaults to everything available now; a running service passes
    ``{"processingTime": "1 minute"}`` and ``wait=False``.
    """
    spark = versions.sparkSession
    folder = folder or run_folder(spark, label)
    received = accepted(versions, backfill_until)
    if calendar is not None:
        received = until_session_end(received, calendar)

    def sink(versions: DataFrame, batch_id: int) -> None:
        batch = newest_versions(versions)
        if calendar is None:
            write_batch(batch, batch_id, f"{folder}/bars")
            return
        batch.persist()
        try:
            write_batch(batch, batch_id, f"{folder}/bars")
            if not batch.isEmpty():
                clock = batch.groupBy(T.wall_date(F.col("ts")).alias("date")).agg(F.max("arrival_ts").alias("arrival_ts"))
                # Only the dates of this batch are checked again; the date prunes the stored folders.
                touched = stored_dates(batch.sparkSession, f"{folder}/bars", clock)
                polls = gaps_so_far(newest_versions(touched), calendar, clock)
                polls.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy("batch").parquet(f"{folder}/polls")
        finally:
            batch.unpersist()

    query = (
        received.writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{folder}/state")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if wait:
        query.awaitTermination()
    return folder


def stored_dates(spark: SparkSession, path: str, clock: DataFrame) -> DataFrame:
    """Stored versions of the dates in ``clock``: only the folders of those dates are listed and read."""
    dates = [r["date"] for r in clock.select("date").distinct().collect()]
    return spark.read.option("basePath", path).parquet(*[f"{path}/session_date={d}" for d in dates]).drop("batch", "session_date")


def poll_table(spark: SparkSession, folder: str) -> DataFrame:
    """The newest gap report of every session."""
    polls = spark.read.parquet(f"{folder}/polls")
    newest = F.max_by(F.struct("total_bar_count_int", "missing_count_int", "missing_str"), "batch")
    return polls.groupBy("symbol", "date").agg(newest.alias("poll")).select("symbol", "date", "poll.*")


def tick_order(ticks: DataFrame) -> Column:
    """Time, then the number of the source or a hash of the tick, in one number of fixed width."""
    tie = F.col("seq") if "seq" in ticks.columns else F.shiftright(F.xxhash64("price", "volume"), 2)
    return T.micros(F.col("ts")).cast("decimal(18,0)") * F.lit(Decimal(10**19)) + tie.cast("decimal(19,0)")


def partial_bars(ticks: DataFrame, size: str = "1 minute") -> DataFrame:
    """Tumbling bars by event time of some of the ticks, with the keys that let them be merged with those of others.

    Columns: symbol, ts (start), open and close with ``open_key`` and ``close_key``, high, low, volume.
    """
    key = tick_order(ticks)
    found = ticks.groupBy("symbol", F.window("ts", size)).agg(
        F.min_by("price", key).alias("open"), F.min(key).alias("open_key"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", key).alias("close"), F.max(key).alias("close_key"), F.sum("volume").alias("volume"),
    )
    return found.select("symbol", F.col("window.start").alias("ts"), *PARTIAL)


PARTIAL = ["open", "open_key", "high", "low", "close", "close_key", "volume"]


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial bar for each symbol and start, whatever the order the parts came in."""
    return partials.groupBy("symbol", "ts").agg(
        F.min_by("open", "open_key").alias("open"), F.min("open_key").alias("open_key"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"), F.max("close_key").alias("close_key"), F.sum("volume").alias("volume"),
    )


def minute_bars(ticks: DataFrame, size: str = "1 minute") -> DataFrame:
    """Tumbling bars of ticks by event time: open, high, low, close and summed volume; equal times go by ``seq``."""
    return partial_bars(ticks, size).drop("open_key", "close_key")


def run_bars(ticks: DataFrame, label: str, size: str = "1 minute", trigger: dict | None = None, wait: bool = True, folder: str | None = None) -> str:
    """Start a stream of tumbling bars; returns the folder that holds ``bars`` (see ``bar_table``).

    A micro-batch writes the partial bars of its ticks under its own number and keeps no state, so no tick is
    ever late: it changes its bar whenever it comes, and a batch that is repeated replaces itself.
    """
    folder = folder or run_folder(ticks.sparkSession, label)
    query = (
        ticks.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_batch(partial_bars(batch, size), batch_id, f"{folder}/bars"))
        .option("checkpointLocation", f"{folder}/state")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if wait:
        query.awaitTermination()
    return folder


def bar_table(spark: SparkSession, path: str) -> DataFrame:
    """Current bars of ``run_bars``: partial bars of all batches merged."""
    return merge_partials(spark.read.parquet(path).drop("batch", "session_date")).drop("open_key", "close_key")


def committed_batch(spark: SparkSession, folder: str) -> int:
    """The last batch that the stream of a folder will not repeat; -1 if there is none."""
    return max((int(e.name) for e in FS.listing(spark, f"{folder}/state/commits") if e.name.isdigit()), default=-1)


def compact(spark: SparkSession, folder: str, before: str, fold: Callable[[DataFrame], DataFrame] = newest_versions) -> dict[str, int]:
    """Fold the batch folders of each session date before ``before`` into one; the number folded by date.

    Only committed batches are taken, since those are never written again: the stream may go on meanwhile,
    and what it adds later to a date stands in a new batch. ``fold`` says how rows of one bar become one:
    ``newest_versions`` for live bars, ``merge_partials`` for bars of ticks. The folded rows are checked
    against the keys they come from and swapped in as one set of moves; the driver handles folder names.
    """
    path = f"{folder}/bars"
    PB.recover(spark, path)
    last = committed_batch(spark, folder)
    taken: dict[str, list[int]] = {}
    for day in (e for e in FS.listing(spark, path) if e.name.startswith("session_date=")):
        date = day.name.removeprefix("session_date=")
        numbers = sorted(int(e.name.removeprefix("batch=")) for e in FS.listing(spark, day.path) if e.name.startswith("batch="))
        numbers = [n for n in numbers if n <= last]
        if date < before and len(numbers) > 1:
            taken[date] = numbers
    if not taken:
        return {}
    at = lambda root, date, n: f"{root}/session_date={date}/batch={n}"
    rows = spark.read.option("basePath", path).parquet(*[at(path, date, n) for date, numbers in taken.items() for n in numbers])
    scratch = f"{path}_folding_{uuid.uuid4().hex}"
    names = F.broadcast(spark.createDataFrame([(d, n[-1]) for d, n in taken.items()], "day string, batch long"))  # one row for each date
    folded = fold(rows.drop("batch", "session_date")).withColumn("session_date", T.wall_date(F.col("ts")))
    folded = folded.join(names, F.col("session_date") == F.col("day").cast("date")).drop("day")
    folded.hint("rebalance", "session_date").write.partitionBy("session_date", "batch").parquet(scratch)
    verdict = M.merge_verify(rows, spark.read.parquet(scratch), ["symbol", "ts"]).first()
    if not verdict["verified"]:
        FS.remove(spark, scratch)
        raise OSError(f"verification of the folded dates failed: {verdict.asDict()}")
    retired = f"{path}_folded_{uuid.uuid4().hex}"
    moves = [(at(path, date, n), at(retired, date, n)) for date, numbers in taken.items() for n in numbers]
    moves += [(at(scratch, date, numbers[-1]), at(path, date, numbers[-1])) for date, numbers in taken.items()]
    PB.publish(spark, moves, [path], [scratch, retired])
    spark.catalog.refreshByPath(path)
    return {date: len(numbers) for date, numbers in taken.items()}
