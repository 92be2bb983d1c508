"""The raw zone as a table of period partitions, and the jobs that roll it up or rebuild it.

A zone is a Parquet folder partitioned by ``period`` (``YYYY`` / ``YYYYMM`` / ``YYYYMMDD``) with the
text cells of every bar, its ``symbol`` and its instant ``ts``, and the order in which its rows came:
``load_seq`` (when they were written) and ``row_pos`` (their place in what was written). Jobs write merged periods to a new
folder, verify them against their inputs, and only then swap partition folders. The replaced folders
are kept in a backup next to the zone; a failed swap is put back. The driver only handles period
names: one entry per partition folder.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as ST

from candlewright.functions import periods as P, times as T
from candlewright.operators import layout as Y, merge as M
from candlewright.plans import publish as PB
from candlewright.session import run_folder
from candlewright.sources import files as FS

KEYS = ["target", "symbol", "ts"]
RESULT = (
    "target_str string, source_str string, target_existed_bool boolean, input_row_count bigint, output_row_count bigint, "
    "duplicate_row_count bigint, conflict_minute_count bigint, status_str string, message_str string"
)


def periods(spark: SparkSession, zone: str) -> list[str]:
    """Period names of a zone, from its folder names."""
    names = [e.name.removeprefix("period=") for e in FS.listing(spark, zone) if e.is_folder and e.name.startswith("period=")]
    return sorted((n for n in names if n.isdigit() and len(n) in P.PERIOD_KINDS), key=lambda n: (n.ljust(8, "0"), len(n)))


def catalog(spark: SparkSession, zone: str) -> DataFrame:
    return Y.catalog_of(spark.createDataFrame([(p,) for p in periods(spark, zone)], "period_str string"))


def stats_path(zone: str) -> str:
    """The side table of a zone: period, symbol, first and last instant, rows, and the columns of each load."""
    return f"{zone.rstrip('/')}_stats"


STATS = "symbol string, first_ts timestamp, last_ts timestamp, row_count bigint, columns string, period string"


def read_stats(spark: SparkSession, zone: str, names: list[str] | None = None) -> DataFrame:
    """Statistics of a zone's periods; those of tables written by other means are missing."""
    side = stats_path(zone)
    there = [p for p in periods(spark, side) if names is None or p in set(names)]
    if not there:
        return spark.createDataFrame([], STATS)
    return spark.read.schema(STATS).option("basePath", side).parquet(*[f"{side}/period={p}" for p in there])


def without_stats(spark: SparkSession, zone: str, names: list[str]) -> list[str]:
    known = set(periods(spark, stats_path(zone)))
    return [p for p in names if p not in known]


def _schema(spark: SparkSession, zone: str, names: list[str], paths: list[str]) -> ST.StructType:
    """The union of the periods' columns, from the statistics; footers are opened only where those are missing or disagree."""
    if not without_stats(spark, zone, names):
        fields: dict[str, ST.StructField] = {}
        told = [r["columns"] for r in read_stats(spark, zone, names).select("columns").distinct().orderBy("columns").collect()]
        agree = True
        for f in (f for ddl in told for f in ST.StructType.fromDDL(ddl).fields):
            agree &= fields.setdefault(f.name, f).dataType == f.dataType
        if told and agree:
            return ST.StructType([*fields.values(), ST.StructField("period", ST.StringType())])
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("basePath", zone)
    found = reader.option("mergeSchema", True).parquet(*paths).schema
    return ST.StructType([ST.StructField("period", ST.StringType()) if f.name == "period" else f for f in found.fields])


def read_zone(spark: SparkSession, zone: str, names: list[str] | None = None) -> DataFrame:
    """Zone rows with the union of the partitions' columns. The period stays text, other files are skipped.

    With ``names`` only the folders of those periods are listed; names without a folder are left out, and
    without any the result is empty.
    """
    stored = periods(spark, zone)
    if not stored and names is not None:
        return spark.createDataFrame([], "symbol string, ts timestamp, period string")
    there = stored if names is None else [p for p in dict.fromkeys(names) if p in set(stored)]
    paths = [zone] if names is None else [f"{zone.rstrip('/')}/period={p}" for p in there or stored[-1:]]
    schema = _schema(spark, zone, there or stored[-1:], paths)
    rows = spark.read.option("pathGlobFilter", "*.parquet").option("basePath", zone).schema(schema).parquet(*paths)
    return rows if names is None else rows.where(F.col("period").isin(there))


def write_zone(rows: DataFrame, zone: str, mode: str = "append") -> None:
    """Write rows with a ``period`` column. Large periods are split over several tasks.

    Rows keep the order they have in ``rows`` (by ``load_seq`` and ``row_pos`` where it has them), so that
    the first of repeated rows is still known when a later job merges them.
    """
    if "load_seq" not in rows.columns:
        rows = rows.withColumn("load_seq", F.lit(time.time_ns()))
    if "row_pos" not in rows.columns:
        rows = rows.withColumn("row_pos", F.monotonically_increasing_id())
    rows = rows.withColumn("row_pos", F.col("row_pos").cast("decimal(38,0)"))
    spark = rows.sparkSession
    if mode != "append" or not FS.exists(spark, zone):
        _write(rows, zone, mode)
        return
    # Rows and their statistics join what is there as one set of moves.
    scratch = beside(zone, "writing")
    _write(rows, scratch, "errorifexists")
    PB.publish(spark, added_files(spark, scratch, zone), [zone], [scratch, stats_path(scratch)])


def _write(rows: DataFrame, path: str, mode: str) -> None:
    """Rows by period, and beside them what the periods hold, told from the written symbols and instants."""
    spark = rows.sparkSession
    rows.hint("rebalance", "period").sortWithinPartitions("period", "symbol", "ts").write.mode(mode).partitionBy("period").parquet(path)
    columns = ST.StructType([f for f in rows.schema.fields if f.name != "period"])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    schema = ST.StructType([*columns.fields, ST.StructField("period", ST.StringType())])
    if not periods(spark, path):
        return
    written = spark.read.option("pathGlobFilter", "*.parquet").schema(schema).parquet(path)
    told = written.groupBy("period", "symbol").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("row_count"))
    told.withColumn("columns", F.lit(ddl)).hint("rebalance", "period").write.mode(mode).partitionBy("period").parquet(stats_path(path))


def clear(spark: SparkSession, path: str) -> None:
    """Remove a scratch table with its statistics."""
    FS.remove(spark, path)
    FS.remove(spark, stats_path(path))


def ingest(bars: DataFrame, zone: str, now: Column) -> None:
    """Text bars (``symbol, ts`` and cells) -> a zone in the organised layout."""
    day = T.wall_date(F.col("ts"))
    keep = [c for c in bars.columns if c != "file_path"]
    write_zone(bars.select(*keep, P.period_for_date(day, T.wall(now)).alias("period")), zone, "errorifexists")


def backup_folder(zone: str) -> str:
    return f"{zone.rstrip('/')}_backup_{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S_%f')}"


def stack(rows: DataFrame, target: Column, rank: Column) -> DataFrame:
    """Add target, precedence and position; blank cells stay empty text.

    The position is the stored one; rows of tables without it stand as their scan does.
    """
    cells = [c for c in rows.columns if c not in ("symbol", "ts", "period", "target", "source_rank", "load_seq", "row_pos")]
    load = F.coalesce("load_seq", F.lit(0)) if "load_seq" in rows.columns else F.lit(0)
    place = F.col("row_pos") if "row_pos" in rows.columns else F.monotonically_increasing_id()
    return rows.select(
        target.alias("target"), "symbol", "ts", rank.alias("source_rank"),
        F.struct(load.cast("bigint").alias("load_seq"), place.cast("decimal(38,0)").alias("row_pos")).alias("row_pos"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cells],
    )


def swap_moves(spark: SparkSession, zone: str, scratch: str, backup: str, built: list[str], retired: list[str]) -> list[tuple[str, str]]:
    """Moves of old partitions to the backup and of new ones in, with their statistics."""
    moves = []
    for origin, goal, names in ((zone, backup, retired), (scratch, zone, built)):
        there = set(periods(spark, stats_path(origin)))
        moves += PB.folder_moves(origin, goal, names) + PB.folder_moves(stats_path(origin), stats_path(goal), [p for p in names if p in there])
    return moves


def _swap(spark: SparkSession, zone: str, scratch: str, backup: str, built: list[str], retired: list[str]) -> tuple[str, str]:
    """Move old partitions to the backup and the new ones in; put everything back on failure."""
    try:
        PB.publish(spark, swap_moves(spark, zone, scratch, backup, built, retired), [zone])
    except PB.Unsettled:
        raise
    except Exception as error:
        return "rolled_back", f"{type(error).__name__}; partitions put back"
    return "merged", ""


def merge_into(
    spark: SparkSession, zone: str, stacked: DataFrame, sources: dict[str, list[str]], apply: bool, backup: str | None = None
) -> DataFrame:
    """Merge stacked rows into their target periods; one result row per target.

    ``sources`` lists, per target, the zone's own periods that the target absorbs. A dry run only
    counts. Otherwise the merged periods are written to a new folder, read back and verified, and a
    target is swapped in only when no key is lost, foreign or repeated.
    """
    if apply:
        PB.recover(spark, zone)
    present = set(periods(spark, zone))
    outcome: dict[str, tuple[str, str]] = {}
    if not apply:
        stats = {r["target"]: r for r in M.merge_stats(stacked, KEYS, ["target"]).collect()}
    else:
        scratch = beside(zone, "periods")
        merged = M.merged_rows(stacked, KEYS).drop("source_rank", "copies", "conflict")
        write_zone(merged.withColumnRenamed("target", "period"), scratch, "errorifexists")
        written = read_zone(spark, scratch).withColumnRenamed("period", "target")
        stats = {r["target"]: r for r in M.merge_audit(stacked, written, KEYS, ["target"]).collect()}
        keep_in = backup or backup_folder(zone)
        for target in sorted(stats):
            if not stats[target]["verified"]:
                outcome[target] = ("failed", "verification of the written period failed")
                continue
            retired = [p for p in dict.fromkeys([target, *sources.get(target, [])]) if p in present]
            outcome[target] = _swap(spark, zone, scratch, keep_in, [target], retired)
        clear(spark, scratch)
    rows = [
        (
            target, " ".join(p for p in sources.get(target, []) if p != target), target in present, s["input_row_count"], s["output_row_count"],
            s["duplicate_row_count"], s["conflict_minute_count"], *outcome.get(target, ("dry_run", "")),
        )
        for target, s in sorted(stats.items())
    ]
    return spark.createDataFrame(rows, RESULT)


def _fold(spark: SparkSession, zone: str, planned: DataFrame, apply: bool) -> DataFrame:
    """Merge every period whose target is another period into that target; existing rows win."""
    order = {p: i for i, p in enumerate(periods(spark, zone))}
    plan = {r["period_str"]: r["target_period_str"] for r in planned.select("period_str", "target_period_str").collect()}
    sources: dict[str, list[str]] = {}
    for period in sorted(plan, key=order.get):
        if plan[period] != period:
            sources.setdefault(plan[period], []).append(period)
    if not sources:
        return spark.createDataFrame([], RESULT)
    involved = {period: target for target, members in sources.items() for period in members}
    involved |= {target: target for target in sources if target in order}
    ranks = [(p, t, 0 if p == t else order[p] + 1) for p, t in involved.items()]
    lookup = F.broadcast(spark.createDataFrame(ranks, "period string, target string, source_rank int"))
    rows = read_zone(spark, zone, sorted(involved)).join(lookup, "period")
    return merge_into(spark, zone, stack(rows, F.col("target"), F.col("source_rank")), sources, apply)


def organize(spark: SparkSession, zone: str, now: Column, apply: bool = False) -> DataFrame:
    """Roll days of closed months into months and everything of closed years into years."""
    PB.recover(spark, zone)
    return _fold(spark, zone, Y.rollup_plan(catalog(spark, zone), now), apply)


def clean_orphans(spark: SparkSession, zone: str, apply: bool = False) -> DataFrame:
    """Fold left-over periods into the larger period that already exists for them."""
    PB.recover(spark, zone)
    return _fold(spark, zone, Y.orphan_periods(catalog(spark, zone)), apply)


def rebuild(spark: SparkSession, source: str, target: str, now: Column, apply: bool = False, remove_stale: bool = False) -> DataFrame:
    """Rewrite a whole zone into the organised layout; rows of longer periods win.

    In place, periods that are not rebuilt are always retired, or their rows would exist twice.
    """
    if apply:
        PB.recover(spark, source, target)
    in_place = source.rstrip("/") == target.rstrip("/")
    remove_stale = remove_stale or in_place
    # Longer periods win: four digits before six before eight, then the older one.
    rank = F.concat(F.length("period").cast("string"), F.lit("-"), F.col("period"))
    day = T.wall_date(F.col("ts"))
    stacked = stack(read_zone(spark, source), P.period_for_date(day, T.wall(now)), rank)
    merged = M.merged_rows(stacked, KEYS).drop("source_rank", "copies", "conflict")
    planned = Y.rebuild_plan(merged.select(day.alias("date")), catalog(spark, target), now, remove_stale)
    if not apply:
        return planned
    plan_path = run_folder(spark, "rebuild-plan")
    planned.write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    scratch = beside(target, "rebuild")
    write_zone(merged.withColumnRenamed("target", "period"), scratch, "errorifexists")
    verdict = M.merge_verify(stacked, read_zone(spark, scratch).withColumnRenamed("period", "target"), KEYS).first()
    if not verdict["verified"]:
        clear(spark, scratch)
        raise OSError(f"verification of the rebuilt zone failed: {verdict.asDict()}")
    # In place, every old period steps aside before the first new one appears.
    built = periods(spark, scratch)
    retired = [p for p in periods(spark, target) if p in built or remove_stale]
    status, message = _swap(spark, target, scratch, backup_folder(target), built, retired)
    clear(spark, scratch)
    if status != "merged":
        raise OSError(f"the rebuilt zone was not swapped in: {message}")
    return plan


def save_stage(spark: SparkSession, new: DataFrame, staging: str, daily: bool) -> DataFrame:
    """Save text bars (``symbol, ts`` and cells) into the staging zone.

    Intraday rows replace the staged day of their symbol; daily rows join the staged year and the
    rows already staged win.
    """
    PB.recover(spark, staging)
    day = T.wall_date(F.col("ts"))
    period = F.date_format(day, "yyyy" if daily else "yyyyMMdd")
    fresh = new.withColumn("period", period)
    names = [r["period"] for r in fresh.select("period").distinct().collect()]
    parts = stack(fresh, F.col("period"), F.lit(1))
    if FS.exists(spark, staging):
        # Positions are taken from the scan itself, before any shuffle.
        stored = stack(read_zone(spark, staging, names), F.col("period"), F.lit(0))
        if not daily:
            replaced = fresh.select("symbol", F.col("period").alias("target")).distinct()
            stored = stored.join(replaced, ["symbol", "target"], "left_anti")
        parts = stored.unionByName(parts, allowMissingColumns=True).fillna("")
    return merge_into(spark, staging, parts, {}, True)


def date_rows(spark: SparkSession, zones: list[str], day: str) -> DataFrame:
    """Rows of one session date; only periods that cover it are read."""
    compact = day.replace("-", "")
    covering = [compact[:4], compact[:6], compact]
    low, high = T.instant_literal(f"{day} 00:00:00"), T.instant_literal(f"{day} 23:59:59.999999")
    parts = [read_zone(spark, zone, covering).where(F.col("ts").between(low, high)) for zone in zones]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found.drop("load_seq", "row_pos")


def beside(path: str, label: str) -> str:
    """A new folder next to a table, on the same file system, for what a job is about to move in."""
    return f"{path.rstrip('/')}_{label}_{uuid.uuid4().hex}"


def added_files(spark: SparkSession, scratch: str, zone: str) -> list[tuple[str, str]]:
    """Moves that bring the files of written periods, and of their statistics, into a zone."""
    folder = lambda root, period: f"{root.rstrip('/')}/period={period}"
    tables = [(scratch, zone), (stats_path(scratch), stats_path(zone))]
    return [move for origin, goal in tables for p in periods(spark, origin) for move in PB.file_moves(spark, folder(origin, p), folder(goal, p))]


def without_rows(spark: SparkSession, zone: str, gone: DataFrame, backup: str) -> tuple[list[str], list[tuple[str, str]]]:
    """What a zone keeps without (symbol, period) pairs, written beside it: its folders, and the moves that swap it in.

    The periods as they were go to ``backup``.
    """
    names = [r["period"] for r in gone.select("period").distinct().collect()]
    rest = read_zone(spark, zone, names).join(gone.select("symbol", "period"), ["symbol", "period"], "left_anti")
    scratch = beside(zone, "rest")
    write_zone(rest, scratch, "errorifexists")
    return [scratch, stats_path(scratch)], swap_moves(spark, zone, scratch, backup, periods(spark, scratch), names)


def drop_rows(spark: SparkSession, zone: str, gone: DataFrame, backup: str) -> None:
    """Take (symbol, period) pairs out of a zone; the periods as they were are moved to ``backup``."""
    spent, moves = without_rows(spark, zone, gone, backup)
    PB.publish(spark, moves, [zone], spent)
