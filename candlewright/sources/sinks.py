"""Writers: access modes, append-only logs, documents, reports and guarded weeks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from candlewright.operators import merge as M
from candlewright.plans import publish as PB
from candlewright.session import run_folder
from candlewright.sources import files as FS

# The one-letter access modes.
MODES = {"W": "overwrite", "A": "append", "I": "ignore", "N": None}


def write_table(frame: DataFrame, path: str, kind: str, mode: str = "I", all_text: bool = False) -> bool:
    """Write under an access mode; returns whether anything was written.

    W replaces, A appends, I keeps what exists, N writes nothing. An empty frame is never written.
    """
    letter = mode.upper()
    if letter not in MODES:
        raise ValueError(f"access mode {mode!r} is not one of {sorted(MODES)}")
    spark = frame.sparkSession
    if letter == "N" or letter == "I" and FS.exists(spark, path):
        return False
    if all_text:
        frame = frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
    # The rows are computed once: they go beside the table, which tells whether there are any.
    scratch = f"{path.rstrip('/')}_writing_{uuid.uuid4().hex}"
    counted = Observation()
    writer = frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    elif kind == "parquet":
        writer = writer.option("compression", "snappy")
    writer.save(scratch)
    if not counted.get["rows"]:
        FS.remove(spark, scratch)
        return False
    if letter != "A" or not FS.exists(spark, path):
        _take_place(spark, scratch, path)
        return True
    for entry in FS.listing(spark, scratch):
        if entry.name.startswith("part-"):
            FS.move(spark, entry.path, f"{path.rstrip('/')}/{entry.name}")
    FS.remove(spark, scratch)
    return True


def _take_place(spark: SparkSession, scratch: str, path: str) -> None:
    """Put a written folder where another may stand; the other comes back if that fails."""
    old = f"{path.rstrip('/')}_replaced_{uuid.uuid4().hex}"
    there = FS.exists(spark, path)
    if there:
        FS.move(spark, path, old)
    try:
        FS.move(spark, scratch, path)
    except Exception:
        if there:
            FS.move(spark, old, path)
        raise
    if there:
        FS.remove(spark, old)


def _log_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def append_log(rows: DataFrame, path: str, columns: list[str]) -> bool:
    """Append rows in the fixed column order; columns that are not known yet stay empty."""
    return write_table(_log_rows(rows, columns), path, "parquet", "A")


def stage_log(rows: DataFrame, path: str, columns: list[str]) -> str:
    """Write log rows beside the log, to be moved in together with what they tell of."""
    scratch = f"{path.rstrip('/')}_logging_{uuid.uuid4().hex}"
    _log_rows(rows, columns).write.option("compression", "snappy").parquet(scratch)
    return scratch


def write_report(frame: DataFrame, path: str) -> bool:
    """A report as CSV with a header. It is written by as many tasks as the report has partitions."""
    return write_table(frame, path, "csv", "W")


#: Keys and characters of a document that may stand in one JSON object: it is one row of one task.
DOCUMENT_KEYS, DOCUMENT_CHARS = 100_000, 64 << 20


def _fragments(new: DataFrame) -> DataFrame:
    """key and value with the value as JSON: what reads as JSON stays, anything else is a string, null is null."""
    fragment = F.when(F.try_parse_json("value").isNotNull(), F.col("value")).otherwise(F.regexp_replace(F.to_json(F.array("value")), r"(?s)^\[(.*)\]$", "$1"))
    return new.select("key", F.coalesce(fragment, F.lit("null")).alias("value"))


def _skips(spark: SparkSession, path: str, letter: str) -> bool:
    return letter not in MODES or letter == "N" or letter == "I" and FS.exists(spark, path)


def upsert_pairs(new: DataFrame, path: str, mode: str = "I") -> bool:
    """A document of any size: its top-level keys as a table of ``key, value`` (JSON), written by as many tasks as it takes.

    Mode A merges by key: a new value replaces the old one and is not merged deeper. The merged table is
    written beside the stored one and takes its place.
    """
    spark = new.sparkSession
    letter = mode.upper()
    if _skips(spark, path, letter):
        return False
    rows = _fragments(new)
    stored = spark.read.schema("key string, value string").parquet(path) if letter == "A" and FS.exists(spark, path) else None
    merged = M.kv_upsert(rows.where("false") if stored is None else stored, rows)
    scratch = f"{path.rstrip('/')}_writing_{uuid.uuid4().hex}"
    merged.write.parquet(scratch)
    _take_place(spark, scratch, path)
    return True


def upsert_document(new: DataFrame, path: str, mode: str = "I") -> bool:
    """Write ``key, value`` rows as one JSON object; mode A merges top-level keys into the stored ones.

    A new value replaces the old one and is not merged deeper; stored values keep their JSON type. A value
    that reads as JSON is written as such, any other as a string. The object is one row, so its size is
    checked first: beyond DOCUMENT_KEYS or DOCUMENT_CHARS nothing is written (see ``upsert_pairs``).
    """
    spark = new.sparkSession
    letter = mode.upper()
    if _skips(spark, path, letter):
        return False
    rows = _fragments(new)
    if letter == "A" and FS.exists(spark, path):
        text = spark.read.text(path, wholetext=True).where(F.ltrim("value").startswith("{"))
        stored = text.select(F.explode(F.from_json("value", "map<string,variant>")).alias("key", "value"))
        rows = M.kv_upsert(stored.select("key", F.to_json("value").alias("value")), rows)
    size = rows.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(F.length("key") + F.length("value")), F.lit(0)).alias("chars")).first()
    if size["keys"] > DOCUMENT_KEYS or size["chars"] > DOCUMENT_CHARS:
        raise ValueError(f"{size['keys']} keys with {size['chars']} characters are too many for one JSON object")
    quoted = F.to_json(F.array("key"))
    member = F.concat(quoted.substr(F.lit(2), F.length(quoted) - 2), F.lit(": "), "value")
    text = F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(member)), ", "), F.lit("}"))
    scratch = f"{path.rstrip('/')}_writing_{uuid.uuid4().hex}"
    rows.agg(text.alias("value")).write.text(scratch)
    _take_place(spark, scratch, path)
    return True


def write_weeks(weeks: DataFrame, path: str, order: str = "ny_timestamp") -> DataFrame:
    """Write week partitions behind the snapshot guard; returns the action per week.

    Equal weeks are left alone, new and grown weeks are written, and a week with fewer rows than the
    stored one stops the job before anything is written. Changed weeks are written beside the table, their
    rows counted, and swapped in as one set of moves: on an error the old weeks come back, and a swap that
    is lost half way is completed by the next load.
    """
    spark: SparkSession = weeks.sparkSession
    PB.recover(spark, path)
    stored = spark.read.schema(weeks.schema).parquet(path) if FS.exists(spark, path) else weeks.limit(0)
    plan_path = run_folder(spark, "week-plan")
    M.snapshot_guard(stored.select(weeks.columns), weeks, ["week"]).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    shrunk = plan.where(F.col("action") == "error")
    if not shrunk.isEmpty():
        names = [r["week"] for r in shrunk.select("week").orderBy("week").limit(10).collect()]
        raise ValueError(f"weeks with fewer rows than stored: {names}")
    changed = plan.where(F.col("action").isin("write", "overwrite")).select("week", "new_rows")
    scratch, old = (f"{path.rstrip('/')}_{label}_{uuid.uuid4().hex}" for label in ("swapping", "swapped"))
    (
        weeks.join(changed.select("week"), "week", "left_semi")
        .hint("rebalance", "week")
        .sortWithinPartitions("week", order)
        .write.partitionBy("week")
        .parquet(scratch)
    )
    written = spark.read.schema(weeks.schema).parquet(scratch).groupBy(F.col("week").cast("string").alias("week")).agg(F.count(F.lit(1)).alias("rows"))
    off = changed.join(written, "week", "left").where(~F.col("new_rows").eqNullSafe(F.col("rows")))
    if not off.isEmpty():
        FS.remove(spark, scratch)
        raise OSError("verification of the changed weeks failed; the stored ones are as they were")
    names = [e.name for e in FS.listing(spark, scratch) if e.is_folder and e.name.startswith("week=")]
    there = {e.name for e in FS.listing(spark, path)}
    root = path.rstrip("/")
    moves = [(f"{root}/{n}", f"{old}/{n}") for n in names if n in there] + [(f"{scratch}/{n}", f"{root}/{n}") for n in names]
    PB.publish(spark, moves, [path], [scratch, old])
    if names:
        spark.catalog.refreshByPath(path)
    return plan
