"""Readers for bar text, typed zone tables and single documents."""

from __future__ import annotations

import csv
import re
from datetime import date, datetime
from decimal import Decimal
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewright import schema as S
from candlewright.functions import periods as P, times as T
from candlewright.sources import files as FS


def _names(header: str) -> tuple[str, ...]:
    """Column names of a header line; a repeated name gets a number behind it."""
    names: list[str] = []
    for cell in next(csv.reader([header]), []):
        seen = names.count(cell)
        names.append(f"{cell}.{seen}" if seen else cell)
    return tuple(names)


def layouts(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The paths by the columns of their header line, in the order of the list; files without a line are left out.

    One job reads the first block of every file and keeps its first line, and brings the files of one
    header together; the driver opens nothing and sees one row for each layout. The number of rows in
    front of a line inside a task orders the lines, since a block is read by one task.
    """
    if not paths:
        return {}
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").withColumn("at", F.monotonically_increasing_id())
    # The set makes Spark hash the few files of a task instead of sorting their lines.
    headers = first.groupBy("path").agg(F.min_by("value", "at").alias("header"), F.collect_set(F.lit(True)).alias("_"))
    found = headers.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    given = {FS.qualified(spark, path): (i, path) for i, path in enumerate(paths)}
    grouped: dict[tuple[str, ...], list[tuple[int, str]]] = {}
    for row in found:
        members = [given.get(FS.bare(path)) or given.get(FS.bare(unquote(path))) or (len(paths), unquote(path)) for path in row["paths"]]
        grouped.setdefault(_names(row["header"]), []).extend(members)
    ordered = {header: [path for _, path in sorted(members)] for header, members in grouped.items()}
    place = {path: i for i, path in enumerate(paths)}
    return dict(sorted(ordered.items(), key=lambda item: place.get(item[1][0], len(paths))))


def read_bar_text(spark: SparkSession, paths: list[str], symbol: str | None = None) -> DataFrame:
    """Bar files with every cell as text, blanks as empty text, plus the instant ``ts``.

    Files are grouped by their header line in one job, so each layout is one scan; the layouts are then
    united by column name. Repeated columns (``date.1``) are dropped. ``row_pos`` orders the rows as the caller
    listed the files and as they stand in each file, however Spark packs files into tasks.
    """
    parts = []
    for header, members in layouts(spark, paths).items():
        kept = [c for c in header if not re.fullmatch(r".+\.\d+", c)]
        raw = spark.read.option("header", True).schema(S.text_schema(list(header))).csv(members)
        cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in kept]
        # A block of a file is read by one task, in order, so the count inside the task orders its rows.
        places = [F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_row")]
        parts.append(raw.select(*cells, F.col("_metadata.file_path").alias("file_path"), *places))
    if not parts:
        raise ValueError("no bar files given, or none with a header")
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    ranks = [(FS.qualified(spark, path), rank) for rank, path in enumerate(dict.fromkeys(paths))]
    listed = spark.createDataFrame(ranks, "_path string, _rank long")  # one row for each listed file: Spark knows its size
    encoded = F.regexp_replace("file_path", "^[A-Za-z0-9+.-]+:/*", "")
    name = F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)  # blanks and the like are escaped there
    step = lambda n: F.lit(Decimal(10) ** n)
    position = F.col("_rank").cast("decimal(12,0)") * step(25) + F.col("_block").cast("decimal(15,0)") * step(10) + F.col("_row").cast("decimal(10,0)")
    rows = united.fillna("").join(listed, name == F.col("_path"), "left").withColumn("ts", T.instant(F.col("timestamp")))
    rows = rows.withColumn("row_pos", position.cast("decimal(38,0)")).drop("_path", "_rank", "_block", "_row")
    return rows.withColumn("symbol", F.lit(symbol)) if symbol is not None else rows


def read_timestamps(spark: SparkSession, paths: list[str], symbol: str) -> DataFrame:
    """Only the instants of bar files; no other column is parsed."""
    return read_bar_text(spark, paths, symbol).select("symbol", "ts")


def file_period(file_path: str = "file_path"):
    """Period of the file a row came from."""
    return P.period_of_file(F.element_at(F.split(F.col(file_path), "/"), -1))


def _checked_paths(paths: list[str], first: object, last: object) -> None:
    if not isinstance(paths, list) or not paths:
        raise ValueError("a non-empty list of paths is required")
    for bound in (first, last):
        if bound is not None and not isinstance(bound, (date, datetime)):
            raise ValueError(f"{bound!r} is not a date or datetime")


def read_zone(
    spark: SparkSession, paths: list[str], first: datetime | None = None, last: datetime | None = None, work: bool = False, ordered: bool = False
) -> DataFrame:
    """Typed zone rows. Bounds, when given, really filter. ``work`` adds the Qatar clock."""
    _checked_paths(paths, first, last)
    names = [c for c in S.ZONE_TYPES if work or c != "qatar_timestamp"]
    raw = spark.read.option("header", True).csv(paths)
    frame = raw.select(*[F.col(c).try_cast(S.ZONE_TYPES[c]).alias(c) for c in names])
    if first is not None:
        frame = frame.where(F.col("ny_timestamp") >= F.lit(first))
    if last is not None:
        frame = frame.where(F.col("ny_timestamp") <= F.lit(last))
    return frame.sort("ny_timestamp") if ordered else frame


def read_one(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """One CSV / Parquet / JSON path; nothing when it is missing or cannot be read."""
    if not FS.exists(spark, path):
        return None
    try:
        reader = spark.read
        if kind == "csv":
            reader = reader.option("header", True)
        return reader.format(kind).load(path)
    except Exception:
        # Spark reports an unreadable file while it looks for the schema.
        return None


def read_many(spark: SparkSession, paths: list[str], kind: str) -> DataFrame | None:
    """All readable paths united by column name; missing and unreadable ones are skipped.

    Parquet and JSON are one scan; CSV is one scan per header line.
    """
    there = FS.present(spark, paths)
    if kind == "csv":
        frames = [spark.read.option("header", True).csv(members) for members in layouts(spark, there).values()]
        if not frames:
            return None
        united = frames[0]
        for frame in frames[1:]:
            united = united.unionByName(frame, allowMissingColumns=True)
        return united
    if not there:
        return None
    reader = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    try:
        return reader.option("mergeSchema", True).parquet(*there) if kind == "parquet" else reader.format(kind).load(there)
    except AnalysisException:
        # No path was readable, so no schema could be found.
        return None


def read_prefix(spark: SparkSession, folder: str, kind: str) -> DataFrame | None:
    """Every file of a kind under a folder."""
    return read_many(spark, [e.path for e in FS.listing(spark, folder) if FS.has_extension(e.path, kind)], kind)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Top-level keys of JSON documents as ``key, value``; a list at the root counts as absent."""
    text = spark.read.text(path, wholetext=True).where(F.ltrim("value").startswith("{"))
    pairs = F.from_json("value", "map<string,string>")
    return text.select(F.explode(pairs).alias("key", "value"))
