"""Helpers shared by the training-data operators: reading, scratch tables, bounded pieces, words."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import candlewright
from candlewright.session import run_folder

#: A word is a longest run of code points that are none of these six.
SPACES = " \t\n\x0b\x0c\r"

#: Bytes of text a task works on at once. A longer single text makes a piece of its own.
PIECE_BYTES = 8 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: their Python may not find the driver's copy."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(candlewright.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="candlewright-code-")) / "candlewright.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, for a query whose tasks run code of this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch tables written since a job began to gather them, or None.
_gathered: ContextVar[list[str] | None] = ContextVar("gathered", default=None)


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there and positions are fixed."""
    path = run_folder(frame.sparkSession, label)
    frame.write.parquet(path, compression="zstd")
    written = frame.sparkSession.read.schema(frame.schema).parquet(path)
    written.scratch_path = path
    if (gathered := _gathered.get()) is not None:
        gathered.append(path)
    return written


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of scratch tables, wherever the shared folder lies."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Delete settled tables that nothing reads any more; other frames stay as they are."""
    for frame in frames:
        if path := getattr(frame, "scratch_path", None):
            remove(frame.sparkSession, path)


@contextmanager
def gathering() -> Iterator[list[str]]:
    """The paths of the scratch tables that are written inside."""
    mark = _gathered.set([])
    try:
        yield _gathered.get()
    finally:
        _gathered.reset(mark)


def flagged(rows: DataFrame, at: str, chosen: DataFrame, flag: str) -> DataFrame:
    """`rows` and `flag`: whether the row's number `at` is among those of `chosen` (one column of longs, 0 or more).

    No row is shuffled: the chosen numbers go to every task as bitmaps, a bit for each row. Numbers may have gaps, as
    those of `monotonically_increasing_id` have, but should lie close inside a part.
    """
    chosen = chosen.toDF("_n")
    bits = chosen.groupBy(F.bitmap_bucket_number("_n").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("_bits"))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1
    met = rows.join(F.broadcast(bits), F.bitmap_bucket_number(at) == F.col("_bucket"), "left")
    return met.withColumn(flag, F.coalesce(held, F.lit(False))).drop("_bucket", "_bits")


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text in built-in functions; null and blank texts have none."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose `column` holds about `most` bytes or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths + 1)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return to the system what this process has freed: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


Batches = Iterator[pa.RecordBatch]


def sparing(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function of a mapInArrow, giving back what it has freed when its task ends.

    A worker outlives its task, and what it keeps counts as the executor's memory while later stages run.
    """

    @wraps(work)
    def run(batches: Batches) -> Batches:
        yield from work(batches)
        give_back()

    return run


def strings(column: pa.Array) -> pa.StringArray:
    """Text column without nulls."""
    return pc.fill_null(column.cast(pa.string()), "")


def words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All words of the texts in order, and for each text the place of its first word (one entry more at the end)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    counts = np.bincount(of[filled], minlength=len(texts))
    return flat.filter(pa.array(filled)), np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each slice values[offsets[i]:offsets[i + 1]]."""
    running = np.concatenate(([0], np.cumsum(values)))
    return running[offsets[1:]] - running[offsets[:-1]]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the slices [start, start + count), one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def numbered(frame: DataFrame, *order: Column | str, label: str = "order") -> tuple[DataFrame, int]:
    """The sorted frame with `row_number` from 0, and its length.

    Sorted parts are written once; the driver sees one count for each part. Rows that agree in all
    sort columns take any order among themselves.
    """
    spark = frame.sparkSession
    at = settle(frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    counts = sorted((r["part"], r["n"]) for r in at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    bases = F.broadcast(spark.createDataFrame(starts, "_part long, _base long"))  # one row for each sorted part
    joined = at.join(bases, part == F.col("_part"))
    return joined.withColumn("row_number", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_base"), total
