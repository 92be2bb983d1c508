"""Blocks of texts: packed columns of numbers, and tables whose blocks are met again without a shuffle."""

from __future__ import annotations

import math
import struct
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from candlewright.session import run_folder

#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
#: Buckets of words grow with the root of the text, as do the words of a bucket: so neither the rows of
#: blocks and buckets nor the words that one owner holds grow faster.
LEAST_BUCKETS = 32
#: Files that blocks are bucketed into, so that answers come to them without moving them again.
MAX_FILES = 20_000

_zip = zstandard.ZstdCompressor(level=3)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value: their number, kinds and lengths, then each by planes of equal significance."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes()
        parts.append((a.dtype.str.encode().ljust(4), planes))
    head = struct.pack("<I", len(parts)) + b"".join(kind + struct.pack("<Q", len(data)) for kind, data in parts)
    return _zip.compress(head + b"".join(data for _, data in parts))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(value)
    (n,) = struct.unpack_from("<I", raw)
    out, at = [], 4 + 12 * n
    for i in range(n):
        kind = np.dtype(raw[4 + 12 * i : 8 + 12 * i].decode().strip())
        (size,) = struct.unpack_from("<Q", raw, 8 + 12 * i)
        data = np.frombuffer(raw, np.uint8, size, at)
        out.append(data.reshape(kind.itemsize, -1).T.copy().view(kind).ravel() if kind.itemsize > 1 else data.view(kind))
        at += size
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest unsigned type that holds them all."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def split(lengths: np.ndarray, data: np.ndarray) -> list[bytes]:
    """Values of the given lengths that stand one after another in `data`."""
    raw, out, start = data.tobytes(), [], 0
    for end in np.cumsum(lengths, dtype=np.int64).tolist():
        out.append(raw[start:end])
        start = end
    return out


def measures(docs: DataFrame, text_col: str, block_bytes: int = 0) -> tuple[int, int]:
    """Number of word buckets and of block files for the texts of `docs`."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(LEAST_BUCKETS, math.isqrt(size >> 20)), max(1, min(MAX_FILES, size // (block_bytes or BLOCK_BYTES)))


def write_blocks(exploded: DataFrame, files: int, label: str) -> DataFrame:
    """The table, bucketed by its column `block`, written to the shared folder and read back."""
    spark = exploded.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    exploded.write.bucketBy(files, "block").option("path", run_folder(spark, label)).option("compression", "zstd").format("parquet").saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files lie outside the warehouse
    return written


def answered(blocks: DataFrame, answers: DataFrame, files: int) -> DataFrame:
    """`blocks` (of `write_blocks`) with `answers`: an array of the (bucket, packed) rows for each block."""
    by_block = answers.repartition(files, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "packed")).alias("answers"))
    return blocks.hint("merge").join(by_block, "block", "left")


def in_order(answers: list | None) -> list[list[np.ndarray]]:
    """Unpacked answers of one block by bucket."""
    return [unpack(a["packed"]) for a in sorted(answers or [], key=lambda a: a["bucket"])]
