"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id and content. A balanced Feistel network permutes the
smallest even-bit domain that holds all numbers; walking its cycles until a value falls below the
row count restricts it to exactly the numbers in use. The permuted number gives shard (remainder)
and slot (quotient), so both can be computed, and inverted, from the row number alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from candlewright.llm.common import numbered, text_of

ROUNDS = 6
SEED = 20_240_601


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mix(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    """Round function: a keyed multiply-and-shift hash of one half."""
    x = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & np.uint64((1 << bits) - 1)


def _keys(seed: int) -> list[int]:
    return [(seed * 0x2545F4914F6CDD1D + r * 0x632BE59BD9B4E019) % (1 << 64) for r in range(1, ROUNDS + 1)]


def permute(numbers: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """A permutation of 0..n-1 applied to `numbers`."""
    bits = _half_bits(n)
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    keys = _keys(seed)[::-1] if inverse else _keys(seed)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for key in keys:
            if inverse:
                left, right = right ^ _mix(left, key, bits), left
            else:
                left, right = right, left ^ _mix(right, key, bits)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """Row number found at a shard and slot."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, inverse=True)


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number of every row.

    Law `rows`: shard sizes differ by one row at most and slots have no gaps; `grown_shard` is null.
    Null texts count as empty, null ids come first in the numbering; rows that agree in id and text are
    told apart by where they were read, so that the sort can split them, and may stand for each other. Copies of one text are spread
    over all shards. An empty table gives an empty result; other columns are not read.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("digest"),
        F.monotonically_increasing_id().alias("read_at"),
    )
    ordered, n = numbered(rows, "doc_id", "text_crc32", "size", "digest", "read_at", label="shards")
    names = ["doc_id", "size", "text_crc32", "row_number", "shard", "slot"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = permute(batch.column("row_number").to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to % shards, pa.int32()), pa.array(to // shards)], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    placed = ordered.select(names[:4]).mapInArrow(place, f"doc_id {kind}, size long, text_crc32 long, row_number long, shard int, slot long")
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "row_number")
