"""Importance resampling of documents towards the distribution of a target table.

Features are runs of words, hashed into a fixed number of buckets. Two arrays of bucket counts (corpus
and target) give a gain for each bucket; the weight of a document is the sum of the gains of its
features. Weight plus seeded Gumbel noise is its score, and the highest scores are drawn: that is
sampling without replacement in proportion to the importance weights.

The cutoff is found by weighted median of medians. Every partition tells the median of the keys it
still holds and how many they are; the median of these medians, weighted by the counts, has at least a
quarter of all remaining keys on either side, so each round throws away a guaranteed fraction, until
the exact cutoff key is known. What is left is written anew whenever it has shrunk to a quarter, so all
rounds together read little more than the keys once. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import DataType

from candlewright.llm.common import numbered, pieces, settle, sums, text_of

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
#: Of a hundred eligible documents so many are drawn.
PERCENT = 10
#: So few remaining keys are sorted by the driver.
BASE_KEYS = 4096
#: Words whose bucket a task remembers.
KNOWN_WORDS = 1 << 20

#: A-Z become lower case; what is neither a digit, a letter nor above ASCII becomes a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class _Buckets(dict):
    """Bucket of a feature, computed once."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.n
        return bucket


def hashed_features(texts: list[bytes], known: _Buckets, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts one after another, where each text begins (one more at the end), and its words."""
    found: list[np.ndarray] = []
    words = np.zeros(len(texts), np.int64)
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        own = text.translate(_PLAIN).split()
        words[i] = len(own)
        runs = [own, *([b" ".join(own[j : j + n]) for j in range(len(own) - n + 1)] for n in range(2, longest + 1))]
        found += [np.fromiter(map(known.__getitem__, run), np.int32, len(run)) for run in runs]
        ends[i + 1] = ends[i] + sum(map(len, runs))
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), ends, words


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket: a task adds up its own array, the driver sees one number for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _Buckets(buckets), np.zeros(buckets, np.int64)
        for piece in pieces(batches, "_text"):
            held += np.bincount(hashed_features(piece.column("_text").cast(pa.binary()).to_pylist(), known, longest)[0], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(held[used])], names=["bucket", "n"])

    told = docs.select(text_of(f"`{text_col}`").alias("_text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in told.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket in thousandths of the log ratio of its smoothed shares."""
    s_all, t_all, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratio = ((float(t) + 1) * float(s_all + n) / ((float(s) + 1) * float(t_all + n)) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of seed and id."""
    mark = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(mark, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("_text"))
    names = ["doc_id", "n_features", "n_words", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gains))
        for piece in pieces(batches, "_text"):
            found, ends, words = hashed_features(piece.column("_text").cast(pa.binary()).to_pylist(), known, longest)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, (np.diff(ends), words, sums(gains[found], ends)))], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    weighed = rows.mapInArrow(weigh, f"doc_id {kind}, n_features long, n_words long, weight long")
    return weighed.withColumn("score", F.col("weight") + _noise("doc_id", seed))


#: Order of the draw: higher scores, then smaller ids, null ids last, then the place where the row was read.
_KEY = ["lost", "unknown", "id", "at"]


def _in_order(row: Row) -> tuple:
    return row["lost"], row["unknown"], 0 if row["unknown"] else row["id"], row["at"]


def _key(row: Row, kind: DataType) -> Column:
    return F.struct(F.lit(row["lost"]).alias("lost"), F.lit(row["unknown"]).alias("unknown"), F.lit(row["id"]).cast(kind).alias("id"), F.lit(row["at"]).alias("at"))


def _medians(keys: DataFrame, first: Column) -> list[Row]:
    """front, n and the lower median key of each partition, apart for keys where `first` holds and the others."""
    names = ["front", "n", *_KEY]

    def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        for front in (True, False):
            side = whole.filter(pc.equal(whole["front"], front))
            if side.num_rows:
                order = pc.sort_indices(side, sort_keys=[(c, "ascending") for c in _KEY])
                found = side.take(order.slice((side.num_rows - 1) // 2, 1)).append_column("n", pa.array([side.num_rows], pa.int64()))
                yield from found.select(names).to_batches()

    rows = keys.select(*_KEY, first.alias("front"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in _KEY)
    return rows.mapInArrow(middle, f"front boolean, n long, {kinds}").collect()


def weighted_median(medians: list[Row]) -> Row:
    """The least median so that the partitions up to it hold half of the keys or more."""
    order = sorted(medians, key=_in_order)
    half, so_far = sum(m["n"] for m in order), 0
    for m in order:
        so_far += m["n"]
        if 2 * so_far >= half:
            return m
    raise ValueError("no medians")


def cutoff(keys: DataFrame, place: int, base: int = BASE_KEYS) -> Row:
    """The key at `place` (from 1) in the order of lost, unknown, id, at; keys differ by `at` at least.

    `keys` is a written table. A round is one job: each partition tells medians and counts on both sides of
    the pivot, so the side that holds the place is known together with its own medians.
    """
    kind, key = keys.schema["id"].dataType, F.struct(*_KEY)
    medians = _medians(keys, F.lit(True))
    left = written = sum(m["n"] for m in medians)
    while left > base:
        pivot = weighted_median(medians)
        at = _key(pivot, kind)
        told = _medians(keys.where(key != at), key < at)
        before = sum(m["n"] for m in told if m["front"])
        if place == before + 1:
            return pivot
        front = place <= before
        medians = [m for m in told if m["front"] == front]
        keys = keys.where(key < at if front else key > at)
        left, place = (before, place) if front else (left - before - 1, place - before - 1)
        if 4 * left <= written:
            keys, written = settle(keys, "resample-keys"), left
    return sorted(keys.select(*_KEY).collect(), key=_in_order)[place - 1]


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, base: int = BASE_KEYS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of `docs`; rank is null for what is not drawn.

    Of the N rows with `least_words` words or more the floor(percent * N / 100) highest scores are drawn.
    Null and blank texts have no features and a weight of 0; a null id is hashed as `null` and comes last
    among equal scores. Repeated rows count each; rows that agree in id and score are told apart by where
    they were read. An empty table, or an empty target, is a distribution without counts, so only the
    smoothing is left. Other columns are not read, so their names do not matter.
    """
    gains = gains_of(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    rows = scored(docs, gains, id_col, text_col, longest, seed).withColumn("at", F.monotonically_increasing_id())
    rows = settle(rows, "resample-scores")
    keys = rows.where(F.col("n_words") >= least_words)
    keys = keys.select((-F.col("score")).alias("lost"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), "at")
    drawn = percent * keys.count() // 100
    if not drawn:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    last = _key(cutoff(keys, drawn, base), keys.schema["id"].dataType)
    winners, _ = numbered(keys.where(F.struct(*_KEY) <= last), *_KEY, label="resample-winners")
    ranks = winners.select("at", (F.col("row_number") + 1).alias("rank"))
    return rows.join(ranks, "at", "left").select("doc_id", "n_features", "weight", "score", "rank")
