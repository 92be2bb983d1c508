"""Exact dedup by an extendible-hash index on shared files.

Every text has a 64-bit key. A directory of 2^depth cells, addressed by the leading bits of the key,
names the bucket of each key range; an overfull bucket splits in two, and the directory doubles when
that bucket was addressed by as many bits as the directory has. One owner task takes each bucket,
walks its keys in order, chains different texts that share a key, and compares bytes along the chain.

Copies are folded where they are read: a task compares texts of the piece it holds byte by byte and
sends one entry for each different text with the rows that carry it. A text that makes up a third of
all rows reaches the owners as a few entries for each task, and its rows never meet in one place: they
stay with their entry and get the verdict by entry number.

Every entry's key goes to its owner; its text goes along only if another entry has the same key, since a chain
of one has nothing to compare. The verdict returns to the entries as a bit for each, so no text moves for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from candlewright.llm.common import flagged, pieces, settle, sparing, strings

#: A bucket with more entries splits.
BUCKET_ENTRIES = 8192
#: The directory has at most 2^16 cells; a bucket at this depth keeps what it has.
MAX_DEPTH = 16
#: Entries of one key that one owner takes; more go to several owners first.
KEY_ENTRIES = 512


def key_of(data: bytes) -> int:
    """Signed 64-bit key of a text."""
    value = xxhash.xxh64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


class Directory:
    """Directory of an extendible-hash index over key counts by leading bits.

    `counts` maps a cell of `max_depth` leading bits to its number of entries. The directory starts
    with one bucket and splits overfull buckets until each fits or has `max_depth` bits.
    """

    def __init__(self, counts: dict[int, int], capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH):
        self.depth = 0
        self.cells = [0]
        self.local = [0]
        held = [dict(counts)]
        waiting = [0]
        while waiting:
            bucket = waiting.pop()
            if sum(held[bucket].values()) <= capacity or self.local[bucket] == max_depth:
                continue
            if self.local[bucket] == self.depth:
                self.cells = [b for b in self.cells for _ in (0, 1)]
                self.depth += 1
            self.local[bucket] += 1
            self.local.append(self.local[bucket])
            new, bit = len(held), max_depth - self.local[bucket]
            held.append({c: n for c, n in held[bucket].items() if c >> bit & 1})
            held[bucket] = {c: n for c, n in held[bucket].items() if not c >> bit & 1}
            first = self.cells.index(bucket)
            span = 1 << (self.depth - self.local[bucket])
            self.cells[first + span : first + 2 * span] = [new] * span
            waiting += [bucket, new]

    def frame(self, spark: SparkSession) -> DataFrame:
        """cell, bucket: at most 2^max_depth rows."""
        return spark.createDataFrame(list(enumerate(self.cells)), "cell long, bucket long")


def _entries(docs: DataFrame, text_col: str, id_col: str, keep_rows: bool) -> DataFrame:
    """One row for each different text of a piece: key, digest, text, and the rows that carry it."""
    rest = [f for f in docs.schema.fields if f.name == id_col or keep_rows and f.name != text_col]
    held = StructType([docs.schema[text_col], *rest])
    inner = pa.struct([pa.field(f.name, to_arrow_type(f.dataType)) for f in rest])
    narrow = docs.select(F.col(text_col).alias("t"), F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("r"))
    kind = StructType(held.fields[1:]).simpleString()
    id_at = [f.name for f in rest].index(id_col)
    schema = f"entry long, key long, sha256 string, text string, is_null boolean, best long, best_at int, n long, members array<{kind}>"

    @sparing
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = TaskContext.get().partitionId() << 33
        for piece in pieces(batches, "t"):
            texts = strings(piece.column("t")).to_pylist()
            ids = pc.struct_field(piece.column("r"), [id_at]).to_pylist()
            groups: dict[str, list[int]] = {}
            for i, text in enumerate(texts):
                groups.setdefault(text, []).append(i)
            order = [i for rows in groups.values() for i in rows]
            ends = [0]
            for rows in groups.values():
                ends.append(ends[-1] + len(rows))
            best = [max(range(len(rows)), key=lambda k: (ids[rows[k]] is not None, ids[rows[k]] or 0, -k)) for rows in groups.values()]
            data = [text.encode() for text in groups]
            members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), piece.column("r").take(pa.array(order)).cast(inner))
            columns = [
                pa.array(range(entry, entry + len(groups)), pa.int64()),
                pa.array(map(key_of, data), pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in data]),
                pa.array(list(groups), pa.string()),
                pa.array([piece.column("t")[rows[0]].as_py() is None for rows in groups.values()]),
                pa.array([ids[rows[k]] for rows, k in zip(groups.values(), best)], pa.int64()),
                pa.array(best, pa.int32()),
                pa.array(map(len, groups.values()), pa.int64()),
                members,
            ]
            entry += len(groups)
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "key", "sha256", "text", "is_null", "best", "best_at", "n", "members"])

    return narrow.mapInArrow(fold, schema)


@sparing
def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of equal keys over rows in key order: for each entry the head of its chain link and the link's totals.

    An entry that is alone with its key comes without its text.
    """
    names = ["entry", "head", "keep_id", "keep_entry", "group_size"]
    out: list[tuple] = []
    chain: list[list] = []  # [text, entries, n, best, entry of best]
    key = None

    def close() -> None:
        for _, entries, n, best, by in chain:
            out.extend((e, entries[0], best, by, n) for e in entries)
        chain.clear()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names=names)
        out.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "entry", "n", "best", "text")]
        for k, entry, n, best, text in zip(*columns):
            if k != key:
                close()
                key = k
            for link in chain:
                if link[0] == text:
                    link[1].append(entry)
                    link[2] += n
                    if (best is not None, best or 0, -entry) > (link[3] is not None, link[3] or 0, -link[4]):
                        link[3:] = best, entry
                    break
            else:
                chain.append([text, [entry], n, best, entry])
        if len(out) > 10_000:
            yield flush()
    close()
    yield flush()


def _owned(entries: DataFrame, parts: list) -> DataFrame:
    dealt = entries.repartition(*parts).sortWithinPartitions(*parts, "key", "entry")
    schema = "entry long, head long, keep_id long, keep_entry long, group_size long"
    return dealt.select("key", "entry", "n", "best", "text").mapInArrow(_walk, schema)


def directory_of(entries: DataFrame, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> Directory:
    """Directory for the keys of `entries`; the driver sees at most 2^max_depth counts."""
    cell = F.shiftrightunsigned("key", 64 - max_depth)
    counts = entries.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    return Directory({r["cell"]: r["n"] for r in counts}, capacity, max_depth)


def resolve(entries: DataFrame, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH, key_entries: int = KEY_ENTRIES) -> DataFrame:
    """entry, keep_id, keep_entry, group_size of every entry of the index.

    Keys with more than `key_entries` entries are dealt to several owners, whose chain heads then
    meet in the bucket of the key, so no owner reads an unbounded number of copies of a text.
    """
    directory = directory_of(entries, capacity, max_depth)
    cells = F.broadcast(directory.frame(entries.sparkSession))
    cell = F.shiftrightunsigned("key", 64 - directory.depth) if directory.depth else F.lit(0)
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    chained = settle(entries.select("entry", "key").join(counts, "key").select("entry", "key", "copies"), "dedup-chained")
    sent = F.when(F.col("chained"), F.col("text")).alias("text")
    slim = flagged(entries.select("entry", "key", "text", "n", "best"), "entry", chained.select("entry"), "chained").select("entry", "key", sent, "n", "best")
    crowded = chained.where(F.col("copies") > key_entries).select("key", "copies").distinct()
    if crowded.isEmpty():
        return _owned(slim.join(cells, cell == F.col("cell")), ["bucket"]).drop("head")

    lane = F.pmod(F.xxhash64("entry"), F.ceil(F.col("copies") / key_entries))
    lanes = settle(_owned(slim.join(crowded, "key").withColumn("lane", lane), ["key", "lane"]), "dedup-lanes")
    heads = lanes.where("entry = head").select("entry", F.col("group_size").alias("n"), F.col("keep_id").alias("best"))
    heads = slim.drop("n", "best").join(heads, "entry").select(slim.columns)
    rest = slim.join(crowded, "key", "left_anti")
    owned = settle(_owned(rest.unionByName(heads).join(cells, cell == F.col("cell")), ["bucket"]), "dedup-owners")
    # A link that won by the head of a lane is kept by the entry that won inside the lane.
    real = lanes.where("entry = head").select(F.col("entry").alias("keep_entry"), F.col("keep_entry").alias("real"))
    owned = owned.join(real, "keep_entry", "left").withColumn("keep_entry", F.coalesce("real", "keep_entry"))
    verdict = ["keep_id", "keep_entry", "group_size"]
    single = owned.join(lanes, "entry", "left_anti").select("entry", *verdict)
    laned = lanes.select("entry", "head").join(owned.select(F.col("entry").alias("head"), *verdict), "head")
    return single.unionByName(laned.select("entry", *verdict))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest id
    stays; null ids come last, and of rows that tie on the id exactly one stays. Ids are integers; other
    types fail. An empty table gives an empty result. Other columns are not read, so their names do not matter.
    """
    entries = settle(_entries(docs, text_col, id_col, False), "dedup-index")
    told = entries.select("entry", "sha256", "best_at", "members").join(resolve(entries), "entry")
    rows = told.select("*", F.posexplode("members").alias("at", "member"))
    kept = (F.col("entry") == F.col("keep_entry")) & (F.col("at") == F.col("best_at"))
    return rows.select(F.col("member").getField(id_col).alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.col("sha256").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns under the rules of `exact_dedup`."""
    entries = settle(_entries(docs, text_col, id_col, True), "dedup-index")
    winners = resolve(entries).where("entry = keep_entry").select("entry")
    member = F.get("members", F.col("best_at"))
    text = F.when(~F.col("is_null"), F.col("text"))
    stay = flagged(entries, "entry", winners, "stays").where("stays").select(text.alias("t"), member.alias("m"))
    return stay.select(*[F.col("t").alias(c) if c == text_col else F.col("m").getField(c).alias(c) for c in docs.columns])
