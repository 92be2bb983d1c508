"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens. A task works through blocks of texts: it explodes a block into its
different words and, for every text, the positions where each word stands (the word's slot in the
block, in text order). Words are dealt by hash to buckets; the owner of a bucket meets each different
word of the corpus and encodes it once, and the ids go back to the block, where they are put together
by position. A word therefore travels once for each block, however often it occurs, and a block is
bounded, so that neither a frequent word nor a long text gathers rows in one task.

What travels is packed: the words of one block and bucket are one row, and so are the positions of one
block. Decoding joins ids to the table of token bytes, whose size is that of the vocabulary.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewright.llm import blocks
from candlewright.llm.blocks import narrow, pack, split, unpack
from candlewright.llm.common import pieces, ragged, strings
from candlewright.llm.fertility import encoding_of, ranks_of

#: Most frequent words of a block, whose slots come first.
FRONT = 4096


class Block:
    """Different words of a block and the positions of its texts."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = defaultdict(count().__next__)
        self.places: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []
        self.bytes = 0

    def add(self, rows: pa.RecordBatch, texts: list[str], matches) -> None:
        slot = self.slots.__getitem__
        for text in texts:
            found = matches(text)
            self.places.append(np.fromiter(map(slot, found), np.int32, len(found)))
            self.bytes += len(text) + 1
        self.rows.append(rows)

    def packed(self, buckets: int) -> tuple[bytes, list[tuple[int, bytes]]]:
        """The positions, and for each bucket its words; words of a bucket are in code-point order."""
        lengths = np.array([len(p) for p in self.places], np.uint32)
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.int32)
        names = list(self.slots)
        data = [name.encode() for name in names]
        bucket = np.fromiter((xxhash.xxh32_intdigest(d) for d in data), np.uint32, len(data)) % np.uint32(buckets)
        order = np.array(sorted(range(len(data)), key=data.__getitem__), np.int64)
        order = order[np.argsort(bucket[order], kind="stable")]
        occurrences = np.bincount(places, minlength=len(names))
        front = np.sort(np.argsort(-occurrences, kind="stable")[:FRONT])
        front = front[np.argsort(-occurrences[front], kind="stable")]
        # New slots: frequent words first, then all words by bucket and name (the frequent ones leave holes).
        where = np.empty(len(names), np.int64)
        where[order] = np.arange(len(names))
        new = where + len(front)
        new[front] = np.arange(len(front))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        words = []
        for b in range(buckets):
            own = [data[i] for i in order[edges[b] : edges[b + 1]]]
            if own:
                words.append((b, pack(narrow(np.array(list(map(len, own)))), np.frombuffer(b"".join(own), np.uint8))))
        return pack(lengths, narrow(where[front]), narrow(new[places])), words


def _exploded(docs: DataFrame, row: list, text_col: str, buckets: int, pattern: str) -> DataFrame:
    """block, bucket, packed, rows: a row without bucket for each block, and one for each of its buckets."""
    narrow = docs.select(F.struct(*row).alias("row"), F.col(text_col).alias("text"))
    kind = narrow.schema["row"].dataType
    inner = to_arrow_type(kind)
    block_bytes = blocks.BLOCK_BYTES

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() << 33

        def flush(block: Block) -> pa.RecordBatch:
            places, words = block.packed(buckets)
            rows = pa.concat_arrays([r.column("row").cast(inner) for r in block.rows])
            lists = pa.ListArray.from_arrays(pa.array([0] + [len(rows)] * (1 + len(words)), pa.int32()), rows)
            columns = [
                pa.array([number] * (1 + len(words)), pa.int64()),
                pa.array([None, *(b for b, _ in words)], pa.int32()),
                pa.array([places, *(w for _, w in words)], pa.binary()),
                lists,
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "packed", "rows"])

        block = Block()
        for piece in pieces(batches, "text", 2 << 20):
            block.add(piece, strings(piece.column("text")).to_pylist(), matches)
            if block.bytes >= block_bytes:
                yield flush(block)
                block, number = Block(), number + 1
        if block.rows:
            yield flush(block)

    return narrow.mapInArrow(explode, f"block long, bucket int, packed binary, rows array<{kind.simpleString()}>")


def _encoded(words: DataFrame, vocabulary: Broadcast, pattern: str) -> DataFrame:
    """block, bucket, packed: the ids of every word of every block, each different word encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(vocabulary.value, pattern)
        known: dict[bytes, list[int]] = {}
        bucket = None
        for batch in batches:
            out = []
            for block, b, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "packed"))):
                if b != bucket:
                    known, bucket = {}, b
                found = []
                for word in split(*unpack(packed)):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encoding.encode_ordinary(word.decode())
                    found.append(ids)
                counts = np.fromiter(map(len, found), np.int64, len(found))
                out.append((block, b, pack(narrow(counts), narrow(np.array([i for ids in found for i in ids])))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))], names=["block", "bucket", "packed"])

    dealt = words.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "block long, bucket int, packed binary")


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, n_tokens, ids (little-endian unsigned 32-bit integers) of every text of the blocks."""
    for batch in batches:
        for at in range(batch.num_rows):
            lengths, front, places = unpack(batch.column("packed")[at].as_py())
            parts = blocks.in_order(batch.column("answers")[at].as_py())
            counts = np.concatenate([c for c, _ in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
            ids = np.concatenate([i for _, i in parts]).astype("<u4") if parts else np.zeros(0, "<u4")
            starts = np.cumsum(counts) - counts
            order = np.concatenate((front.astype(np.int64), np.arange(len(counts))))
            rows = batch.column("rows").slice(at, 1).flatten()
            ends = np.cumsum(lengths, dtype=np.int64)
            step = max(1, int(len(lengths) * (1 << 18) // max(len(places), 1)))
            for i in range(0, len(lengths), step):
                j = min(i + step, len(lengths))
                word = order[places[(ends[i] - lengths[i]) : ends[j - 1]]]
                tokens = counts[word]
                running = np.concatenate(([0], np.cumsum(tokens)))
                cut = running[np.concatenate(([0], np.cumsum(lengths[i:j], dtype=np.int64)))]
                data = ids[ragged(starts[word], tokens)].tobytes()
                values = [data[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays([rows.slice(i, j - i), pa.array(np.diff(cut)), pa.array(values, pa.binary())], names=["row", "n_tokens", "ids"])


def _with_ids(docs: DataFrame, vocabulary: Broadcast, pattern: str, row: list, text_col: str) -> tuple[DataFrame, str]:
    """Blocks with the ids of their words, and the type of their rows."""
    buckets, files = blocks.measures(docs, text_col)
    exploded = _exploded(docs, row, text_col, buckets, pattern)
    written = blocks.write_blocks(exploded, files, "bpe-blocks")
    ids = _encoded(written.where("bucket IS NOT NULL").select("block", "bucket", "packed"), vocabulary, pattern)
    told = blocks.answered(written.where("bucket IS NULL").select("block", "packed", "rows"), ids, files)
    return told.select("packed", "rows", "answers"), exploded.schema["rows"].dataType.elementType.simpleString()


def encode(docs: DataFrame, vocabulary: Broadcast, pattern: str, row: list, text_col: str = "text") -> DataFrame:
    """row (a struct of the columns in `row`), n_tokens, ids (binary, little-endian unsigned 32 bits).

    Every match of `pattern` is encoded by the ranks in `vocabulary` (content of a rank file) without
    special tokens. Null and empty texts have no ids. Repeated rows each get a row; an empty table gives
    an empty result; columns not named in `row` are not read.
    """
    told, kind = _with_ids(docs, vocabulary, pattern, row, text_col)
    return told.mapInArrow(_assembled, f"row {kind}, n_tokens long, ids binary")


def token_bytes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens one after another, and where each token begins (one entry more at the end)."""
    by_rank = {rank: token for token, rank in ranks_of(content).items()}
    tokens = [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate(([0], np.cumsum(list(map(len, tokens)))))


def _joined(batches: Iterator[pa.RecordBatch], content: bytes, at: int, name: str) -> Iterator[pa.RecordBatch]:
    """The batches with the bytes of the ids in column `at`."""
    table, starts = token_bytes(content)
    sizes = np.diff(starts)
    for batch in batches:
        for piece in pieces([batch], batch.schema.names[at]):
            values = piece.column(at).to_pylist()
            ids = np.frombuffer(b"".join(v or b"" for v in values), "<u4").astype(np.int64)
            data = table[ragged(starts[ids], sizes[ids])].tobytes()
            places = np.concatenate(([0], np.cumsum([len(v or b"") // 4 for v in values])))
            cut = np.concatenate(([0], np.cumsum(sizes[ids])))[places].tolist()
            decoded = [None if v is None else data[a:b] for v, a, b in zip(values, cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(decoded, pa.binary())], names=[*piece.schema.names, name])


def decode(encoded: DataFrame, vocabulary: Broadcast, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of its ids; null ids give null bytes."""
    at = encoded.columns.index(ids_col)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(lambda batches: _joined(batches, vocabulary.value, at, out_col), f"{kinds}, `{out_col}` binary")


def encode_and_decode(docs: DataFrame, vocabulary: Broadcast, pattern: str, row: list, text_col: str = "text") -> DataFrame:
    """`encode` and `decode` in one task: row, n_tokens, ids, decoded."""
    told, kind = _with_ids(docs, vocabulary, pattern, row, text_col)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _joined(_assembled(batches), vocabulary.value, 2, "decoded")

    return told.mapInArrow(both, f"row {kind}, n_tokens long, ids binary, decoded binary")


def vocabulary_of(spark: SparkSession, path: str) -> Broadcast:
    """Content of a rank file for every executor."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def round_trip(docs: DataFrame, vocabulary: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row under the rules of `encode`."""
    told = encode_and_decode(docs, vocabulary, pattern, [F.col(id_col).alias("doc_id")], text_col)
    return told.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
