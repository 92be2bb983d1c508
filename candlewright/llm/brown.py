"""Brown class-based n-grams: exchange clustering and a smoothed class bigram model.

Texts lie in blocks: the different words of a block and, for every text, the positions of its words.
Words are dealt by hash to buckets, whose owners merge what all blocks send. In each exchange pass the
blocks send, for every word, how often each class stands before and after it, and the owner moves the
word to the class under which those neighbours are most likely, all words at once; the classes then go
back to the blocks. Every word of the training texts is clustered and every count is over all of them;
what the driver sees are sums and class-by-class tables.

The probability of a token is that of its class after the class before it times that of the word in its
class, interpolated with the word's own frequency. Words not seen in training are one event; its
probability after a class is estimated from the words seen once. Every text is followed by an end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewright.llm import blocks
from candlewright.llm.blocks import narrow, pack, split, unpack
from candlewright.llm.common import pieces, settle, strings, words

#: Bytes of text in a block: a task holds several numbers for each of its tokens.
BLOCK_BYTES = 6 << 20
#: Classes of words. Two more classes stand for the end of a text and for words not seen in training.
CLASSES = 32
PASSES = 3
END, UNKNOWN, FIRST = 0, 1, 2
#: Weight of the class prior in transitions, and of plain word frequency in the mixture.
PRIOR = 20.0
PLAIN = 0.15
#: Every seventh text by checksum of its id is held out.
FOLDS, HELD_OUT = 7, 2

_answer = "block long, bucket int, packed binary"


def _held_out(ids: list) -> np.ndarray:
    """Which ids are held out; a null id counts as an empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == HELD_OUT for i in ids], bool)


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)


def _block_rows(number: int, buckets: int, texts: pa.StringArray, ids: pa.Array) -> pa.RecordBatch:
    """The row of a block and those of its words by bucket; slots number words by bucket, then bytes."""
    flat, offsets = words(pc.ascii_lower(texts))
    encoded = flat.dictionary_encode()
    names = [w.encode() for w in encoded.dictionary.to_pylist()]
    bucket = np.fromiter((xxhash.xxh32_intdigest(w) for w in names), np.uint32, len(names)) % np.uint32(buckets)
    order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    slot = np.empty(len(names), np.int64)
    slot[order] = np.arange(len(names))
    places = slot[encoded.indices.to_numpy()]
    held = _held_out(ids.to_pylist())
    trained = places[np.repeat(~held, np.diff(offsets))]
    counts = np.bincount(trained, minlength=len(names))
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows: list[tuple] = [(number, None, pack(narrow(np.diff(offsets)), held, narrow(places)))]
    for b in range(buckets):
        low, high = edges[b], edges[b + 1]
        if low < high:
            own = [names[i] for i in order[low:high]]
            rows.append((number, b, pack(narrow(np.array(list(map(len, own)))), np.frombuffer(b"".join(own), np.uint8), narrow(counts[low:high]))))
    batch = _batch(["block", "bucket", "packed"], [pa.int64(), pa.int32(), pa.binary()], rows)
    lists = pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * len(rows), pa.int32()), ids)
    return pa.RecordBatch.from_arrays([*batch.columns, lists], names=["block", "bucket", "packed", "ids"])


def _exploded(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    inner = to_arrow_type(kind)
    block_bytes = BLOCK_BYTES

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def flush() -> pa.RecordBatch:
            texts = pa.concat_arrays([strings(p.column("text")) for p in held])
            return _block_rows(number, buckets, texts, pa.concat_arrays([p.column("doc_id").cast(inner) for p in held]))

        for piece in pieces(batches, "text", 2 << 20):
            held.append(piece)
            size += piece.column("text").nbytes
            if size >= block_bytes:
                yield flush()
                number, held, size = number + 1, [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield flush()

    return rows.mapInArrow(explode, f"block long, bucket int, packed binary, ids array<{kind.simpleString()}>")


def _vocabulary(sent: DataFrame) -> DataFrame:
    """bucket, packed (lengths and bytes of words in byte order, training counts) and totals of each bucket."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        bucket = None

        def told() -> pa.RecordBatch:
            names = sorted(known)
            counts = np.array([known[w] for w in names], np.int64)
            packed = pack(narrow(np.array(list(map(len, names)))), np.frombuffer(b"".join(names), np.uint8), narrow(counts))
            row = (bucket, packed, int((counts > 0).sum()), int(counts.sum()), int((counts == 1).sum()))
            return _batch(["bucket", "packed", "types", "tokens", "singles"], [pa.int32(), pa.binary(), *[pa.int64()] * 3], [row])

        for batch in batches:
            for b, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                if b != bucket:
                    if known:
                        yield told()
                    known, bucket = {}, b
                lengths, data, counts = unpack(packed)
                for word, n in zip(split(lengths, data), counts.tolist()):
                    known[word] = known.get(word, 0) + n
        if known:
            yield told()

    dealt = sent.select("bucket", "packed").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(merge, "bucket int, packed binary, types long, tokens long, singles long")


def _ask(state: DataFrame, questions: DataFrame, prepare, answer) -> DataFrame:
    """block, bucket, packed: `answer(prepare(state arrays), question arrays)` for each question of each block.

    The owner of a bucket reads its one row of state first and then the questions one after another.
    """

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for block, bucket, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "packed"))):
                if block is None:
                    held = prepare(unpack(packed))
                else:
                    rows.append((block, bucket, pack(*answer(held, unpack(packed)))))
            yield _batch(["block", "bucket", "packed"], [pa.int64(), pa.int32(), pa.binary()], rows)

    both = state.select(F.lit(None).cast("long").alias("block"), "bucket", "packed").unionByName(questions.select("block", "bucket", "packed"))
    return both.repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first()).mapInArrow(reply, _answer)


def _places(state: list[np.ndarray]) -> tuple[dict[bytes, int], np.ndarray]:
    lengths, data, counts = state
    return {word: i for i, word in enumerate(split(lengths, data))}, counts


def _numbers(held: tuple[dict[bytes, int], np.ndarray], asked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word in its bucket, and its training count."""
    place, counts = held
    numbers = np.array([place[w] for w in split(asked[0], asked[1])], np.int64)
    return narrow(numbers), narrow(counts[numbers])


def _classes_of(held: list[np.ndarray], asked: list[np.ndarray]) -> tuple[np.ndarray]:
    """Class of each word of a block; words without training count are unknown."""
    return (held[0][asked[0]],)


def _first_classes(vocabulary: DataFrame, classes: int) -> DataFrame:
    """Words start in classes by hash."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                lengths, data, counts = unpack(packed)
                chosen = np.fromiter((FIRST + xxhash.xxh32_intdigest(w, 1) % classes for w in split(lengths, data)), np.uint8, len(lengths))
                rows.append((bucket, pack(np.where(counts > 0, chosen, UNKNOWN).astype(np.uint8))))
            yield _batch(["bucket", "packed"], [pa.int32(), pa.binary()], rows)

    return vocabulary.select("bucket", "packed").mapInArrow(start, "bucket int, packed binary")


class Sequence:
    """Classes of a block's tokens in order, an end after each text."""

    def __init__(self, packed: bytes, classes: list[list[np.ndarray]]):
        lengths, held, places = unpack(packed)
        of_slot = np.concatenate([c[0] for c in classes]).astype(np.int32) if classes else np.zeros(0, np.int32)
        self.sizes = [len(c[0]) for c in classes]
        self.lengths = lengths.astype(np.int64) + 1
        ends = np.cumsum(self.lengths)
        self.slots = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int32)
        inside = np.ones(len(self.slots), bool)
        inside[ends - 1] = False
        self.slots[inside] = places
        self.classes = np.full(len(self.slots), END, np.int32)
        self.classes[inside] = of_slot[self.slots[inside]]
        self.before = np.concatenate((np.array([END], np.int32), self.classes[:-1]))[: len(self.classes)]
        self.held = held
        self.trained = np.repeat(~held, self.lengths)
        self.starts = ends - self.lengths


def _transitions(told: DataFrame, width: int) -> np.ndarray:
    """Training counts (class before, class, word seen once) over all blocks: `width` by `width` by 2."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, answers, known in zip(*(batch.column(c).to_pylist() for c in ("packed", "answers", "known"))):
                seq = Sequence(packed, blocks.in_order(answers))
                once = np.concatenate([k[1] for k in blocks.in_order(known)]) == 1 if known else np.zeros(0, bool)
                single = np.zeros(len(seq.slots), np.int32)
                single[seq.slots >= 0] = once[seq.slots[seq.slots >= 0]]
                cell = ((seq.before * width + seq.classes) * 2 + single)[seq.trained]
                counts = np.bincount(cell, minlength=width * width * 2)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["cell", "n"])

    table = np.zeros(width * width * 2)
    for row in told.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table[row["cell"]] = row["n"]
    return table.reshape(width, width, 2)


def _contexts(told: DataFrame, width: int) -> DataFrame:
    """block, bucket, packed (numbers of the words, keys (word, side, class), counts): neighbours of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, answers, known in zip(*(batch.column(c).to_pylist() for c in ("block", "packed", "answers", "known"))):
                seq = Sequence(packed, blocks.in_order(answers))
                after = np.concatenate((seq.classes[1:], np.array([END], np.int32)))[: len(seq.classes)]
                use = seq.trained & (seq.slots >= 0)
                slots = seq.slots[use].astype(np.int64) * (2 * width)
                keys = np.concatenate((slots + seq.before[use], slots + width + after[use]))
                keys, counts = np.unique(keys, return_counts=True)
                numbers = blocks.in_order(known)
                edges = np.concatenate(([0], np.cumsum(seq.sizes))) * 2 * width
                cut = np.searchsorted(keys, edges)
                names = sorted(a["bucket"] for a in answers or [])
                rows = []
                for i, bucket in enumerate(names):
                    own = keys[cut[i] : cut[i + 1]] - edges[i]
                    gaps = np.diff(own, prepend=0)
                    rows.append((block, bucket, pack(numbers[i][0], narrow(gaps), narrow(counts[cut[i] : cut[i + 1]]))))
                yield _batch(["block", "bucket", "packed"], [pa.int64(), pa.int32(), pa.binary()], rows)

    return told.mapInArrow(count, _answer)


def _logs(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log probability of a class after a class, smoothed by class frequency; log count of classes."""
    counts = table.sum(2)
    totals = counts.sum(0)
    share = (totals + 1) / (totals + 1).sum()
    smooth = (counts + PRIOR * share) / (counts.sum(1, keepdims=True) + PRIOR)
    return np.log(smooth), np.log(np.maximum(totals, 1))


def _exchanged(state: DataFrame, contexts: DataFrame, table: np.ndarray) -> DataFrame:
    """bucket, packed (class of every word): each word in the class that suits its neighbours best."""
    width = len(table)
    step, size = _logs(table)

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = seen = bucket = None

        def told() -> pa.RecordBatch:
            best = now.copy()
            for low in range(0, len(now), 1 << 15):
                part = seen[low : low + (1 << 15)].astype(np.float64)
                left, right = part[:, :width], part[:, width:]
                fit = left @ step + right @ step.T - left.sum(1, keepdims=True) * size
                fit[:, :FIRST] = -np.inf
                best[low : low + (1 << 15)] = np.where(now[low : low + (1 << 15)] >= FIRST, fit.argmax(1), now[low : low + (1 << 15)])
            return _batch(["bucket", "packed"], [pa.int32(), pa.binary()], [(bucket, pack(best))])

        for batch in batches:
            for block, b, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "packed"))):
                if block is None:
                    if now is not None:
                        yield told()
                    (now,), bucket = unpack(packed), b
                    now = now.copy()
                    seen = np.zeros((len(now), 2 * width), np.float32)
                    continue
                numbers, gaps, counts = unpack(packed)
                keys = np.cumsum(gaps.astype(np.int64))
                seen.ravel()[numbers.astype(np.int64)[keys // (2 * width)] * (2 * width) + keys % (2 * width)] += counts
        if now is not None:
            yield told()

    both = state.select(F.lit(None).cast("long").alias("block"), "bucket", "packed").unionByName(contexts)
    dealt = both.repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
    return dealt.mapInArrow(exchange, "bucket int, packed binary")


@dataclass
class Model:
    """Probabilities by class, and what they were counted from."""

    after: np.ndarray  # of a class after a class, given that the word is known
    unseen: np.ndarray  # of an unknown word after a class
    size: np.ndarray  # training tokens of each class
    tokens: int
    types: int
    unseen_share: float

    def scores(self, seq: Sequence, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token of a block: training count, log10 of its base and of its model probability."""
        n = np.full(len(seq.slots), self.size[END])
        n[seq.slots >= 0] = counts[seq.slots[seq.slots >= 0]]
        base = np.log10((n + 1) / (self.tokens + 1 * (self.types + 1)))
        known = n > 0
        emission = n / np.maximum(self.size[seq.classes], 1)
        unseen = self.unseen[seq.before]
        by_class = np.where(known, (1 - unseen) * self.after[seq.before, seq.classes] * emission, unseen)
        plain = np.where(known, (1 - self.unseen_share) * n / max(self.tokens, 1), self.unseen_share)
        with np.errstate(divide="ignore"):
            return n, base, np.log10((1 - PLAIN) * by_class + PLAIN * plain)


def model_of(table: np.ndarray, tokens: int, types: int, singles: int) -> Model:
    counts = table.sum(2)
    size = counts.sum(0)
    unseen_share = (singles + 1) / (tokens + 2)
    unseen = (table[:, :, 1].sum(1) + PRIOR * unseen_share) / (counts.sum(1) + PRIOR)
    share = size / max(size.sum(), 1)
    after = (counts + PRIOR * share) / (counts.sum(1, keepdims=True) + PRIOR)
    return Model(after, unseen, size, tokens, types, unseen_share)


def brown_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Words are those of the ASCII lower-cased text; null and empty texts are an end alone. A null id
    counts as an empty one and so is in training. Where there is no training text every token is
    unknown. Repeated rows each count and get a row; an empty table gives an empty result; other
    columns are not read.
    """
    width = FIRST + classes
    buckets, files = blocks.measures(docs, text_col, BLOCK_BYTES)
    written = blocks.write_blocks(_exploded(docs, id_col, text_col, buckets), files, "brown-blocks")
    texts = written.where("bucket IS NULL").select("block", "packed", "ids")
    sent = written.where("bucket IS NOT NULL").select("block", "bucket", "packed")
    vocabulary = settle(_vocabulary(sent), "brown-words")
    types, tokens, singles = (int(x or 0) for x in vocabulary.agg(F.sum("types"), F.sum("tokens"), F.sum("singles")).first())
    known = settle(_ask(vocabulary, sent, _places, _numbers), "brown-numbers")
    held_known = known.repartition(files, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "packed")).alias("known"))
    state = settle(_first_classes(vocabulary, classes), "brown-classes")
    for again in range(passes + 1):
        told = blocks.answered(texts, settle(_ask(state, known, list, _classes_of), "brown-answers"), files).join(held_known, "block", "left")
        table = _transitions(told, width)
        if again < passes:
            state = settle(_exchanged(state, _contexts(told, width), table), "brown-classes")
    ends = int(table[:, END].sum())
    model = docs.sparkSession.sparkContext.broadcast(model_of(table, tokens + ends, types + (ends > 0), singles))
    kind = written.schema["ids"].dataType.elementType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (packed, answers, numbers) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("packed", "answers", "known")))):
                seq = Sequence(packed, blocks.in_order(answers))
                counts = np.concatenate([k[1] for k in blocks.in_order(numbers)]) if numbers else np.zeros(0, np.int64)
                n, base, own = model.value.scores(seq, counts)
                rows = len(seq.lengths)
                columns = [
                    batch.column("ids").slice(at, 1).flatten(), pa.array(seq.held), pa.array(seq.lengths),
                    pa.array(np.add.reduceat((n > 0).astype(np.int64), seq.starts)), pa.array(np.full(rows, model.value.tokens, np.int64)),
                    pa.array(np.add.reduceat(base, seq.starts)), pa.array(np.add.reduceat(own, seq.starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return told.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
