"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from the trie of SimHash fingerprints (`simhash`): the texts of one class of linked
fingerprints, taken over five-word shingles, share a bucket. At 0.8 about ten of 64 bits differ, beyond any
budget whose blocks a trie can still cut by, so the trie alone leaves many links out. For these, texts also
share a bucket with each of BANDS keys, made of ROWS minimal shingle hashes: a pair at 0.8 shares none
with a probability of (1 - 0.8^5)^24, 7 in 100,000. Every link is confirmed on the whole shingle sets.

Links make classes. In a bucket of one class nothing is left to compare, so star
rounds come first: every text is compared with the head of its bucket if their classes differ. That
unites a dense group of n in about n comparisons.

What still shares a bucket with another class is compared by a prefix join, which is exact. All texts put
their shingles into one order, those without a holder of another class first, then by the number of
holders. Sets of sizes a and b at 0.8 share 4 (a + b) / 9 shingles, so they share one among the first of
each; how far that reaches follows from place and sizes. A passage that many texts share comes last in
the order and makes no pairs: only texts whose own words are few meet. Sizes are dealt into narrow
classes, so a shingle meets no text that its place rules out, and texts of the largest class of a
shingle are not matched with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from candlewright.llm import simhash
from candlewright.llm.common import discard, flagged, pieces, ragged, settle, sparing, strings, words
from candlewright.llm.graph import components

SHINGLE = 5
#: Least similarity as a fraction of whole numbers.
SIMILAR = 4, 5
BANDS, ROWS = 24, 5
STARS = 3
#: Sizes within one class differ by this factor at most.
SIZE_STEP = 1.05
HASH_SEED = 42

_draw = np.random.Generator(np.random.PCG64(7))
_TURNS = _draw.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
_TURNS[1] |= np.uint64(1)


def shingle_sets(texts: pa.StringArray, size: int = SHINGLE, seed: int = HASH_SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingle hashes of each text, one text after another, and where each begins.

    Words are in ASCII lower case; a text of fewer than `size` words is one shingle, a blank one has none.
    """
    flat, offsets = words(pc.ascii_lower(texts))
    n = np.diff(offsets)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    buffer = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(flat)], pa.int64()), flat), " ")[0].as_buffer().to_pybytes()
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    first = ragged(offsets[:-1], counts)
    starts, stops = (ends - lengths)[first], ends[first + np.repeat(np.minimum(n, size) - 1, counts)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buffer[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())), np.uint64, len(first))
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[new], minlength=len(texts))
    return hashes[new], np.concatenate(([0], np.cumsum(sizes)))


def band_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The BANDS keys of each text, a row each; blank texts share theirs."""
    filled = np.flatnonzero(np.diff(offsets))
    keys = np.zeros((len(offsets) - 1, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(BANDS * ROWS if len(filled) else 0):
        least = np.minimum.reduceat((hashes ^ _TURNS[0, k]) * _TURNS[1, k], offsets[:-1][filled])
        mixed = (keys[filled, k // ROWS] ^ least) * np.uint64(0xBF58476D1CE4E5B9)
        keys[filled, k // ROWS] = mixed ^ (mixed >> np.uint64(29))
    return keys.view(np.int64)


def _signed(docs: DataFrame, text_col: str, *carry) -> DataFrame:
    """`carry`, _size (different shingles), _print (SimHash of them) and _bands of every row."""
    rows = docs.select(*carry, F.col(f"`{text_col}`").alias("_text"))

    @sparing
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", 1 << 20):
            hashes, offsets = shingle_sets(strings(piece.column("_text")))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1) * BANDS, pa.int32()), pa.array(band_keys(hashes, offsets).ravel()))
            prints = pa.array(simhash.majority(hashes, offsets).view(np.int64))
            names = [*piece.schema.names[:-1], "_size", "_print", "_bands"]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(np.diff(offsets)), prints, keys], names=names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(sign, ", ".join([*kinds, "_size long", "_print long", "_bands array<long>"]))


def _trie_buckets(rows: DataFrame) -> DataFrame:
    """band, at, size (written) of every text: the class of its fingerprint in the trie."""
    prints = rows.where("_size > 0").select("_at", "_size", F.col("_print").alias("fingerprint"))
    classed = prints.join(simhash.classed(prints), "fingerprint", "left")
    band = F.xxhash64(F.lit("trie"), F.coalesce("root", "fingerprint"))
    return settle(classed.select(band.alias("band"), F.col("_at").alias("at"), F.col("_size").alias("size")), "near-trie")


def _sets(rows: DataFrame) -> DataFrame:
    """at, shingles (sorted 64-bit hashes as bytes): from _at, _text."""

    @sparing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", 1 << 20):
            hashes, offsets = shingle_sets(strings(piece.column("_text")))
            held = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([piece.column("_at"), pa.array(held, pa.binary())], names=["at", "shingles"])

    return rows.select("_at", "_text").mapInArrow(cut, "at long, shingles binary")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have the least similarity or more; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: the pairs that are similar."""
    one = sets.select(F.col("at").alias("u"), F.col("shingles").alias("one"))
    other = sets.select(F.col("at").alias("v"), F.col("shingles").alias("other"))

    @sparing
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("one"), batch.column("other"))
            good = [similar(*(np.frombuffer(x.as_buffer(), np.uint64) for x in side)) for side in sides]
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(one, "u").join(other, "v").select("u", "v", "one", "other").mapInArrow(confirm, "u long, v long")


def _linked(classes: DataFrame, links: DataFrame) -> DataFrame:
    """node, root after further links."""
    return components(classes.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(links))


def _size_class(size: Column) -> Column:
    return F.floor(F.log(size) / math.log(SIZE_STEP))


def _keys(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """token, size_class, probes, at, size, class, most: the keys under which similar texts of different classes meet.

    The larger of two texts (by size, then number) probes, the smaller is found. `most` is the largest
    size of a partner that the place of the shingle allows.
    """

    @sparing
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, size, own, held in zip(*(batch.column(c).to_pylist() for c in ("at", "size", "class", "shingles"))):
                for k in range(0, len(held), 8 << 16):
                    tokens = np.frombuffer(held[k : k + (8 << 16)], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), x)) for x in (at, size, own)] + [pa.array(tokens)], names=["at", "size", "class", "token"])

    tokens = settle(texts.join(sets, "at").select("at", "size", "class", "shingles").mapInArrow(spread, "at long, size long, class long, token long"), "near-tokens")
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.min("class").alias("least"), F.max("class").alias("greatest"))
    useful = tokens.join(held.where("least < greatest").select("token", "holders"), "token")
    own = W.partitionBy("at")
    ranked = useful.withColumn("place", F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("holders", "token")) - 1)
    top, bottom = SIMILAR
    # Of sizes a and b, top * (a + b) / (top + bottom) shingles or more are shared, and as many are left at the first shared place.
    most = F.floor((F.col("size") - F.col("place")) * (top + bottom) / top) - F.col("size")
    least = F.ceil(F.col("size") * top / bottom)
    ranked = ranked.select("token", "at", "size", "class", most.alias("most"), least.alias("least"))
    found = ranked.where(F.col("most") >= F.col("size"))
    found = found.select("token", _size_class(F.col("size")).alias("size_class"), F.lit(False).alias("probes"), "at", "size", "class", "most")
    upto = F.least("most", "size")
    probes = ranked.where(upto >= F.col("least")).withColumn("size_class", F.explode(F.sequence(_size_class(F.col("least")), _size_class(upto))))
    probes = probes.select("token", "size_class", F.lit(True).alias("probes"), "at", "size", "class", "most")
    keys = settle(found.unionAll(probes), "near-keys")
    discard(tokens)
    return keys


def crossing_pairs(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v (written): every pair of different classes that can be similar; `texts` has at, size and class."""
    keys = _keys(texts, sets)
    # The largest class of each key that more than one class has.
    counts = keys.groupBy("token", "size_class", "class").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.groupBy("token", "size_class").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("classes"))
    marked = keys.join(kept.where("classes > 1").drop("classes"), ["token", "size_class"]).withColumn("minor", F.col("class") != F.col("main"))
    marked = settle(marked.drop("main"), "near-marked")
    probe = marked.where("probes").drop("probes")
    found = marked.where(~F.col("probes")).select("token", "size_class", *[F.col(c).alias(f"of_{c}") for c in ("at", "size", "class", "most", "minor")])
    fits = (
        (F.col("class") != F.col("of_class"))
        & (F.struct("of_size", "of_at") < F.struct("size", "at"))
        & (F.col("of_size") <= F.col("most"))
        & (F.col("size") <= F.col("of_most"))
    )
    same = (F.col("p.token") == F.col("f.token")) & (F.col("p.size_class") == F.col("f.size_class")) & fits
    ends = F.greatest("at", "of_at").alias("u"), F.least("at", "of_at").alias("v")
    met = [
        probe.where("minor").alias("p").join(found.alias("f"), same).select(*ends),
        probe.where("NOT minor").alias("p").join(found.where("of_minor").alias("f"), same).select(*ends),
    ]
    pairs = settle(met[0].unionAll(met[1]).distinct(), "near-pairs")
    discard(keys, marked)
    return pairs


def _classes(members: DataFrame, sets: DataFrame, stars: int) -> DataFrame:
    """node, root of every text that is linked to one before it: from band, at, size of all texts in shared buckets."""
    spark = members.sparkSession
    classes = spark.createDataFrame([], "node long, root long")
    members = members.withColumn("class", F.col("at"))
    may = F.least("size", "v_size") * SIMILAR[1] >= F.greatest("size", "v_size") * SIMILAR[0]
    mixed = F.min("class") < F.max("class")
    for k in range(stars):
        first = F.min(F.struct(F.xxhash64("at", F.lit(k)), F.col("at").alias("v"), F.col("size").alias("v_size"), F.col("class").alias("v_class"))).alias("head")
        heads = members.groupBy("band").agg(mixed.alias("mixed"), first).where("mixed")
        heads = settle(heads.select("band", "head.v", "head.v_size", "head.v_class"), "near-heads")
        # A bucket of one class stays one, so later rounds read what is left.
        left = settle(members.join(heads, "band"), "near-members")
        discard(heads, members)
        members = left.select("band", "at", "size", "class")
        pairs = left.where((F.col("class") != F.col("v_class")) & may).select(F.greatest("at", "v").alias("u"), F.least("at", "v").alias("v")).distinct()
        pairs = settle(pairs, "near-pairs")
        links = settle(_confirmed(pairs, sets), "near-links")
        if not links.isEmpty():
            classes = _linked(classes, links)
            members = members.drop("class").join(classes, F.col("at") == F.col("node"), "left").select("band", "at", "size", F.coalesce("root", "at").alias("class"))
            members = settle(members, "near-classed")
            discard(left)
        discard(pairs, links)
    open_bands = members.groupBy("band").agg(mixed.alias("mixed")).where("mixed").select("band")
    texts = settle(members.join(open_bands, "band").select("at", "size", "class").distinct(), "near-open")
    if not texts.isEmpty():
        pairs = crossing_pairs(texts, sets)
        links = settle(_confirmed(pairs, sets), "near-links")
        classes = _linked(classes, links)
        discard(pairs, links)
    discard(texts)
    return classes


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stars: int = STARS) -> DataFrame:
    """One row of each class of linked texts, with all columns: the smallest id, null ids last.

    Null and blank texts are near copies of each other. Repeated rows are copies like any other; an empty
    table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = _signed(docs, text_col, F.col(f"`{id_col}`").alias("_id"), row.alias("_row"))
    rows = settle(marked.withColumn("_at", F.monotonically_increasing_id()), "near-rows")
    trie = _trie_buckets(rows)
    banded = rows.where("_size > 0").select(F.explode("_bands").alias("band"), F.col("_at").alias("at"), F.col("_size").alias("size"))
    laid = trie.unionAll(banded)
    shared = settle(laid.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band"), "near-buckets")
    members = settle(laid.join(shared, "band"), "near-shared")
    texts = rows.select("_at", F.col("_row").getField(text_col).alias("_text"))
    sets = settle(_sets(flagged(texts, "_at", members.select("at"), "_shared").where("_shared")), "near-sets")
    classes = _classes(members, sets, stars)
    discard(trie, shared, members, sets)
    # Blank texts need no comparison: they are one class, under the first of them.
    blank = rows.where("_size = 0").select("_at")
    classes = classes.unionAll(blank.select(F.col("_at").alias("node"), F.lit(blank.agg(F.min("_at")).first()[0]).cast("long").alias("root")).where("node <> root"))
    linked = classes.unionAll(classes.select("root", "root").distinct())
    best = F.min(F.struct(F.col("_id").isNull().alias("unknown"), "_id", "_at")).alias("best")
    known = rows.select("_id", "_at").join(linked, F.col("_at") == F.col("node"))
    kept = known.groupBy("root").agg(best).select(F.col("best._at").alias("node"))
    gone = linked.select("node").join(kept, "node", "left_anti").select(F.col("node").alias("_at"))
    stay = flagged(rows, "_at", gone, "_gone").where("NOT _gone")
    return stay.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
