"""SimHash near-duplicates by a self-join of a binary trie.

The fingerprint has a bit for each bit position that is set in over half the hashes of a text's
word shingles. Different fingerprints are the leaves of a binary trie. The join walks pairs of trie
nodes of the same depth together, counts a differing bit whenever the two sides take different
branches, and drops a pair as soon as it has spent more than the budget of differing bits.

With a budget of 4, two linked fingerprints agree in at least one of five blocks of bits. The trie is
therefore laid out five times, each time with another block on top: below the first block only pairs of
a node with itself have to be walked, so sub-tries of different first blocks are independent tasks. A
sub-trie with too many leaves is dealt out by pairs of its nodes some levels further down.

Connections inside a sub-trie are enough (each task unites what it links), so a dense group of n
fingerprints leaves a task as n - 1 links, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from candlewright.llm.common import pieces, ragged, settle, sparing, strings, words
from candlewright.llm.graph import components

SHINGLE = 4
BUDGET = 4
HASH_SEED = 42
BITS = 64
#: Leaves of a sub-trie that one task walks; sub-tries with more are dealt out by deeper nodes.
NODE_LEAVES = 1 << 20
#: Levels by which a crowded sub-trie is dealt out at most.
MAX_LEVELS = 6
#: Pairs of leaves below which two nodes are compared directly.
DIRECT = 64
#: Shingles whose bits are counted, and rows or node pairs that are held, at once.
CHUNK = 1 << 18


def fingerprints_of(texts: pa.StringArray, size: int = SHINGLE, seed: int = HASH_SEED) -> np.ndarray:
    """Fingerprint of each text: words in ASCII lower case, `size`-word shingles, repeats included."""
    flat, offsets = words(pc.ascii_lower(texts))
    n = np.diff(offsets)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    hashes = np.zeros(0, np.uint64)
    if len(flat):
        buffer = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), " ")[0].as_buffer().to_pybytes()
        lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths + 1) - 1
        first = ragged(offsets[:-1], counts)
        last = first + np.repeat(np.minimum(n, size) - 1, counts)
        starts, stops = (ends - lengths)[first], ends[last]
        digest = xxhash.xxh64_intdigest
        hashes = np.empty(len(first), np.uint64)
        for at in range(0, len(first), CHUNK):
            part = slice(at, at + CHUNK)
            hashes[part] = np.fromiter((digest(buffer[a:b], seed) for a, b in zip(starts[part].tolist(), stops[part].tolist())), np.uint64)
    return majority(hashes, np.concatenate(([0], np.cumsum(counts))))


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each slice of `hashes` the bits that are set in over half of them; zero for an empty slice."""
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    ones = np.zeros((len(counts), BITS), np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = slice(at, at + CHUNK)
        bits = np.unpackbits(hashes[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs, begin = np.unique(owner[part], return_index=True)
        ones[docs] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprinted(docs: DataFrame, text_col: str, *carry) -> DataFrame:
    """`carry` and fingerprint (the 64 bits as a long) of every row; null texts count as empty."""
    rows = docs.select(*carry, F.col(text_col).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", 4 << 20):
            prints = fingerprints_of(strings(piece.column("_text"))).view(np.int64)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(prints)], names=[*piece.schema.names[:-1], "fingerprint"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(score, ", ".join([*kinds, "fingerprint long"]))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the linked places; afterwards `parent` holds the smallest place of each class."""
    while True:
        x, y = parent[a], parent[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def walk(leaves: np.ndarray, roots: tuple[np.ndarray, ...], depth: int, budget: int = BUDGET) -> np.ndarray:
    """Smallest linked place of every leaf after walking node pairs from `roots` down.

    A node is a range of `leaves`, which are sorted inside each root and agree there in their first
    `depth` bits; roots are (low, high, low, high, errors) of the two sides.
    """
    parent = np.arange(len(leaves))
    cuts: dict[int, np.ndarray] = {}

    def ones_before(d: int) -> np.ndarray:
        if d not in cuts:
            bit = (leaves >> np.uint64(BITS - 1 - d)) & np.uint64(1)
            cuts[d] = np.concatenate(([0], np.cumsum(bit.astype(np.int32), dtype=np.int32)))
        return cuts[d]

    stack = [(depth, *roots)]
    while stack:
        d, a0, a1, b0, b1, spent = stack.pop()
        if len(a0) > CHUNK:
            stack += [(d, *(x[i : i + CHUNK] for x in (a0, a1, b0, b1, spent))) for i in range(0, len(a0), CHUNK)]
            continue
        # Pairs whose leaves are united already have nothing to add.
        changes = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))
        uniform = (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (parent[a0] == parent[b0])
        a0, a1, b0, b1, spent = (x[~uniform] for x in (a0, a1, b0, b1, spent))
        # What cannot exceed the budget any more is linked as a whole.
        within = spent + (BITS - d) <= budget
        direct = ~within & ((a1 - a0) * (b1 - b0) <= DIRECT)
        for chosen in (within, direct):
            if not chosen.any():
                continue
            x0, x1, y0, y1 = a0[chosen], a1[chosen], b0[chosen], b1[chosen]
            n, m = x1 - x0, y1 - y0
            if chosen is within:
                links = [(np.repeat(x0, n), ragged(x0, n)), (np.repeat(x0, m), ragged(y0, m))]
            else:
                i = ragged(np.zeros_like(n), n * m)
                width = np.repeat(m, n * m)
                p, q = np.repeat(x0, n * m) + i // width, np.repeat(y0, n * m) + i % width
                near = np.bitwise_count(leaves[p] ^ leaves[q]) <= budget
                links = [(p[near], q[near])]
            for p, q in links:
                _unite(parent, p, q)
        rest = ~(within | direct)
        if not rest.any():
            continue
        a0, a1, b0, b1, spent = (x[rest] for x in (a0, a1, b0, b1, spent))
        ones = ones_before(d)
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        own = a0 == b0
        children = [(a0, am, bm, b1, spent + 1, ~own), (a0, am, bm, b1, spent + 1, own), (am, a1, b0, bm, spent + 1, ~own), (am, a1, bm, b1, spent, True), (a0, am, b0, bm, spent, True)]
        for c0, c1, e0, e1, errors, which in children:
            live = which & (c1 > c0) & (e1 > e0) & (errors <= budget)
            if live.any():
                stack.append((d + 1, c0[live], c1[live], e0[live], e1[live], errors[live]))
    return parent


def _blocks(budget: int) -> list[tuple[int, int]]:
    """First bit and width of budget + 1 blocks."""
    edges = [round(i * BITS / (budget + 1)) for i in range(budget + 2)]
    return list(zip(edges, np.diff(edges).tolist()))


def links(prints: DataFrame, budget: int = BUDGET, node_leaves: int = NODE_LEAVES) -> DataFrame:
    """u, v: links that connect all of the different fingerprints of `prints` within the budget."""
    layouts = F.array(*[F.struct(F.lit(i).alias("layout"), F.lit(a).alias("turn"), F.lit(w).alias("width")) for i, (a, w) in enumerate(_blocks(budget))])
    laid = prints.select("fingerprint").distinct().select("fingerprint", F.explode(layouts).alias("l")).select("fingerprint", "l.*")
    turned = F.expr("CASE WHEN turn = 0 THEN fingerprint ELSE shiftleft(fingerprint, turn) | shiftrightunsigned(fingerprint, 64 - turn) END")
    laid = laid.withColumn("leaf", turned).withColumn("block", F.expr("shiftrightunsigned(leaf, 64 - width)"))
    counts = laid.groupBy("layout", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_leaves)
    deeper = F.least(F.lit(MAX_LEVELS), F.ceil(F.log2(F.col("n") / node_leaves))).cast("int")
    crowded = F.broadcast(counts.select("layout", "block", deeper.alias("levels")))  # (budget + 1) * 2^13 blocks at most
    laid = laid.join(crowded, ["layout", "block"], "left").fillna(0, ["levels"])
    here = F.expr("CASE WHEN levels = 0 THEN 0L ELSE shiftrightunsigned(shiftleft(leaf, width), 64 - levels) END")
    other = F.expr(f"explode(filter(sequence(0L, shiftleft(1L, levels) - 1), m -> bit_count(m) <= {budget}))")
    laid = laid.withColumn("here", here).withColumn("mask", other)
    laid = laid.withColumn("low", F.least("here", F.expr("here ^ mask"))).withColumn("high", F.greatest("here", F.expr("here ^ mask")))
    keys = ["layout", "block", "low", "high"]
    dealt = laid.select(*keys, "width", "levels", "leaf", "fingerprint").repartition(*keys).sortWithinPartitions(*keys, F.expr("leaf ^ (-9223372036854775807L - 1)"))

    @sparing
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                starts = _starts(rows, keys)
                if len(starts) > 1:  # the last group may go on
                    yield _linked(rows.slice(0, int(starts[-1])), keys, budget)
                    rows = rows.slice(int(starts[-1]))
                held = [rows]
        if held and sum(b.num_rows for b in held):
            yield _linked(pa.Table.from_batches(held).combine_chunks().to_batches()[0], keys, budget)

    return dealt.mapInArrow(join, "u long, v long")


def _starts(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Places where a group of equal keys begins."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _linked(rows: pa.RecordBatch, keys: list[str], budget: int) -> pa.RecordBatch:
    leaves = rows.column("leaf").to_numpy().view(np.uint64)
    prints = rows.column("fingerprint").to_numpy()
    starts = _starts(rows, keys)
    stops = np.append(starts[1:], rows.num_rows)
    depth = rows.column("width").to_numpy()[starts] + rows.column("levels").to_numpy()[starts]
    low, high = (rows.column(c).to_numpy()[starts] for c in ("low", "high"))
    middle = stops.copy()
    for i in np.flatnonzero(low != high):  # the two nodes of a pair lie one after the other
        at = depth[i]
        node = (leaves[starts[i] : stops[i]] >> np.uint64(BITS - int(at))) & np.uint64((1 << int(rows.column("levels")[int(starts[i])].as_py())) - 1)
        middle[i] = starts[i] + np.searchsorted(node, np.uint64(high[i]))
    own = low == high
    a1, b0 = np.where(own, stops, middle), np.where(own, starts, middle)
    spent = np.bitwise_count(low ^ high).astype(np.int64)
    out = []
    for d in np.unique(depth):
        which = (depth == d) & (a1 > starts) & (stops > b0)
        parent = walk(leaves, (starts[which], a1[which], b0[which], stops[which], spent[which]), int(d), budget)
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        out.append((prints[moved], prints[parent[moved]]))
    u, v = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def classed(prints: DataFrame) -> DataFrame:
    """fingerprint, root: class of every different fingerprint that is linked to a smaller one."""
    return components(settle(links(prints), "simhash-links")).select(F.col("node").alias("fingerprint"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id it reaches) of every row.

    Null and blank texts have fingerprint zero and are linked like any other. Null ids are never the
    smallest; a class without ids has a null component. Repeated rows each get a row. An empty table
    gives an empty result; other columns are not read.
    """
    rows = settle(fingerprinted(docs, text_col, F.col(id_col).alias("doc_id")), "simhash")
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    rooted = least.join(classed(rows), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    classes = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    told = rooted.select("fingerprint", "root").join(classes, "root").select("fingerprint", "component_id")
    return rows.join(told, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of `near_duplicates`, with all columns: the smallest id, null ids last."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = fingerprinted(docs, text_col, F.col(id_col).alias("_id"), row.alias("_row"))
    rows = settle(marked.withColumn("_at", F.monotonically_increasing_id()), "simhash-rows")
    narrow = rows.select("_id", "_at", "fingerprint")
    best = F.min(F.struct(F.col("_id").isNull().alias("unknown"), "_id", "_at")).alias("best")
    rooted = narrow.groupBy("fingerprint").agg(best).join(classed(narrow), "fingerprint", "left")
    kept = rooted.groupBy(F.coalesce("root", "fingerprint")).agg(F.min("best").alias("best")).select("best._at")
    stay = rows.join(kept, "_at", "left_semi")
    return stay.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
