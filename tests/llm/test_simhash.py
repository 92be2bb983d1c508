import random
import re

import numpy as np
import pytest
import xxhash

from candlewright.llm import simhash as op


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def text_rows(rng):
    vocabulary = [f"w{i}É" if i % 5 == 0 else f"W{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 4, 5, 30, 200])))) for i in range(120)]
    base = rng.choices(vocabulary, k=3000)
    for i in range(40):
        changed = list(base)
        changed[rng.randrange(3000)] = "new"
        rows.append((500 + i, "\t".join(changed)))
    return rows + [(None, rows[3][1]), (900, None), (900, ""), (901, rows[0][1])]


def test_same_as_brute_force(docs_of):
    rows = text_rows(random.Random(1))
    prints = [brute_print(t) for _, t in rows]
    roots = brute_classes(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)
    docs = docs_of(rows).withColumn("fingerprint", op.F.lit("x")).withColumn("u", op.F.lit(1))
    assert sorted(map(tuple, op.near_duplicates(docs).collect()), key=str) == want
    kept = op.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))


def clustered(rng, n):
    centres = [rng.getrandbits(64) for _ in range(20)]
    out = {rng.getrandbits(64) for _ in range(n // 3)}
    while len(out) < n:
        p = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("node_leaves", [1 << 20, 3])
def test_links_of_clusters(spark, node_leaves):
    prints = clustered(random.Random(2), 700)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    found = op.components(op.links(frame, node_leaves=node_leaves)).collect()
    place = {p: i for i, p in enumerate(prints)}
    root = {p: p for p in prints}
    for r in found:
        root[r["node"] % (1 << 64)] = r["root"] % (1 << 64)
    classes = {}
    for p, r in root.items():
        classes.setdefault(r, set()).add(p)
    want = {}
    for p, r in zip(prints, brute_classes(prints)):
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))
    assert place


def test_walk_prunes_by_budget():
    leaves = np.array(sorted([0, 0b1111, 0b11111, 1 << 63]), np.uint64)
    roots = tuple(np.array([x]) for x in (0, 4, 0, 4, 0))
    assert op.walk(leaves, roots, 0).tolist() == [0, 0, 0, 0]
    assert op.walk(leaves, roots, 0, budget=0).tolist() == [0, 1, 2, 3]


def test_empty_table(docs_of):
    assert op.near_duplicates(docs_of([])).count() == 0
    assert op.drop_near_duplicates(docs_of([])).count() == 0
