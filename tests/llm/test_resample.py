"""Importance resampling against brute force, and its cutoff against a plain sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from candlewright.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, targets, buckets=10_000, percent=10, least=20, longest=1):
    """(doc_id, n_features, weight, score, rank); rows that tie in all of the order are alike."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for x in texts for f in features(x, longest)[1]) for texts in ([r[1] for r in rows], targets))
    s_all, t_all = sum(s.values()), sum(t.values())
    told = []
    for doc_id, text in rows:
        words, own = features(text, longest)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (s_all + buckets) / ((s[bucket(f)] + 1) * (t_all + buckets)))) for f in own)
        h = int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        told.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    order = sorted((-r[3], r[0] is None, r[0] or 0, i) for i, r in enumerate(told) if r[4])
    ranks = {o[3]: k + 1 for k, o in enumerate(order[: percent * len(order) // 100])}
    return sorted((*r[:4], ranks.get(i)) for i, r in enumerate(told)) if all(r[0] is not None for r in rows) else [(*r[:4], ranks.get(i)) for i, r in enumerate(told)]


def corpus(rng, n=300):
    words = [f"{a}{b}" for a in "alpha beta ÉTÉ Gamma délta".split() for b in range(30)]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("base", [1, 40, 4096])
@pytest.mark.parametrize("longest", [1, 2])
def test_same_as_brute_force(spark, docs_of, base, longest):
    rng = random.Random(3)
    rows, targets = corpus(rng), ["Alpha1 beta2, beta2!", None, "été7 x"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    found = resample.resample(docs_of(rows, 5), target, base=base, longest=longest)
    assert sorted(map(tuple, found.collect())) == brute(rows, targets, longest=longest)


def test_nulls_blanks_ties_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(7, text), (7, text), (3, text), (None, text), (1, None), (2, " \n!"), (4, "one two"), (5, "x" * 200_000), (6, "A b " * 50_000)]
    docs = spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)], "doc_id long, text string, at long, rank long")
    found = [tuple(r) for r in resample.resample(docs, docs.select("text").limit(0), percent=100).collect()]
    assert Counter(found) == Counter(brute(rows, [], percent=100))
    assert sorted(r[4] for r in found if r[4]) == [1, 2, 3, 4, 5]
    none = resample.resample(docs, docs, percent=1).collect()
    assert len(none) == len(rows) and all(r["rank"] is None for r in none)
    assert resample.resample(docs.limit(0), docs).count() == 0
    assert {r["doc_id"] for r in resample.resample(docs.withColumn("doc_id", resample.F.concat(resample.F.lit("d"), "doc_id")), docs, percent=60).collect() if r["rank"]} <= {"d7", "d3", "d6", None}


@pytest.mark.parametrize("place", [1, 2, 499, 500, 501, 1000])
def test_cutoff_is_the_key_at_its_place(spark, place):
    rng = random.Random(place)
    keys = [(rng.choice([5, 5, 5, rng.randrange(1000)]), rng.random() < 0.1, rng.randrange(50), i) for i in range(1000)]
    keys = [(a, u, None if u else b, i) for a, u, b, i in keys]
    frame = resample.settle(spark.createDataFrame(keys, "lost long, unknown boolean, id long, at long").repartition(7), "test-keys")
    found = resample.cutoff(frame, place, base=1)
    want = sorted(keys, key=lambda k: (k[0], k[1], k[2] or 0, k[3]))[place - 1]
    assert tuple(found[c] for c in ("lost", "unknown", "id", "at")) == want


def test_weighted_median_leaves_a_quarter_on_both_sides():
    rng = random.Random(1)
    for _ in range(50):
        parts = [sorted(rng.choices(range(10_000), k=rng.randrange(1, 80))) for _ in range(rng.randrange(1, 12))]
        told = [{"n": len(p), "lost": p[(len(p) - 1) // 2], "unknown": False, "id": 0, "at": i} for i, p in enumerate(parts)]
        pivot = resample.weighted_median(told)["lost"]
        whole = [x for p in parts for x in p]
        assert sum(x <= pivot for x in whole) >= len(whole) / 4 and sum(x >= pivot for x in whole) >= len(whole) / 4
