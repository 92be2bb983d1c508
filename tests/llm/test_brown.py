import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from candlewright.llm import brown as op


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def brute(rows):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        out.append((i, held(i), len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)))
    return out


def language(rng, k):
    """Nouns after articles, verbs after nouns."""
    kinds = [["the", "A", "this"], [f"noun{i}" for i in range(60)], [f"verb{i}é" for i in range(60)]]
    return " ".join(rng.choice(kinds[i % 3]) for i in range(k))


def rows_of(rng, n=300):
    rows = [(i, language(rng, rng.randrange(1, 60))) for i in range(n)]
    return rows + [(None, "the end"), (9001, None), (9002, " \n"), (9003, "x " * 30_000), (9004, "only-here"), (4, rows[4][1]), (4, rows[4][1])]


@pytest.mark.parametrize("block_bytes", [16 << 20, 1500])
def test_base_same_as_brute_force(docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(op, "BLOCK_BYTES", block_bytes)
    rows = rows_of(random.Random(1), 80)
    docs = docs_of(rows).withColumn("block", op.F.lit("x")).withColumn("ids", op.F.lit(1))
    found = op.brown_scores(docs, passes=1).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    for got, want in zip(sorted(map(tuple, found), key=key), sorted(brute(rows), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5]) and math.isfinite(got[6]) and got[6] < 0


def test_classes_beat_frequencies_on_held_out_text(docs_of):
    rows = rows_of(random.Random(2))
    found = [r for r in op.brown_scores(docs_of(rows), classes=6, passes=4).collect() if r["held_out"] and r["doc_id"] < 9000]
    n = sum(r["n_tokens"] for r in found)
    base, own = (10 ** (-sum(r[c] for r in found) / n) for c in ("base_score", "score"))
    assert len(found) > 20 and own < 0.75 * base
    # order matters to the model only: the same words mixed are less likely
    rng = random.Random(3)
    ids = [i for i in range(10_000, 10_400) if held(i)]
    plain = {i: language(rng, 40) for i in ids}
    mixed = {i + 50_000: " ".join(rng.sample(t.split(), 40)) for i, t in plain.items() if held(i + 50_000)}
    told = {r["doc_id"]: r for r in op.brown_scores(docs_of([*rows, *plain.items(), *mixed.items()]), classes=6, passes=4).collect()}
    assert np.mean([told[i]["score"] for i in plain]) > np.mean([told[i]["score"] for i in mixed]) + 3


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    counts = np.array([5, 1, 3, 1, 0, 7, 2])
    classes = np.array([2, 2, 3, 3, 1, 4, 4])
    table = np.zeros((5, 5, 2))
    table[:, 0, 0] = 2
    for before in range(5):
        if before != op.UNKNOWN:
            for c in (2, 3, 4):
                table[before, c, 0] = rng.integers(0, 5)
    size = [counts[classes == c].sum() for c in range(5)]
    for c in (2, 3, 4):  # transitions into a class add up to the tokens of its words
        table[:, c, :] *= 0
        table[0, c, 0], table[c, c, 0] = size[c] - (counts[classes == c] == 1).sum(), 0
        table[0, c, 1] = (counts[classes == c] == 1).sum()
    ends = int(table[:, 0].sum())
    model = op.model_of(table, int(counts.sum()) + ends, 7, 2)
    for before in range(5):

        class One:
            slots = np.array([0, 1, 2, 3, 4, 5, 6, -1])

        One.classes = np.append(classes, op.END)
        One.before = np.full(8, before)
        _, base, own = model.scores(One, counts)
        assert (10**base).sum() == pytest.approx(1, abs=0.2)
        assert (10**own).sum() == pytest.approx(1)


def test_no_rows_and_no_training(docs_of):
    assert op.brown_scores(docs_of([])).count() == 0
    one = next(i for i in range(100) if held(i))
    (r,) = op.brown_scores(docs_of([(one, "a b")])).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and math.isfinite(r["score"])
