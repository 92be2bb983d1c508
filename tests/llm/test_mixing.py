from collections import defaultdict

import pytest

from candlewright.llm import mixing as op


def brute_targets(sizes):
    """Share by weight, clamp, share the excess again until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: op.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in clamped)
        open_ = sum(weight[s] for s in names if s not in clamped)
        share = {s: 3 * sizes[s] if s in clamped else left * weight[s] / open_ for s in names}
        above = {s for s in names if s not in clamped and share[s] >= 3 * sizes[s]}
        if not above:
            return share
        clamped |= above
        if len(clamped) == len(names):
            return {s: 3 * sizes[s] for s in names}


ROWS = [(i, "w " * (i % 17 + 1), "en", f"s{i % 5}" if i % 7 else None) for i in range(400)] + [(1000 + i, " ".join(["q"] * 40), "en", "big") for i in range(300)] + [(2000, None, "en", "none"), (2001, " \t ", "en", "none"), (None, "a b", None, "s1"), (None, "a b", None, "s1")]


def test_targets_and_taken(docs_of):
    rows = op.mix_words(docs_of(ROWS)).collect()
    assert len(rows) == len(ROWS)
    size = {(r[0], r[3]): len((r[1] or "").split()) for r in ROWS}
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += len((r[1] or "").split())
    want = brute_targets(dict(sizes))
    source = {r[0]: r[3] for r in ROWS}
    taken = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[(r["doc_id"], s)] and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 20


def test_reruns_agree_and_rows_repeat(docs_of):
    docs = docs_of(ROWS).withColumn("size", op.F.lit("x")).withColumn("row", op.F.lit(1))
    first = sorted(map(tuple, op.mix_words(docs).collect()), key=str)
    assert first == sorted(map(tuple, op.mix_words(docs_of(ROWS, 5)).collect()), key=str)
    mixed = op.mix(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert words == sum(r[4] for r in first)


def test_blank_rows_come_as_often_as_whole_epochs(docs_of):
    rows = [(i, text, "en", source) for source in ("a", "b") for i, text in enumerate([" ", None, "w " * 30, "", "v " * 50])]
    rows += [(100 + i, "x " * 400, "en", "c") for i in range(30)]
    out = defaultdict(int)
    for r in op.mix(docs_of(rows)).collect():
        out[r["source"], r["doc_id"]] += 1
    assert out["a", 2] == out["a", 4] == 3  # a small source of great weight is clamped
    assert all(out[s, i] <= 3 and out[s, i] <= max(out[s, 2], out[s, 4]) for s in ("a", "b") for i in (0, 1, 3))


def test_cuts_stand_for_all_rows(docs_of, monkeypatch):
    for sent in (10_000, 0):  # cuts sent to every task, or joined by a shuffle
        monkeypatch.setattr(op, "SENT_SOURCES", sent)
        docs = docs_of(ROWS)
        out = defaultdict(int)
        for r in op.mix(docs).collect():
            out[r["doc_id"], r["source"]] += len((r["text"] or "").split())
        taken = defaultdict(int)
        source = {r[0]: r[3] for r in ROWS}
        for r in op.mix_words(docs).collect():
            taken[r["doc_id"], source[r["doc_id"]]] += r["taken"]
        assert {k: n for k, n in out.items() if n} == {k: n for k, n in taken.items() if n}


def test_no_rows_and_no_words(docs_of):
    assert op.mix_words(docs_of([])).count() == 0
    assert op.mix(docs_of([])).count() == 0
    rows = op.mix_words(docs_of([(1, None), (2, "")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2
