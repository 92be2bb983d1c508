import hashlib
from collections import defaultdict

from candlewright.llm import exact_dedup as op


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        left = True
        for i in ids:
            kept = left and i == best
            left = left and not kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (2, "a b"), (3, "a  b"), (4, None), (5, ""), (None, "a b"), (7, "z" * 100_000), (7, "z" * 100_000), (8, "é"), (None, "q"), (None, "q")]


def test_same_as_brute_force(docs_of):
    found = op.exact_dedup(docs_of(ROWS))
    assert sorted(map(tuple, found.collect()), key=str) == brute(ROWS)


def test_hot_text_through_lanes(docs_of, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"t{i // 6}") for i in range(600)]
    entries = op.settle(op._entries(docs_of(rows, 12), "text", "doc_id", False), "t")
    found = {r["entry"]: r for r in op.resolve(entries, key_entries=2).collect()}
    plain = {r["entry"]: r for r in op.resolve(entries).collect()}
    assert len(found) == entries.count()
    assert {e: (r["keep_id"], r["group_size"], r["keep_entry"]) for e, r in found.items()} == {e: (r["keep_id"], r["group_size"], r["keep_entry"]) for e, r in plain.items()}


def test_equal_keys_are_told_apart_by_bytes(docs_of, monkeypatch):
    entries = op.settle(op._entries(docs_of(ROWS), "text", "doc_id", False), "t").withColumn("key", op.F.lit(5).cast("long"))
    sizes = {r["entry"]: r["group_size"] for r in op.resolve(entries).collect()}
    plain = op.settle(op._entries(docs_of(ROWS), "text", "doc_id", False), "t")
    assert sorted(sizes.values()) == sorted(r["group_size"] for r in op.resolve(plain).collect())


def test_directory_doubles_and_splits():
    d = op.Directory({0: 5, 1: 5, 2: 1, 7: 1}, capacity=5, max_depth=3)
    assert d.depth == 3 and len(d.cells) == 8
    assert len({d.cells[0], d.cells[1], d.cells[2]}) == 3 and d.cells[2] == d.cells[3]
    assert len(set(d.cells[4:])) == 1
    assert op.Directory({}, 1, 3).cells == [0]
    assert op.Directory({6: 9}, 5, 3).depth == 3


def test_drop_copies_keeps_all_columns(docs_of):
    docs = docs_of(ROWS).withColumn("entry", op.F.lit("x")).withColumn("key", op.F.lit(None).cast("int"))
    kept = op.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str) == sorted({(b[1], t or "") for (i, t) in ROWS for b in brute(ROWS) if b[4] == hashlib.sha256((t or "").encode()).hexdigest()}, key=str)


def test_id_need_not_come_first(docs_of):
    docs = docs_of([(1, "a"), (9, "a"), (4, "b")]).select("n_chars", "text", "lang", "doc_id")
    assert sorted(r["doc_id"] for r in op.drop_copies(docs).collect()) == [4, 9]


def test_empty_table(docs_of):
    assert op.exact_dedup(docs_of([])).count() == 0
    assert op.drop_copies(docs_of([])).count() == 0


def test_only_texts_of_repeated_keys_travel(docs_of, monkeypatch):
    rows = [*((i, f"text {i}") for i in range(40)), *((100 + i, f"text {i}") for i in range(3))]
    entries = op.settle(op._entries(docs_of(rows, 4), "text", "doc_id", False), "t")
    repeated = entries.groupBy("key").count().where("count > 1")
    held, owned = [], op._owned
    monkeypatch.setattr(op, "_owned", lambda frame, parts: held.append(frame) or owned(frame, parts))
    found = op.resolve(entries).collect()
    assert len(found) == entries.count() == held[0].count()
    assert held[0].where("text IS NOT NULL").count() == entries.join(repeated, "key").count()
    assert sum(r["entry"] == r["keep_entry"] for r in found) == 40


def test_texts_do_not_move_for_the_verdict(spark, docs_of):
    rows = [(i, f"text {i % 30}") for i in range(50)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = op.drop_copies(docs_of(rows, 4))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        main = plan[: plan.index("BroadcastExchange")]
        assert "SortMergeJoin" not in main and "Exchange hashpartitioning" not in main.split("BroadcastHashJoin")[0]
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20, 50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
