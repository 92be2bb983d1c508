from pyspark.sql import functions as F

from bars import text_frame, text_rows
from candlewright.functions import times as T
from candlewright.operators import merge as M


def golden_pair(spark):
    target = [list(r) for r in text_rows("2025-12-01", utc=True)]
    target[5][2] = "100.50"
    source = text_rows("2025-12-01")[:10] + text_rows("2025-12-02")
    pos = lambda f: f.coalesce(1).withColumn("pos", F.monotonically_increasing_id())
    return pos(text_frame(spark, [tuple(r) for r in target]).withColumn("highest_val", F.lit(""))), pos(text_frame(spark, source))


def test_text_merge_keeps_existing_rows_and_their_text(spark):
    target, source = golden_pair(spark)
    stacked = M.stack_sources([target, source], order="pos")
    stats = M.merge_stats(stacked).first()
    assert (stats["input_row_count"], stats["output_row_count"], stats["duplicate_row_count"], stats["conflict_minute_count"]) == (790, 780, 10, 1)
    rows = M.merge_existing_wins([target, source], order="pos").orderBy("ts").collect()
    assert (rows[5]["high"], rows[5]["timestamp"]) == ("100.50", "2025-12-01 14:35:00+00:00")
    assert rows[390]["timestamp"] == "2025-12-02 09:30:00-05:00" and rows[0]["open"] == "100.00"
    assert rows[390]["highest_val"] == "" and rows[390]["volume"] == "1000"
    conflict = M.merge_conflicts(stacked).select(T.offset_text(F.col("ts")).alias("t"), "copies").first()
    assert (conflict["t"], conflict["copies"]) == ("2025-12-01 09:35:00-05:00", 2)


def test_conflicts_compare_numbers_and_count_blanks_as_a_value(spark):
    rows = [
        ("same", "119.4", 0), ("same", "119.40", 1), ("blank", "5", 0), ("blank", "", 1), ("junk", "x", 0), ("junk", "", 1), ("off", "5", 0), ("off", "6", 1), ("one", "7", 0),
    ]
    frame = spark.createDataFrame(rows, "symbol string, close string, pos bigint").withColumn("ts", F.lit("2025-01-02").cast("timestamp"))
    found = M.merge_conflicts(M.stack_sources([frame], order="pos"))
    assert sorted(r["symbol"] for r in found.collect()) == ["blank", "off"]


def test_first_source_wins_even_when_it_is_listed_with_more_copies(spark):
    make = lambda rows: spark.createDataFrame(rows, "symbol string, ts string, close string, pos bigint").withColumn("ts", F.to_timestamp("ts"))
    first = make([("a", "2025-01-02", "1", 5), ("a", "2025-01-02", "2", 4)])
    second = make([("a", "2025-01-02", "3", 0), ("b", "2025-01-02", "9", 0)])
    rows = {r["symbol"]: r["close"] for r in M.merge_existing_wins([first, second], order="pos").collect()}
    assert rows == {"a": "2", "b": "9"}


def test_verification_finds_lost_foreign_and_repeated_keys(spark):
    make = lambda rows: spark.createDataFrame(rows, "symbol string, ts string").withColumn("ts", F.to_timestamp("ts"))
    inputs = make([("a", "2025-01-01"), ("a", "2025-01-01"), ("a", "2025-01-02")])
    good = M.merge_verify(inputs, make([("a", "2025-01-01"), ("a", "2025-01-02")])).first()
    assert good["verified"] and good["lost_key_count"] == 0
    bad = M.merge_verify(inputs, make([("a", "2025-01-01"), ("a", "2025-01-01"), ("a", "2025-01-05")])).first()
    assert (bad["lost_key_count"], bad["foreign_key_count"], bad["repeated_key_count"], bad["verified"]) == (1, 1, 1, False)


def test_document_upsert_is_shallow_and_new_wins(spark):
    make = lambda rows: spark.createDataFrame(rows, "key string, value string, n int")
    old, new = make([("a", '{"x":1}', 0), ("b", "1", 1)]), make([("a", '{"y":2}', 0), ("c", "3", 1)])
    assert {r["key"]: r["value"] for r in M.kv_upsert(old, new, order="n").collect()} == {"a": '{"y":2}', "b": "1", "c": "3"}


def test_snapshot_guard_actions(spark):
    make = lambda rows: spark.createDataFrame(rows, "week string, v int")
    old = make([("same", 1), ("same", 1), ("less", 1), ("less", 2), ("more", 1), ("edit", 1), ("gone", 1)])
    new = make([("same", 1), ("same", 1), ("less", 1), ("more", 1), ("more", 2), ("edit", 2), ("new", 1)])
    actions = {r["week"]: r["action"] for r in M.snapshot_guard(old, new, ["week"]).collect()}
    assert actions == {"same": "skip", "less": "error", "more": "overwrite", "edit": "overwrite", "new": "write"}
    assert M.frames_equal(old, old).first()["equal"] and not M.frames_equal(old, new).first()["equal"]
    delta = M.row_count_delta(old, new).first()
    assert (delta["before_count"], delta["after_count"], delta["row_count_diff"]) == (7, 7, 0)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("symbol"), F.lit("2025-01-02").cast("timestamp").alias("ts"),
        F.col("id").cast("string").alias("close"), F.col("id").alias("pos"),
    )
    stacked = M.stack_sources([rows], order="pos")
    merged = M.merged_rows(stacked)
    pairs = rows.selectExpr("symbol key", "close value", "pos")
    for frame in (merged, M.conflict_flags(stacked), M.kv_upsert(pairs, pairs, order="pos")):
        plan = plan_of(frame)
        assert "Window" not in plan and "partial_" in plan and plan.count("Exchange hashpartitioning") == 1
    hot = merged.where("symbol = 'hot'").first()
    assert (hot["close"], hot["copies"], hot["conflict"]) == ("0", 1000, True)
    assert "HashAggregate" in plan_of(M.conflict_flags(stacked)) and "SortAggregate" not in plan_of(M.conflict_flags(stacked))


def test_first_conflicts_are_the_earliest(spark):
    rows = [("a", f"2025-01-{d:02d}", v, i) for i, (d, v) in enumerate([(3, "1"), (3, "2"), (1, "1"), (1, "3"), (2, "1"), (2, "1.0")])]
    frame = spark.createDataFrame(rows, "symbol string, ts string, close string, pos bigint").withColumn("ts", F.to_timestamp("ts"))
    found = M.first_conflicts(M.stack_sources([frame], order="pos"), limit=1)
    assert [str(r["ts"])[:10] for r in found.collect()] == ["2025-01-01"] and "TakeOrderedAndProject" in plan_of(found)


def test_audit_agrees_with_stats_and_verification(spark):
    make = lambda rows: spark.createDataFrame([(t, s, d, c, i) for i, (t, s, d, c) in enumerate(rows)], "target string, symbol string, ts string, close string, pos bigint").withColumn("ts", F.to_timestamp("ts"))
    keys = ["target", "symbol", "ts"]
    given = M.stack_sources([make([("x", "a", "2025-01-01", "1"), ("x", "a", "2025-01-01", ""), ("x", "b", "2025-01-01", "2"), ("y", "a", "2026-01-01", "3")])], keys, "pos")
    kept = make([("x", "a", "2025-01-01", "1"), ("x", "b", "2025-01-01", "2"), ("y", "c", "2026-01-01", "3")])
    audit = {r["target"]: r for r in M.merge_audit(given, kept, keys, ["target"]).collect()}
    stats = {r["target"]: r for r in M.merge_stats(given, keys, ["target"]).collect()}
    for target in ("x", "y"):
        for name in ("input_row_count", "output_row_count", "duplicate_row_count", "conflict_minute_count"):
            assert audit[target][name] == stats[target][name]
    assert audit["x"]["verified"] and not audit["y"]["verified"] and audit["x"]["conflict_minute_count"] == 1
