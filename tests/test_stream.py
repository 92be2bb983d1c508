from datetime import timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from bars import calendar, minutes, ny
from candlewright.functions import times as T
from candlewright.streaming import live as S

UTC = ZoneInfo("UTC")
SCHEMA = "symbol string, ts timestamp, arrival_ts timestamp, open double, high double, low double, close double, volume double"


def version(ts, seconds, close):
    return ("x", ts.astimezone(UTC), (ts + timedelta(seconds=seconds)).astimezone(UTC), close, close, close, close, 1.0)


def test_only_complete_minutes_inside_the_look_back(spark):
    t = ny("2025-11-28 10:00:00")
    rows = [version(t, s, float(s)) for s in (60, 89, 90, 300, 389, 390, 500)]
    kept = S.accepted(spark.createDataFrame(rows, SCHEMA)).orderBy("arrival_ts").collect()
    # Visible 30 s after its end; asked for again for five polls.
    assert [r["close"] for r in kept] == [90.0, 300.0, 389.0]
    first = S.accepted(spark.createDataFrame(rows, SCHEMA), T.instant_literal("2025-11-28 10:07:00")).count()
    assert first == 4


def test_stream_ends_after_the_session(spark):
    last = ny("2025-11-28 12:59:00")
    rows = [version(last, 390, 1.0), version(last, 391, 2.0), version(ny("2025-11-28 13:00:00"), 120, 3.0)]
    days = calendar(spark, "2025-11-28", "2025-11-28", [], [("2025-11-28", "13:00")])
    assert [r["close"] for r in S.until_session_end(spark.createDataFrame(rows, SCHEMA), days).collect()] == [1.0]


def test_stream_equals_batch_and_counts_gaps(spark, tmp_path):
    source = str(tmp_path / "in")
    grid = minutes("2025-11-28", "09:30", "12:59")
    early = [version(t, 95, 1.0) for t in grid[:60] if t.minute != 40]
    heal = [version(t, 200, 2.0) for t in grid[56:60]] + [version(t, 95, 1.0) for t in grid[60:120]]
    rest = [version(t, 95, 1.0) for t in grid[120:]]
    for part in (early, heal, rest):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    days = calendar(spark, "2025-11-28", "2025-11-28", [], [("2025-11-28", "13:00")])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    folder = S.run_live(stream, "test-live", days)
    got = {r["ts"]: r["close"] for r in S.live_table(spark, f"{folder}/bars").collect()}
    want = {r["ts"]: r["close"] for r in S.newest_versions(S.accepted(spark.read.schema(SCHEMA).parquet(source))).collect()}
    assert got == want and len(got) == 209 and sorted(got.values()).count(2.0) == 4
    poll = S.poll_table(spark, folder).first()
    assert (poll["total_bar_count_int"], poll["missing_count_int"], poll["missing_str"]) == (209, 1, "09:40")
    batches = spark.read.parquet(f"{folder}/bars").select("batch").distinct().count()
    assert batches == 3


def test_no_version_is_late_because_of_another_symbol(spark, tmp_path):
    """Accepted versions survive whatever came before them in other micro-batches, backfill included."""
    source, t = str(tmp_path / "in"), ny("2025-11-28 10:00:00")
    ahead = ny("2025-11-28 12:00:00")
    rows = [version(ahead, 95, 1.0), version(t, 95, 2.0), ("y", *version(t, 99, 3.0)[1:]), version(ny("2025-11-28 09:31:00"), 95, 4.0)]
    for row in rows:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    folder = S.run_live(stream, "test-late", backfill_until=T.instant_literal("2025-11-28 12:01:35"))
    assert sorted(r["close"] for r in S.live_table(spark, f"{folder}/bars").collect()) == [1.0, 2.0, 3.0, 4.0]


def test_equal_arrivals_have_one_winner(spark):
    t = ny("2025-11-28 10:00:00")
    rows = [version(t, 95, float(k)) for k in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA)
    picked = {S.newest_versions(frame.repartition(n)).first()["close"] for n in (1, 2, 3, 5, 7)}
    assert len(picked) == 1
    numbered = frame.withColumn("seq", F.col("close").cast("long"))
    assert S.newest_versions(numbered.repartition(4)).first()["close"] == 19.0


def test_repeating_a_batch_replaces_it(spark, tmp_path):
    path = str(tmp_path / "bars")
    batch = spark.createDataFrame([version(ny("2025-11-28 10:00:00"), 95, 1.0)], SCHEMA)
    S.write_batch(batch, 0, path)
    S.write_batch(batch, 0, path)
    S.write_batch(batch, 1, path)
    assert spark.read.parquet(path).count() == 2 and S.live_table(spark, path).count() == 1


def test_tumbling_bars(spark):
    rows = [("x", f"2024-01-02 14:30:{s:02d}", p) for s, p in ((1, 5.0), (20, 9.0), (40, 3.0))] + [("x", "2024-01-02 14:31:00", 4.0)]
    ticks = spark.createDataFrame(rows, "symbol string, t string, price double").select("symbol", F.to_timestamp("t").alias("ts"), "price", F.lit(1.0).alias("volume"))
    got = [tuple(r)[2:] for r in S.minute_bars(ticks).orderBy("ts").collect()]
    assert got == [(5.0, 9.0, 3.0, 3.0, 3.0), (4.0, 4.0, 4.0, 4.0, 1.0)]


def ticks_of(spark, rows):
    frame = spark.createDataFrame(rows, "symbol string, t string, price double, seq long")
    return frame.select("symbol", F.to_timestamp("t").alias("ts"), "price", F.lit(1.0).alias("volume"), "seq")


def test_late_ticks_heal_their_bar_and_ties_go_by_number(spark, tmp_path):
    """Batches out of order: the earliest tick comes last, two share an instant, and a repeated batch changes nothing."""
    source = str(tmp_path / "ticks")
    batches = [
        [("x", "2024-01-02 16:00:30", 5.0, 4), ("x", "2024-01-02 16:00:30", 6.0, 3)],
        [("x", "2024-01-02 19:00:00", 9.0, 9)],
        [("x", "2024-01-02 16:00:01", 2.0, 1), ("x", "2024-01-02 16:00:30", 7.0, 5)],
    ]
    for rows in batches:
        ticks_of(spark, rows).coalesce(1).write.mode("append").parquet(source)
    schema = ticks_of(spark, batches[0]).schema
    folder = S.run_bars(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), "test-bars")
    want = [(2.0, 7.0, 2.0, 7.0, 4.0), (9.0, 9.0, 9.0, 9.0, 1.0)]
    told = lambda: [tuple(r)[2:] for r in S.bar_table(spark, f"{folder}/bars").orderBy("ts").collect()]
    assert told() == want
    S.write_batch(S.partial_bars(ticks_of(spark, batches[2])), 2, f"{folder}/bars")
    assert told() == want
    assert [tuple(r)[2:] for r in S.minute_bars(spark.read.parquet(source)).orderBy("ts").collect()] == want
    plan = S.bar_table(spark, f"{folder}/bars")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "StateStore" not in plan


def data_files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*.parquet"))


def test_finished_dates_are_folded_into_one_batch(spark, tmp_path, monkeypatch):
    """Batches of a finished date become one, the stream goes on, and a fold that is lost half way is completed."""
    from pathlib import Path

    from candlewright.plans import publish as PB
    from candlewright.sources import files as FS

    source = str(tmp_path / "in")
    days = ["2025-11-26", "2025-11-28"]

    def feed(numbers):
        for k in numbers:
            rows = [version(ny(f"{d} 10:{m:02d}:00"), 95 + k, float(k)) for d in days for m in range(k, k + 3)]
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run(folder=None):
        return S.run_live(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), "test-fold", folder=folder)

    def table():
        return sorted(map(tuple, S.live_table(spark, f"{folder}/bars").collect()))

    feed(range(4))
    folder = run()
    before = table()
    assert S.compact(spark, folder, "2025-11-28") == {"2025-11-26": 4}
    bars = Path(folder.removeprefix("file:")) / "bars"
    assert len(data_files(bars / "session_date=2025-11-26")) == 1 and len(list((bars / "session_date=2025-11-28").iterdir())) == 4
    assert table() == before and S.compact(spark, folder, "2025-11-28") == {}
    feed([4, 5])
    run(folder)
    real, calls = FS.move, []

    def dies(session, origin, goal):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(goal)
        real(session, origin, goal)

    after = table()
    assert len(after) == len(before) + 4
    monkeypatch.setattr(FS, "move", dies)
    try:
        S.compact(spark, folder, "2025-11-28")
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    assert len(PB.pending(spark, f"{folder}/bars")) == 1
    assert S.compact(spark, folder, "2025-11-28") == {} and table() == after
    assert len(data_files(bars / "session_date=2025-11-26")) == 1
    assert not [e.name for e in FS.listing(spark, folder) if "_fold" in e.name or "_intent_" in e.name]
    # A batch that the stream has not committed stays as it is.
    monkeypatch.setattr(S, "committed_batch", lambda *a: 3)
    assert S.compact(spark, folder, "2026-01-01") == {"2025-11-28": 4}
    assert table() == after
