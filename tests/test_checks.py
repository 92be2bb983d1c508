import random
from collections import Counter
from datetime import timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from bars import NY, calendar, minutes, ny
from candlewright.operators import bars as B, calendar as C, checks as K

UTC = ZoneInfo("UTC")


def frame(spark, rows, schema="symbol string, ts timestamp"):
    return spark.createDataFrame([(s, t.astimezone(UTC)) for s, t in rows], schema)


def filed(spark, rows):
    """symbol, date, ts from (symbol, date text, ts)."""
    raw = spark.createDataFrame([(s, d, t.astimezone(UTC)) for s, d, t in rows], "symbol string, d string, ts timestamp")
    return raw.select("symbol", F.to_date("d").alias("date"), "ts")


def listed(labels, limit=10):
    text = ", ".join(labels[:limit])
    return text + (f" (+{len(labels) - limit} more)" if len(labels) > limit else "")


def brute_issues(rows, sessions, limit=10):
    """Plain sets over the small fixture: symbol -> date -> expected report row."""
    out = {}
    for symbol in {s for s, _ in rows}:
        own = [t for s, t in rows if s == symbol]
        start = min(t.astimezone(NY).date() for t in own)
        counts = Counter(own)
        days = {t.astimezone(NY).date() for t in own} | {d for d in sessions if d >= start}
        for day in days:
            grid = sessions.get(day, []) if day >= start else []
            seen = sorted(t for t in counts if t.astimezone(NY).date() == day)
            n = sum(counts[t] for t in seen)
            missing = [t for t in grid if t not in counts]
            extra = [t for t in seen if t not in grid]
            labels = [
                label for label, hit in (
                    ("no_session", not grid), ("missing_session", bool(grid) and n == 0), ("missing_minutes", bool(missing) and n > 0),
                    ("extra_minutes", bool(extra) and bool(grid)), ("duplicate_rows", n > len(seen)),
                ) if hit
            ]
            if missing or extra or n > len(seen):
                clock = lambda ts: [t.astimezone(NY).strftime("%H:%M") for t in ts]
                out[symbol, str(day)] = (",".join(labels), len(grid), n, len(seen), len(missing), listed(clock(missing)), len(extra), listed(clock(extra)), n - len(seen))
    return out


def test_issue_report_matches_brute_force_with_off_grid_and_hot_labels(spark):
    rng = random.Random(7)
    days = ["2025-03-05", "2025-03-06", "2025-03-07", "2025-03-10", "2025-03-11"]
    sessions = {ny(f"{d} 00:00:00").date(): [t for t in minutes(d)] for d in days}
    rows = []
    for symbol in ("a", "b"):
        for d in days:
            if symbol == "b" and d == "2025-03-10":
                continue
            rows += [(symbol, t) for t in minutes(d) if rng.random() > 0.05]
        # A Saturday, the evening, seconds off the grid, and the clock change of 9 March.
        rows += [(symbol, ny(f"2025-03-08 12:00:0{i}")) for i in range(5)]
        rows += [(symbol, ny("2025-03-05 18:00:00") + timedelta(seconds=13 * i)) for i in range(40)]
        rows += [(symbol, ny("2025-03-09 10:00:00"))]
    # A third of all rows are copies of one label.
    rows += [("a", ny("2025-03-06 10:00:00"))] * (len(rows) // 2)
    got = K.issue_report(frame(spark, rows), calendar(spark, "2025-03-01", "2025-03-11"), "2025-03-11")
    report = {
        (r["symbol"], str(r["date"])): (
            r["issue_str"], r["expected_count_int"], r["bar_count_int"], r["unique_count_int"], r["missing_count_int"], r["missing_str"],
            r["extra_count_int"], r["extra_str"], r["duplicate_count_int"],
        )
        for r in got.collect()
    }
    assert report == brute_issues(rows, sessions)
    assert report["b", "2025-03-10"][0] == "missing_session"


def test_issue_report_start_rules(spark):
    rows = [("a", t) for t in minutes("2025-03-06")] + [("b", t) for t in minutes("2025-03-04")]
    days = calendar(spark, "2025-03-03", "2025-03-07")
    fixed = K.issue_report(frame(spark, rows), days, "2025-03-07", start_date="2025-03-05").orderBy("date").collect()
    # Bars before the start are ignored, so 'b' misses every session; 'a' misses the days around its own.
    assert sorted((r["symbol"], str(r["date"]), r["issue_str"]) for r in fixed) == [
        ("a", "2025-03-05", "missing_session"), ("a", "2025-03-07", "missing_session"),
        *[("b", d, "missing_session") for d in ("2025-03-05", "2025-03-06", "2025-03-07")],
    ]
    series = spark.createDataFrame([("a", "2025-03-06"), ("b", "2025-03-03"), ("c", "2025-03-06")], "symbol string, start_date string")
    own = K.issue_report(frame(spark, rows), days, "2025-03-07", series=series).orderBy("symbol", "date").collect()
    assert [(r["symbol"], str(r["date"])) for r in own] == [
        ("a", "2025-03-07"), ("b", "2025-03-03"), ("b", "2025-03-05"), ("b", "2025-03-06"), ("b", "2025-03-07"), ("c", "2025-03-06"), ("c", "2025-03-07"),
    ]


def test_session_check_statuses(spark):
    full, half = minutes("2025-11-26"), minutes("2025-11-28", "09:30", "12:59")
    rows = [("x", "2025-11-26", t) for t in full[30:]] + [("x", "2025-11-28", t) for t in half + half[:2] + [ny("2025-11-28 18:00:00")]]
    rows += [("x", "2025-11-29", ny("2025-11-29 10:00:00"))]
    days = calendar(spark, "2025-11-26", "2025-12-01", ["2025-11-27"], [("2025-11-28", "13:00")])
    asked = spark.createDataFrame([("x", "2025-12-01")], "symbol string, d string").select("symbol", F.to_date("d").alias("date"))
    got = {str(r["date"]): r for r in K.session_check(filed(spark, rows), days, asked).collect()}
    assert {d: r["status_str"] for d, r in got.items()} == {
        "2025-11-26": "partial", "2025-11-28": "complete", "2025-11-29": "no_session", "2025-12-01": "empty",
    }
    assert got["2025-11-26"]["missing_count_int"] == 30 and got["2025-11-26"]["missing_str"].startswith("09:30, 09:31,") and got["2025-11-26"]["missing_str"].endswith("(+20 more)")
    assert (got["2025-11-28"]["extra_count_int"], got["2025-11-28"]["duplicate_count_int"], got["2025-11-28"]["extra_str"]) == (1, 2, "18:00")
    assert got["2025-12-01"]["missing_count_int"] == 390


def test_bars_of_another_day_are_extra(spark):
    rows = [("x", "2025-11-26", t) for t in minutes("2025-11-26")] + [("x", "2025-11-26", ny("2025-11-25 10:00:00"))]
    row = K.session_check(filed(spark, rows), calendar(spark, "2025-11-24", "2025-11-26")).first()
    assert (row["status_str"], row["extra_count_int"], row["bar_count_int"]) == ("complete", 1, 391)


def test_core_hours(spark):
    def day(d, first="09:31", last="16:14", skip=()):
        return [("v", d, t) for t in minutes(d, first, last) if t.strftime("%H:%M") not in skip]

    rows = day("2026-09-14") + day("2026-09-15", skip=("10:00", "10:01")) + day("2026-09-22") + [("v", "2026-09-22", ny("2026-09-21 10:00:00"))]
    rows += day("2026-09-23", "03:15", skip=tuple(f"09:{m:02d}" for m in range(15, 31))) + day("2026-09-24", "16:00")
    rows += [("v", "2026-09-25", t + timedelta(seconds=20)) for t in minutes("2026-09-25", "10:00", "10:05")] + [("v", "2026-09-25", ny("2026-09-25 10:09:00"))]
    asked = spark.createDataFrame([("v", "2026-09-17")], "symbol string, d string").select("symbol", F.to_date("d").alias("date"))
    got = {str(r["date"]): r for r in K.core_hours_check(filed(spark, rows), asked).collect()}
    assert (got["2026-09-14"]["status_str"], got["2026-09-14"]["bar_count_int"], got["2026-09-14"]["expected_count_int"]) == ("complete", 404, 389)
    assert (got["2026-09-14"]["first_bar_str"], got["2026-09-14"]["last_bar_str"]) == ("09:31", "16:14")
    assert (got["2026-09-15"]["status_str"], got["2026-09-15"]["missing_count_int"], got["2026-09-15"]["missing_str"]) == ("partial", 2, "10:00 10:01")
    assert (got["2026-09-22"]["status_str"], got["2026-09-22"]["extra_str"]) == ("complete", "1 bar(s) of another date")
    assert (got["2026-09-23"]["status_str"], got["2026-09-23"]["missing_count_int"], got["2026-09-23"]["first_bar_str"]) == ("complete", 0, "03:15")
    # A session that starts after the core hours has nothing to miss.
    assert (got["2026-09-24"]["status_str"], got["2026-09-24"]["expected_count_int"]) == ("complete", 0)
    # The grid starts in the phase of the first bar: 10:00:20 .. 10:08:20, of which three are absent.
    assert (got["2026-09-25"]["expected_count_int"], got["2026-09-25"]["missing_str"]) == (9, "10:06 10:07 10:08")
    assert got["2026-09-17"]["status_str"] == "empty"


def test_daily_chunk(spark):
    wanted_days = [f"2026-09-{d:02d}" for d in (1, 2, 3, 4, 8, 9, 10, 11, 14, 15, 16, 17, 18)]
    got_days = [d for d in wanted_days if d != "2026-09-10"] + ["2026-09-07", "2026-09-14", "2026-09-21", "2025-12-31"]
    make = lambda days: spark.createDataFrame([("v", "2026", d) for d in days], "symbol string, label string, d string").select("symbol", "label", F.to_date("d").alias("date"))
    days = calendar(spark, "2025-12-01", "2026-10-01", ["2026-09-07"])
    row = K.daily_chunk_check(make(got_days), make(wanted_days), days).first()
    assert (row["status_str"], row["bar_count_int"], row["expected_count_int"], row["missing_count_int"]) == ("partial", 12, 13, 1)
    assert (row["missing_str"], row["extra_str"], row["duplicate_count_int"], row["extra_count_int"]) == ("2026-09-10", "2026-09-07", 1, 1)
    assert (row["first_bar_str"], row["last_bar_str"]) == ("2026-09-01", "2026-09-18")


def test_bar_summary(spark):
    rows = [("v", ny(f"2026-07-17 {t}:00").astimezone(UTC), 1.0, 2.0, 0.5, 1.5, float(2**127 - 1), i) for i, t in enumerate(["09:30", "09:31", "09:33"])]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double, pos bigint")
    row = K.bar_summary(bars, ["symbol"], "pos").first()
    assert (row["bars"], row["first_bar"], row["last_bar"], row["missing_minutes"]) == (3, "2026-07-17 09:30", "2026-07-17 09:33", 1)
    assert (row["volume_info"], row["first_bar_ohlc"]) == ("unset", "1.0/2.0/0.5/1.5")
    assert K.bar_summary(bars, ["symbol"], "pos", intraday=False).first()["first_bar"] == "2026-07-17"


def test_session_text_is_first_row_per_minute(spark):
    stamps = ["2025-11-28 09:29:00", "2025-11-28 09:30:00", "2025-11-28 09:30:00", "2025-11-28 12:59:00", "2025-11-28 13:00:00"]
    rows = [("x", ny(t).astimezone(UTC), 100.0 + i, 1.0, 1.0, 1.0, 12.5 if i == 3 else 1030.0, i) for i, t in enumerate(stamps)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double, pos bigint")
    days = calendar(spark, "2025-11-28", "2025-11-28", [], [("2025-11-28", "13:00")])
    text = K.session_text(bars, days, "pos").orderBy("timestamp").collect()
    assert [(r["timestamp"], r["open"], r["volume"], r["created_ts"], r["date"]) for r in text] == [
        ("2025-11-28 09:30:00-05:00", "101.0", "1030", "", "2025-11-28"), ("2025-11-28 12:59:00-05:00", "103.0", "12.5", "", "2025-11-28"),
    ]


def test_day_text_keeps_every_bar_of_the_day(spark):
    stamps = ["2026-09-14 03:15:00", "2026-09-14 16:14:00", "2026-09-14 16:14:00", "2026-09-13 10:00:00"]
    rows = [("v", ny(t).astimezone(UTC), 20.0 + i, 21.0, 19.5, 20.5, float(2**127 - 1) if i else 0.0, i) for i, t in enumerate(stamps)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double, pos bigint")
    text = K.day_text(bars.withColumn("date", F.lit("2026-09-14").cast("date")), "pos").orderBy("timestamp").collect()
    assert [(r["timestamp"], r["open"], r["volume"]) for r in text] == [("2026-09-14 03:15:00-04:00", "20.0", "0"), ("2026-09-14 16:14:00-04:00", "21.0", "")]


def test_edge_bars_of_a_short_session_repeat(spark):
    rows = [("x", "2026-09-14", t) for t in minutes("2026-09-14", "09:30", "09:33")]
    bars = filed(spark, rows).selectExpr("*", "1.0D open", "1.0D high", "1.0D low", "1.0D close")
    edges = B.edge_bars(bars)
    assert edges.count() == 6 and edges._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = {(r["edge"], r["position"], r["ts"]) for r in edges.collect()}
    stamps = [r["ts"] for r in bars.orderBy("ts").collect()]
    assert got == {("first", i + 1, t) for i, t in enumerate(stamps[:3])} | {("last", i + 1, t) for i, t in enumerate(stamps[::-1][:3])}


def test_plan_ranks_before_the_shuffle_and_reuses_the_exchange(spark):
    bars = frame(spark, [("x", t) for t in minutes("2026-09-14")])
    report = K.issue_report(bars, C.sessions(spark, "2026-09-01", "2026-09-30"), "2026-09-30")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    report.collect()
    assert "ReusedExchange" in report._jdf.queryExecution().executedPlan().toString()


def test_slot_masks_match_plain_sets(spark):
    rng = random.Random(11)
    rows = []
    for case in range(60):
        low = rng.randrange(0, 200)
        high = low + rng.randrange(0, 500)
        have = sorted(rng.sample(range(low, high + 1), rng.randrange(0, high - low + 2)))
        words = {}
        for slot in have:
            words[slot // 64] = words.get(slot // 64, 0) | (1 << slot % 64)
        signed = [(w, b - (1 << 64) if b >= 1 << 63 else b) for w, b in sorted(words.items())]
        rows.append((case, low, high, [s for s in range(low, high + 1) if s not in have][:7], have[:7], signed))
    frame = spark.createDataFrame(
        rows, "case int, low bigint, high bigint, gaps array<bigint>, have array<bigint>, words array<struct<word:int,inside:bigint>>"
    )
    missing = K._missing_words(F.col("words"), "inside", F.col("low"), F.col("high"))
    checked = frame.select(
        (K._first_slots(missing, "bits", 7) == F.col("gaps")).alias("gaps_ok"), (K._first_slots(F.col("words"), "inside", 7) == F.col("have")).alias("have_ok")
    )
    assert checked.where("not (gaps_ok and have_ok)").count() == 0


def test_symbols_outside_the_registry_stay(spark):
    days = calendar(spark, "2025-12-01", "2025-12-03", [])
    make = lambda rows: spark.createDataFrame(rows, "symbol string, t string").select("symbol", F.to_timestamp("t").alias("ts"))
    bars = make([("listed", "2025-12-02 14:30:00"), ("other", "2025-12-02 14:30:00")])
    series = spark.createDataFrame([("listed", "2025-12-01")], "symbol string, start_date string")
    found = {(r["symbol"], str(r["date"])) for r in K.issue_report(bars, days, "2025-12-03", series=series).select("symbol", "date").collect()}
    assert found == {("listed", d) for d in ("2025-12-01", "2025-12-02", "2025-12-03")} | {("other", d) for d in ("2025-12-02", "2025-12-03")}


def test_named_symbols_without_recent_bars_are_expected(spark):
    days = calendar(spark, "2025-12-01", "2025-12-03", [])
    bars = spark.createDataFrame([("live", "2025-12-02 14:30:00")], "symbol string, t string").select("symbol", F.to_timestamp("t").alias("ts"))
    known = spark.createDataFrame([("live",), ("stalled",)], "symbol string")
    found = K.issue_report(bars, days, "2025-12-03", "2025-12-02", symbols=known)
    assert {r["symbol"] for r in found.where("issue_str = 'missing_session'").collect()} == {"live", "stalled"}


def test_one_second_grid_with_gaps_anywhere(spark):
    rng = random.Random(5)
    day = ny("2024-03-05 09:30")
    sessions = C.sessions(spark, "2024-03-05", "2024-03-05", step_seconds=1)
    seconds = [day + timedelta(seconds=i) for i in range(23_400)]
    whole, holes = set(rng.sample(range(23_400), 20_000)), set(range(5_000, 9_000)) | {0, 23_399}
    rows = [("a", "2024-03-05", seconds[i]) for i in whole] + [("b", "2024-03-05", t) for i, t in enumerate(seconds) if i not in holes] + [("c", "2024-03-05", seconds[77])]
    got = {r["symbol"]: r for r in K.session_check(filed(spark, rows), sessions, step_seconds=1, max_listed=3).collect()}
    for symbol, missing in (("a", set(range(23_400)) - whole), ("b", holes), ("c", set(range(23_400)) - {77})):
        labels = [f"{seconds[i]:%H:%M:%S}" for i in sorted(missing)]
        assert (got[symbol]["missing_count_int"], got[symbol]["missing_str"]) == (len(missing), listed(labels, 3))
