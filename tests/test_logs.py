from pyspark.sql import functions as F

from candlewright.operators import coverage as V, logs as G
from candlewright.functions import times as T
from bars import calendar


def test_last_attempts_that_failed(spark):
    columns = "symbol string, bar_kind string, label string, status_str string, saved_bool string, error_code_int string, error_str string, n int"
    rows = [
        ("Q7", "daily", "chunk-03", "error", "False", "901", "link down", 7), ("Q7", "daily", "chunk-03", "partial", "True", "", "", 4),
        ("Q7", "daily", "chunk-04", "complete", "True", "", "", 2), ("Q7", "daily", "chunk-04", "timeout", "False", "", "late", 1),
        ("Q7", "daily", "chunk-05", "empty", "False", "", "", 5), ("R2", "daily", "chunk-04", "empty", "False", "", "", 3), ("Q7", "1min", "chunk-04", "empty", "False", "", "", 6),
    ]
    log = spark.createDataFrame(rows, columns).repartition(3)
    got = G.log_problems(log, ["symbol", "bar_kind", "label"], "n").collect()
    assert sorted((r["symbol"], r["bar_kind"], r["label"], r["status_str"], r["error_str"]) for r in got) == [
        ("Q7", "1min", "chunk-04", "empty", ""), ("Q7", "daily", "chunk-03", "error", "link down"), ("Q7", "daily", "chunk-05", "empty", ""), ("R2", "daily", "chunk-04", "empty", ""),
    ]
    assert {(r["symbol"], r["status_str"]): r["count"] for r in G.status_counts(log, ["symbol"]).collect()}["Q7", "empty"] == 2


PROBE = "symbol string, test string, status string, bars int, first_bar string, error_code int, error_text string, end_format string, row_id int"


def probe(spark, rows):
    return G.with_diagnosis(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], PROBE))


def test_probe_verdicts(spark):
    ok = ("complete", 5, "1990-01-02 09:30", None, "", "utc")
    denied = ("error", 0, "", 354, "not subscribed", "utc")
    rows = [("VIX", t, *ok) for t in ("contract_details", "earliest_data", "daily_bars", "minute_bars", "minute_bars_latest")]
    rows += [("VIX3M", "contract_details", *ok)] + [("VIX3M", t, *denied) for t in ("daily_bars", "minute_bars")]
    rows += [("NOPE", "contract_details", "error", 0, "", 200, "No security definition", "utc"), ("SPY (control)", "minute_bars", *ok)]
    frame = probe(spark, rows)
    got = {r["symbol"]: r for r in G.probe_symbol_summary(frame).collect()}
    assert set(got) == {"VIX", "VIX3M", "NOPE"} and got["VIX"]["contract_found"] and not got["NOPE"]["contract_found"]
    assert (got["VIX"]["earliest"], got["VIX"]["daily_ok"], got["VIX"]["minute_total"], got["VIX"]["latest_ok"]) == ("1990-01-02 09:30", 1, 1, 1)
    assert got["VIX3M"]["permission_errors"] == 2 and got["NOPE"]["earliest"] == "unknown"
    assert {(r["error_code"], r["count"]) for r in G.probe_errors(frame).collect()} == {(354, 2), (200, 1)}
    overall = G.probe_overall(frame).first()
    assert overall["conclusion"] == "permission missing" and overall["other_end_formats"] == "utc" and not overall["only_latest_works"]
    failed = probe(spark, [("VIX", "daily_bars", *denied), ("SPY (control)", "minute_bars", *denied)])
    assert G.probe_overall(failed).first()["conclusion"] == "control failed"
    late = probe(spark, [("VIX", "daily_bars", "error", 0, "", 321, "x", "utc"), ("VIX", "minute_bars_latest", *ok)])
    assert G.probe_overall(late).first()["only_latest_works"]


def dates(frame):
    return [str(r["date"]) for r in frame.orderBy("date").collect()]


def present(spark, days):
    return spark.createDataFrame([("v", d) for d in days], "symbol string, d string").select("symbol", F.to_date("d").alias("date"))


def series(spark, start):
    return spark.createDataFrame([("v", start)], "symbol string, d string").select("symbol", F.to_date("d").alias("start_date"))


def test_load_plan_rules(spark):
    days = calendar(spark, "2025-11-24", "2025-12-12", ["2025-11-27"])
    now = T.instant_literal("2025-12-12 16:04:00")
    have = present(spark, ["2025-11-25", "2025-12-08"])
    own = series(spark, "2025-11-26")
    plan = lambda **k: dates(V.load_plan(own, days, have, now, **k))
    assert plan() == ["2025-12-09", "2025-12-10", "2025-12-11"]
    assert plan(from_start=True)[:3] == ["2025-11-26", "2025-11-28", "2025-12-01"] and "2025-12-08" not in plan(from_start=True)
    assert plan(first="2025-11-24", last="2025-11-26") == ["2025-11-24", "2025-11-26"]
    assert plan(first="2025-11-24", last="2025-11-26", clamp_to_start=True) == ["2025-11-26"]
    assert plan(first="2025-11-24", last="2025-11-26", reload=True) == ["2025-11-24", "2025-11-25", "2025-11-26"]
    assert plan(wanted=["2025-11-27", "2025-11-28", "2025-12-08"]) == ["2025-11-28"]
    (lost,) = V.load_plan(own, days, have, now, look_back_days=2).collect()
    assert (lost["symbol"], lost["date"], lost["reason"]) == ("v", None, V.NOTHING_RECENT)
    assert plan(look_back_days=400) == ["2025-12-09", "2025-12-10", "2025-12-11"]
    assert plan(finished_rule=True, first="2025-12-12") == []


def test_year_chunks(spark):
    days = calendar(spark, "2025-12-01", "2026-10-06", ["2025-12-25", "2026-01-01"])
    now = T.instant_literal("2026-10-06 18:00:00")
    wanted = present(spark, ["2025-12-29", "2025-12-31", "2026-01-02", "2026-01-05", "2026-10-05"])
    got = {r["label"]: r for r in V.year_chunks(wanted, days, now).collect()}
    assert (got["2025"]["wanted_count"], got["2025"]["session_count"], got["2025"]["end_str"]) == (2, 3, "20260103-05:00:00")
    assert got["2026"]["end_str"] == "" and [str(d) for d in got["2026"]["wanted_dates"]][:2] == ["2026-01-02", "2026-01-05"]


def test_missing_and_coverage(spark):
    days = calendar(spark, "2025-12-01", "2025-12-05")
    have = present(spark, ["2025-12-02"])
    last = F.lit("2025-12-05").cast("date")
    assert dates(V.missing_sessions(series(spark, "2025-12-01"), days, have, last)) == ["2025-12-01", "2025-12-03", "2025-12-04", "2025-12-05"]
    row = V.missing_summary(series(spark, "2025-12-01"), days, have, last, 2).first()
    assert (row["expected_count"], row["missing_count"], row["first_missing"], row["last_missing"]) == (5, 4, "2025-12-01 2025-12-03", "2025-12-04 2025-12-05")
    bars = have.withColumn("bar_kind", F.lit("1min")).withColumn("place", F.lit("raw"))
    files = spark.createDataFrame([("v", "1min", "raw", 1500000), ("v", "1min", "raw", 700000)], "symbol string, bar_kind string, place string, length bigint")
    keys = ["symbol", "bar_kind", "place"]
    grid = V.coverage_grid(series(spark, "2025-12-01"), ["1min", "daily"], ["raw", "staging"])
    got = {(r["bar_kind"], r["place"]): r for r in V.coverage_status(grid, V.place_summary(bars, keys), V.file_summary(files, keys)).collect()}
    assert len(got) == 4 and got["1min", "raw"]["exists_bool"] and not got["daily", "raw"]["exists_bool"]
    raw = got["1min", "raw"]
    assert (raw["row_count_int"], raw["file_count_int"], raw["size_mb_float"], raw["first_date_str"]) == (1, 2, 2.2, "2025-12-02")
    assert got["daily", "staging"]["row_count_int"] == 0 and got["daily", "staging"]["last_date_str"] == ""
