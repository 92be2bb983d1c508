"""Raw and staging zones end to end: gate, append, fold, roll up, rebuild, roll back."""

import pytest
from pyspark.sql import functions as F

from bars import TEXT, calendar, text_frame, text_rows
from candlewright import schema as S
from candlewright.functions import times as T
from candlewright.operators import align as L, layout as Y
from candlewright.plans import publish as PB, reports as R, staging as G, zone as Z
from candlewright.sources import files as FS

NOW = "2026-10-06 12:00:00"
HOLIDAYS = ["2024-12-25", "2025-01-01"]


def put(frame, zone, period):
    Z.write_zone(frame.withColumn("period", F.lit(period)), zone)


def days(spark, names, utc=False):
    return text_frame(spark, [r for d in names for r in text_rows(d, utc)])


@pytest.fixture
def zones(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    put(days(spark, ["2024-12-23", "2024-12-24", "2024-12-26", "2024-12-27", "2024-12-30", "2024-12-31"], utc=True), raw, "2024")
    put(days(spark, [f"2025-12-0{d}" for d in range(1, 6)]), raw, "202512")
    put(days(spark, ["2024-12-31"]), raw, "20241231")
    (tmp_path / "raw" / "notes.txt").write_text("not data")
    for day in ("2025-12-08", "2025-12-09", "2025-12-03"):
        put(days(spark, [day]), staging, day.replace("-", ""))
    put(text_frame(spark, text_rows("2025-12-10")[30:]), staging, "20251210")
    put(days(spark, ["2025-12-13"]), staging, "20251213")
    broken = [list(r) for r in text_rows("2025-12-11")]
    broken[10][2] = "50.00"
    put(text_frame(spark, [tuple(r) for r in broken]), staging, "20251211")
    return raw, staging


def closed(spark):
    return calendar(spark, "2024-12-01", "2025-12-31", HOLIDAYS)


def decisions(frame):
    return {str(r["date"]): r["decision_str"] for r in frame.collect()}


def test_staging_merge_is_add_only(spark, zones, tmp_path):
    raw, staging = zones
    log = str(tmp_path / "merge_log")
    before = Z.read_zone(spark, raw).count()
    dry = decisions(G.merge_minutes(spark, staging, raw, closed(spark), log_path=log))
    assert dry["2025-12-08"] == dry["2025-12-09"] == "add"
    assert dry["2025-12-03"].startswith("skip: date already in raw") and dry["2025-12-10"].startswith("skip: partial (30 missing")
    assert dry["2025-12-13"].startswith("skip: not a closed") and dry["2025-12-11"].startswith("skip: candlestick")
    assert Z.read_zone(spark, raw).count() == before and not FS.exists(spark, log)
    done = G.merge_minutes(spark, staging, raw, closed(spark), True, True, bad_tick=F.col("close") > 103, log_path=log)
    assert sorted(d for d, v in decisions(done).items() if v == "added") == ["2025-12-08", "2025-12-09", "2025-12-10"]
    assert done.where("date = date'2025-12-08'").first()["bad_tick_count_int"] > 0
    assert Z.read_zone(spark, raw).count() == before + 390 + 390 + 360
    logged = spark.read.parquet(log)
    assert logged.columns == ["symbol", *S.MERGE_LOG_COLUMNS] and logged.count() == 3
    again = G.merge_minutes(spark, staging, raw, closed(spark), True, True, log_path=log)
    assert "added" not in decisions(again).values() and Z.read_zone(spark, raw).count() == before + 1140


def test_issues_clean_and_organize(spark, zones):
    raw, staging = zones
    G.merge_minutes(spark, staging, raw, closed(spark), True, True)
    now = T.instant_literal(NOW)
    report = R.zone_issues(spark, [raw], closed(spark), now, "2025-12-31", "2024-12-23")
    issues = {str(r["date"]): r["issue_str"] for r in report.collect()}
    assert (issues["2024-12-31"], issues["2025-12-10"], issues["2025-01-02"]) == ("duplicate_rows", "missing_minutes", "missing_session")
    cleaned = Z.clean_orphans(spark, raw, True).collect()
    assert sorted((r["target_str"], r["status_str"]) for r in cleaned) == [("2024", "merged"), ("202512", "merged")]
    organized = Z.organize(spark, raw, now, True).collect()
    assert [r["target_str"] for r in organized] == ["2025"] and Z.periods(spark, raw) == ["2024", "2025"]
    assert Z.organize(spark, raw, now, True).count() == 0 and Z.clean_orphans(spark, raw, True).count() == 0
    after = R.zone_issues(spark, [raw], closed(spark), now, "2025-12-31", "2024-12-23")
    labels = {str(r["date"]): r["issue_str"] for r in after.collect()}
    assert not any("duplicate" in v for v in labels.values()) and "2025-12-10" in labels
    rows = Z.read_zone(spark, raw)
    assert rows.count() == rows.select("ts").distinct().count() == 6 * 390 + 8 * 390 - 30
    assert FS.exists(spark, f"{raw}/notes.txt")


def test_dry_run_counts_and_existing_rows_win(spark, zones):
    raw, _ = zones
    row = [list(r) for r in text_rows("2024-12-31")]
    row[0][2] = "999.99"
    put(text_frame(spark, [tuple(row[0])]), raw, "202412")
    planned = {r["target_str"]: r for r in Z.organize(spark, raw, T.instant_literal(NOW)).collect()}
    year = planned["2024"]
    assert (year["status_str"], year["input_row_count"], year["output_row_count"], year["conflict_minute_count"]) == ("dry_run", 7 * 390 + 1, 6 * 390, 1)
    assert Z.periods(spark, raw) == ["2024", "202412", "20241231", "202512"]
    Z.organize(spark, raw, T.instant_literal(NOW), True)
    kept = Z.read_zone(spark, raw)
    assert kept.where("high = '999.99'").count() == 0
    assert kept.where("timestamp = '2024-12-31 14:30:00+00:00'").first()["open"] == "100.00"


def test_a_failed_swap_is_put_back(spark, zones, monkeypatch):
    raw, _ = zones
    before = Z.periods(spark, raw)
    count = Z.read_zone(spark, raw).count()
    real, calls = FS.move, []

    def failing(session, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise PermissionError("access denied")
        real(session, source, target)

    monkeypatch.setattr(FS, "move", failing)
    result = Z.clean_orphans(spark, raw, True).first()
    assert result["status_str"] == "rolled_back"
    assert Z.periods(spark, raw) == before and Z.read_zone(spark, raw).count() == count


def test_rebuild_elsewhere_and_in_place(spark, zones, tmp_path):
    raw, _ = zones
    target, now = str(tmp_path / "rebuilt"), T.instant_literal(NOW)
    plan = {r["file_name_str"]: (r["row_count_int"], r["action_str"]) for r in Z.rebuild(spark, raw, target, now).collect()}
    assert plan == {"ohlcv_data_2024.csv": (6 * 390, "create"), "ohlcv_data_2025.csv": (5 * 390, "create")} and not FS.exists(spark, target)
    Z.rebuild(spark, raw, target, now, True)
    assert Z.periods(spark, target) == ["2024", "2025"] and Z.periods(spark, raw) == ["2024", "20241231", "202512"]
    # Rows of the year win over the day: they kept their UTC text.
    assert Z.read_zone(spark, target).where("date = '2024-12-31' and timestamp like '%+00:00'").count() == 390
    done = {r["file_name_str"]: r["action_str"] for r in Z.rebuild(spark, raw, raw, now, True).collect()}
    assert done["ohlcv_data_2024.csv"] == "replace" and done["ohlcv_data_20241231.csv"] == "remove (stale)" and done["ohlcv_data_2025.csv"] == "create"
    assert Z.periods(spark, raw) == ["2024", "2025"] and Z.read_zone(spark, raw).count() == 11 * 390


def daily(spark, rows):
    make = lambda d, close: (f"{d} 00:00:00-04:00", "20.0", "1000.0", "19.0", close, "", "", d)
    return text_frame(spark, [make(d, c) for d, c in rows])


def test_daily_merge_keeps_raw_rows(spark, tmp_path):
    raw, staging, log = str(tmp_path / "raw"), str(tmp_path / "staging"), str(tmp_path / "log")
    put(daily(spark, [("2026-09-14", "999.0")]), raw, "2026")
    put(daily(spark, [("2026-09-14", "100.5"), ("2026-09-15", "21.5")]), staging, "2026")
    put(daily(spark, [("2025-09-15", "-1.0")]), staging, "2025")
    dry = {r["file_name_str"]: r for r in G.merge_daily(spark, staging, raw).collect()}
    assert dry["ohlcv_data_2026.csv"]["decision_str"] == "merge" and dry["ohlcv_data_2025.csv"]["decision_str"].startswith("skip: 1 price issue(s)")
    done = {r["file_name_str"]: r for r in G.merge_daily(spark, staging, raw, True, log).collect()}
    assert done["ohlcv_data_2026.csv"]["decision_str"] == "merged" and done["ohlcv_data_2026.csv"]["conflict_minute_count_int"] == 1
    rows = Z.read_zone(spark, raw).orderBy("ts").collect()
    assert [(r["date"], r["close"]) for r in rows] == [("2026-09-14", "999.0"), ("2026-09-15", "21.5")]
    logged = spark.read.parquet(log)
    assert logged.columns == S.INDEX_MERGE_LOG_COLUMNS and [r["conflict_minute_count_int"] for r in logged.collect()] == ["1"]


def test_index_gate_on_zones(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    core = lambda d, skip=(): [r for r in text_rows(d, first="09:31", last="16:14") if r[0][11:16] not in skip]
    put(text_frame(spark, core("2026-09-14")), staging, "20260914")
    put(text_frame(spark, core("2026-09-15")), staging, "20260915")
    put(text_frame(spark, [(*r[:2], "19.0", *r[3:]) for r in core("2026-09-16")]), staging, "20260916")
    put(text_frame(spark, core("2026-09-17", ("11:00",))), staging, "20260917")
    put(text_frame(spark, core("2026-09-15")), raw, "20260915")
    dry = {str(r["date"]): r for r in G.merge_minutes(spark, staging, raw, None, index_rule=True).collect()}
    assert dry["2026-09-14"]["decision_str"] == "add" and dry["2026-09-15"]["decision_str"].startswith("skip: date already")
    assert dry["2026-09-16"]["price_issue_count_int"] == 404 and dry["2026-09-17"]["missing_count_int"] == 1
    log = str(tmp_path / "log")
    done = decisions(G.merge_minutes(spark, staging, raw, None, True, True, index_rule=True, log_path=log))
    assert sorted(d for d, v in done.items() if v == "added") == ["2026-09-14", "2026-09-17"]
    assert spark.read.parquet(log).columns == S.INDEX_MERGE_LOG_COLUMNS


def test_stage_saving(spark, tmp_path):
    staging = str(tmp_path / "staging")
    Z.save_stage(spark, days(spark, ["2025-12-08"]), staging, daily=False)
    Z.save_stage(spark, text_frame(spark, text_rows("2025-12-08")[:5], "Y"), staging, daily=False)
    # A new copy of a day replaces it, for its own symbol only.
    Z.save_stage(spark, text_frame(spark, text_rows("2025-12-08", base=200.0)[:3]), staging, daily=False)
    rows = Z.read_zone(spark, staging)
    assert {r["symbol"]: r["count"] for r in rows.groupBy("symbol").count().collect()} == {"X": 3, "Y": 5}
    year = str(tmp_path / "daily")
    Z.save_stage(spark, daily(spark, [("2026-09-14", "1.0"), ("2026-09-15", "2.0")]), year, daily=True)
    Z.save_stage(spark, daily(spark, [("2026-09-15", "9.0"), ("2026-09-16", "3.0")]), year, daily=True)
    assert [r["close"] for r in Z.read_zone(spark, year).orderBy("ts").collect()] == ["1.0", "2.0", "3.0"]


def test_orphan_rule_and_moves(spark):
    names = ["2025", "202609", "20250102", "20260903", "20261001"]
    catalog = Y.catalog_of(spark.createDataFrame([(n,) for n in names], "period_str string"))
    found = {r["period_str"]: r["target_period_str"] for r in Y.orphan_periods(catalog).collect()}
    assert found == {"2025": "2025", "202609": "202609", "20250102": "2025", "20260903": "202609", "20261001": "20261001"}
    covering = Y.covering(catalog, F.lit("2026-09-03").cast("date"), F.lit("2026-09-03").cast("date"))
    assert sorted(r["period_str"] for r in covering.collect()) == ["202609", "20260903"]
    assert [r["period_str"] for r in Y.ordered_catalog(catalog).collect()] == ["2025", "20250102", "202609", "20260903", "20261001"]


def test_hold_out_rows_never_reach_the_alignment_tables(spark):
    frame = spark.createDataFrame([("2026-05-13",), ("2026-05-14",)], "d string").select(F.to_date("d").alias("date"))
    assert [str(r["date"]) for r in L.before_cutoff(frame, "2026-05-14").collect()] == ["2026-05-13"]


def test_date_rows_prune_periods(spark, zones):
    raw, _ = zones
    frame = Z.date_rows(spark, [raw], "2024-12-31")
    assert frame.count() == 2 * 390
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan and "GreaterThanOrEqual(ts" in plan


def test_a_failed_rebuild_is_put_back(spark, zones, monkeypatch):
    raw, _ = zones
    before, count = Z.periods(spark, raw), Z.read_zone(spark, raw).count()
    real, calls = FS.move, []

    def failing(session, source, target):
        calls.append(source)
        if len(calls) == 4:
            raise PermissionError("access denied")
        real(session, source, target)

    monkeypatch.setattr(FS, "move", failing)
    with pytest.raises(OSError):
        Z.rebuild(spark, raw, raw, T.instant_literal(NOW), True)
    assert Z.periods(spark, raw) == before and Z.read_zone(spark, raw).count() == count


def test_a_start_date_reaches_the_scan(spark, zones):
    raw, _ = zones
    report = R.zone_issues(spark, [raw], closed(spark), T.instant_literal(NOW), "2025-12-31", "2025-12-01")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2025-12-01 05:00:00" in plan and "ReadSchema: struct<ts:timestamp,symbol:string>" in plan


def test_ingest_text_into_the_organised_layout(spark, tmp_path):
    zone = str(tmp_path / "zone")
    rows = text_rows("2025-12-31")[:2] + text_rows("2026-09-30")[:2] + text_rows("2026-10-05")[:2]
    Z.ingest(text_frame(spark, rows), zone, T.instant_literal(NOW))
    assert Z.periods(spark, zone) == ["2025", "202609", "20261005"] and TEXT.startswith("timestamp")


def test_one_day_opens_one_folder_of_many(spark, tmp_path):
    zone = str(tmp_path / "many")
    rows = spark.createDataFrame([("x", f"{y}{m:02d}", f"{y}-{m:02d}-03 15:00:00") for y in range(2000, 2010) for m in range(1, 13)], "symbol string, period string, t string")
    Z.write_zone(rows.select("symbol", "period", F.to_timestamp("t").alias("ts"), F.lit("1").alias("open")), zone)
    found = Z.date_rows(spark, [zone], "2005-07-03")
    assert found.count() == 1 and len(found.inputFiles()) == 1
    assert Z.date_rows(spark, [zone], "2020-01-01").count() == 0


def test_broken_append_leaves_raw_and_the_next_run_adds(spark, tmp_path, monkeypatch):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staged")
    row = lambda symbol, day: (symbol, day, f"{day[:4]}-{day[4:6]}-{day[6:]} 15:00:00")
    make = lambda rows: spark.createDataFrame(rows, "symbol string, period string, t string").select("symbol", "period", F.to_timestamp("t").alias("ts"), F.lit("1").alias("open"))
    Z.write_zone(make([row("a", "20240102")]), raw)
    Z.write_zone(make([row("a", "20240103"), row("b", "20240103"), row("b", "20240104")]), staging)
    pairs = spark.createDataFrame([("a", "2024-01-03"), ("b", "2024-01-04")], "symbol string, d string").select("symbol", F.to_date("d").alias("date"))
    before = sorted(map(tuple, Z.read_zone(spark, raw).select("symbol", "period").collect()))
    moves = []

    def break_second(spark_, source, target, move=FS.move):
        moves.append(target)
        if len(moves) == 2:
            raise OSError("lost")
        move(spark_, source, target)

    monkeypatch.setattr(FS, "move", break_second)
    with pytest.raises(OSError):
        G._append_accepted(spark, Z.read_zone(spark, staging), pairs, raw)
    monkeypatch.undo()
    spark.catalog.refreshByPath(raw)
    assert sorted(map(tuple, Z.read_zone(spark, raw).select("symbol", "period").collect())) == before
    added = G._append_accepted(spark, Z.read_zone(spark, staging), pairs, raw)
    Z.drop_rows(spark, staging, added, str(tmp_path / "merged"))
    assert sorted(map(tuple, Z.read_zone(spark, raw).select("symbol", "period").collect())) == [*before, ("a", "20240103"), ("b", "20240104")]
    assert [tuple(r) for r in Z.read_zone(spark, staging).select("symbol", "period").collect()] == [("b", "20240103")]


def test_first_of_repeated_rows_wins_whatever_the_file_sizes(spark, tmp_path):
    """A day holds a minute twice: first in a small file, later in a larger one."""
    zone = str(tmp_path / "repeats")
    cells = lambda value, n: spark.createDataFrame([("x", "20240103", f"2024-01-03 15:{i:02d}:00", value) for i in range(n)], "symbol string, period string, t string, close string")
    make = lambda frame: frame.select("symbol", "period", F.to_timestamp("t").alias("ts"), "close")
    Z.write_zone(make(cells("1.0", 1)), zone)
    Z.write_zone(make(cells("2.0", 60)), zone)
    Z.organize(spark, zone, T.instant_literal("2024-03-05 12:00:00"), True)
    first = Z.read_zone(spark, zone).orderBy("ts").first()
    assert (first["period"], first["close"]) == ("202401", "1.0")


class Killed(BaseException):
    """Stands for the end of the driver: nothing is put back."""


def killed_after(monkeypatch, n):
    real, calls = FS.move, []

    def move(session, source, target):
        if len(calls) == n:
            raise Killed
        calls.append(target)
        real(session, source, target)

    monkeypatch.setattr(FS, "move", move)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6])
def test_a_lost_add_is_completed_by_the_next_run(spark, zones, tmp_path, monkeypatch, n):
    """The driver ends after n moves; the next run ends with all rows of the added days in raw, and none of them staged."""
    raw, staging = zones
    log = str(tmp_path / "merge_log")
    before = Z.read_zone(spark, raw).count()
    killed_after(monkeypatch, n)
    with pytest.raises(Killed):
        G.merge_minutes(spark, staging, raw, closed(spark), True, True, log_path=log)
    monkeypatch.undo()
    assert PB.pending(spark, raw) and PB.pending(spark, staging)
    again = decisions(G.merge_minutes(spark, staging, raw, closed(spark), True, True, log_path=log))
    assert "added" not in again.values() and sorted(again) == ["2025-12-03", "2025-12-11", "2025-12-13"]
    assert Z.read_zone(spark, raw).count() == before + 390 + 390 + 360
    assert Z.read_zone(spark, staging).count() == 3 * 390 and spark.read.parquet(log).count() == 3
    left = [e.name for e in FS.listing(spark, str(tmp_path))]
    assert not any(mark in name for name in left for mark in ("_intent_", "_adding_", "_rest_", "_logging_"))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_a_lost_roll_up_is_completed_by_the_next_job(spark, zones, monkeypatch, n):
    raw, _ = zones
    rows = Z.read_zone(spark, raw).select("symbol", "ts").distinct().count()
    killed_after(monkeypatch, n)
    with pytest.raises(Killed):
        Z.organize(spark, raw, T.instant_literal(NOW), True)
    monkeypatch.undo()
    Z.organize(spark, raw, T.instant_literal(NOW), True)
    kept = Z.read_zone(spark, raw)
    assert Z.periods(spark, raw) == ["2024", "2025"] and kept.count() == kept.select("symbol", "ts").distinct().count() == rows


def test_moves_that_cannot_be_put_back_are_kept_for_the_next_job(spark, tmp_path, monkeypatch):
    for name in "ab":
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.parquet").write_text(name)
    zone = str(tmp_path / "zone")
    moves = [(f"{tmp_path}/{n}/x.parquet", f"{zone}/{n}.parquet") for n in "ab"]
    real, calls = FS.move, []

    def broken(session, source, target):
        calls.append(source)
        if len(calls) >= 2:
            raise OSError("no connection")
        real(session, source, target)

    monkeypatch.setattr(FS, "move", broken)
    with pytest.raises(PB.Unsettled):
        PB.publish(spark, moves, [zone])
    monkeypatch.undo()
    assert PB.recover(spark, zone) == 1 and PB.recover(spark, zone) == 0
    assert sorted(e.name for e in FS.listing(spark, zone)) == ["a.parquet", "b.parquet"]


def stored_stats(spark, zone):
    told = Z.read_stats(spark, zone).groupBy("period", "symbol").agg(F.min("first_ts").alias("a"), F.max("last_ts").alias("b"), F.sum("row_count").alias("n"))
    return sorted(map(tuple, told.collect()))


def true_stats(spark, zone):
    told = Z.read_zone(spark, zone).groupBy("period", "symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("n"))
    return sorted(map(tuple, told.collect()))


def test_statistics_follow_every_job(spark, zones, tmp_path):
    raw, staging = zones
    put(text_frame(spark, text_rows("2025-12-02")[:7], "Y"), raw, "202512")
    assert stored_stats(spark, raw) == true_stats(spark, raw) and len(stored_stats(spark, raw)) == 4
    G.merge_minutes(spark, staging, raw, closed(spark), True, True)
    assert stored_stats(spark, raw) == true_stats(spark, raw) and stored_stats(spark, staging) == true_stats(spark, staging)
    Z.clean_orphans(spark, raw, True)
    Z.organize(spark, raw, T.instant_literal(NOW), True)
    assert stored_stats(spark, raw) == true_stats(spark, raw)
    Z.save_stage(spark, text_frame(spark, text_rows("2025-12-13")[:5]), staging, daily=False)
    assert stored_stats(spark, staging) == true_stats(spark, staging)
    rebuilt = str(tmp_path / "rebuilt")
    Z.rebuild(spark, raw, rebuilt, T.instant_literal(NOW), True)
    assert stored_stats(spark, rebuilt) == true_stats(spark, rebuilt)


def test_a_report_opens_only_the_periods_it_needs(spark, zones):
    """Of the periods before the start date no data file is opened, yet their series are expected."""
    raw, _ = zones
    put(text_frame(spark, text_rows("2024-12-30")[:3], "OLD"), raw, "2024")
    report = R.zone_issues(spark, [raw], closed(spark), T.instant_literal(NOW), "2025-12-31", "2025-12-01")
    opened = [f for f in report.inputFiles() if "/raw/" in f]
    assert opened and all("/period=202512/" in f for f in opened)
    assert {r["symbol"] for r in report.collect()} >= {"OLD"}
    # A zone whose statistics are lost still tells the same.
    FS.remove(spark, Z.stats_path(raw))
    again = R.zone_issues(spark, [raw], closed(spark), T.instant_literal(NOW), "2025-12-31", "2025-12-01")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, report.collect()))


def test_columns_come_from_statistics(spark, zones, monkeypatch):
    raw, _ = zones
    put(days(spark, ["2025-12-06"]).withColumn("highest_val", F.lit("9")), raw, "202512")
    rows = Z.read_zone(spark, raw)
    assert {"highest_val", "load_seq", "row_pos", "period"} <= set(rows.columns) and rows.where("highest_val = '9'").count() == 390
    assert rows.where("highest_val is null").count() == rows.count() - 390
