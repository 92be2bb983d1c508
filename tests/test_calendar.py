from pyspark.sql import functions as F

from bars import calendar
from candlewright.functions import times as T
from candlewright.operators import calendar as C


def november(spark):
    return calendar(spark, "2025-11-26", "2025-12-01", ["2025-11-27"], [("2025-11-28", "13:00")])


def dates(frame):
    return [str(r["date"]) for r in frame.orderBy("date").collect()]


def test_sessions_with_holiday_and_half_day(spark):
    rows = november(spark).orderBy("date").collect()
    assert [(str(r["date"]), r["bar_count_int"]) for r in rows] == [("2025-11-26", 390), ("2025-11-28", 210), ("2025-12-01", 390)]
    half = november(spark).where("date = date'2025-11-28'").select(T.clock_text(F.col("last_bar_ts"))).first()
    assert half[0] == "12:59"
    assert C.session_minutes(november(spark)).groupBy("date").count().where("count = 210").count() == 1


def test_closed_needs_close_plus_buffer(spark):
    one = calendar(spark, "2025-12-01", "2025-12-01")
    assert dates(C.closed_sessions(one, T.instant_literal("2025-12-01 16:04:00"))) == []
    assert dates(C.closed_sessions(one, T.instant_literal("2025-12-01 16:05:00"))) == ["2025-12-01"]
    assert C.last_closed_session(november(spark), T.instant_literal("2025-12-01 12:00:00")).first()["date"].isoformat() == "2025-11-28"


def test_finished_rule(spark):
    two = calendar(spark, "2026-10-05", "2026-10-06")
    assert dates(C.finished_sessions(two, T.instant_literal("2026-10-06 16:30:00"))) == ["2026-10-05"]
    assert dates(C.finished_sessions(two, T.instant_literal("2026-10-06 17:00:00"))) == ["2026-10-05", "2026-10-06"]


def test_next_session_and_explicit_dates(spark):
    days = calendar(spark, "2004-12-27", "2005-01-14", ["2004-12-31"])
    lookup = C.next_session_lookup(days, "2004-12-27", "2005-01-14")
    found = {str(r["date"]): str(r["next_date"]) for r in lookup.collect()}
    assert found["2005-01-01"] == "2005-01-03" and found["2005-01-03"] == "2005-01-03" and found["2004-12-31"] == "2005-01-03"
    wanted = spark.createDataFrame([("2005-01-01",), ("2005-01-03",)], "date string").selectExpr("cast(date as date) date")
    sessions, others = C.split_requested(wanted, days)
    assert dates(sessions) == ["2005-01-03"] and dates(others) == ["2005-01-01"]


def test_lookup_stops_after_ten_days(spark):
    sparse = calendar(spark, "2024-01-01", "2024-01-31").where("date in (date'2024-01-02', date'2024-01-31')")
    lookup = C.next_session_lookup(sparse, "2024-01-01", "2024-01-31")
    found = {str(r["date"]): str(r["next_date"]) for r in lookup.collect()}
    assert "2024-01-10" not in found and found["2024-01-21"] == "2024-01-31" and found["2024-01-01"] == "2024-01-02"


def test_market_status(spark):
    days = calendar(spark, "2025-11-24", "2025-12-12", ["2025-11-27"], [("2025-11-28", "13:00")])
    lookup = C.next_session_lookup(days, "2025-11-24", "2025-12-12", 14)
    clocks = ["2025-11-29 10:00:00", "2025-11-28 12:59:30", "2025-11-28 13:00:00", "2025-12-02 09:00:00"]
    frame = spark.createDataFrame([(c,) for c in clocks], "clock string").withColumn("ts", T.from_wall(F.col("clock")))
    rows = {r["clock"]: r for r in C.with_market_status(frame, days, lookup).withColumn("next", F.date_format(T.wall(F.col("next_first_bar_ts")), "yyyy-MM-dd HH:mm")).collect()}
    saturday = rows["2025-11-29 10:00:00"]
    assert not saturday["session_today_bool"] and not saturday["market_open_bool"] and saturday["next"] == "2025-12-01 09:30"
    assert saturday["seconds_until_open_int"] == 47 * 3600 + 1800
    assert rows["2025-11-28 12:59:30"]["market_open_bool"] and rows["2025-11-28 12:59:30"]["seconds_until_close_int"] == 30
    assert not rows["2025-11-28 13:00:00"]["market_open_bool"]
    assert rows["2025-12-02 09:00:00"]["next"] == "2025-12-02 09:30" and rows["2025-12-02 09:00:00"]["seconds_until_open_int"] == 1800


def test_weekday_minutes_and_range_rules(spark):
    assert C.weekday_minutes(C.days(spark, "2024-11-04", "2024-11-10")).count() == 5 * 390
    now = T.instant_literal("2025-02-20 12:00:00")
    cases = [("2025-02-17", "2025-02-21", True), ("2025-02-17", "2025-02-25", False), ("2025-01-21", "2025-01-22", False), ("2025-01-22", "2025-01-24", True), ("2025-02-21", "2025-02-20", False)]
    frame = spark.createDataFrame([c[:2] for c in cases], "a string, b string").selectExpr("cast(a as date) a", "cast(b as date) b")
    got = frame.select(C.range_is_valid(F.col("a"), F.col("b"), now).alias("ok")).collect()
    assert [r["ok"] for r in got] == [c[2] for c in cases]


def test_weekly_load_plan(spark):
    series = spark.createDataFrame([("a", "2025-02-05 15:59:00"), ("b", "2025-02-20 11:59:00")], "symbol string, t string").select(
        "symbol", T.from_wall(F.col("t")).alias("last_ts")
    )
    loaded = spark.createDataFrame([("a", "20250203-20250207")], "symbol string, week string")
    rows = C.weekly_load_plan(series, loaded, ["symbol"], T.instant_literal("2025-02-20 12:00:00")).orderBy("symbol", "week").collect()
    # The clock is earlier than the last bar's time of day, so the current day is not counted for 'a'.
    assert [(r["symbol"], r["week"], r["valid"], r["loaded"]) for r in rows] == [
        ("a", "20250203-20250207", True, True), ("a", "20250210-20250214", True, False), ("a", "20250217-20250221", True, False),
        ("b", "20250217-20250221", True, False),
    ]
