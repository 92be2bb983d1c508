from decimal import Decimal

from pyspark.sql import functions as F

from candlewright.functions import periods as P, times as T, values as V
from candlewright.operators import zones as Z


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_bar_date_field(spark):
    fields = ["1520434800", "1562074200", "20190702 13:45:10 US/Eastern", "20190702 13:45:10", "20180307"]
    shown = values(spark, [(f,) for f in fields], "f string", T.offset_text(T.bar_date(F.col("f"))))
    assert shown == [
        "2018-03-07 10:00:00-05:00", "2019-07-02 09:30:00-04:00", "2019-07-02 13:45:10-04:00", "2019-07-02 13:45:10-04:00", "2018-03-07 00:00:00-05:00",
    ]
    labels = values(spark, [(f,) for f in fields], "f string", T.label_text(T.bar_date(F.col("f")), T.bar_date_is_daily(F.col("f"))))
    assert labels[0] == "2018-03-07 10:00" and labels[4] == "2018-03-07"


def test_instants_of_any_offset_are_equal(spark):
    texts = [("2018-03-07 10:00:00-05:00",), ("2018-03-07 20:30:00+05:30",), ("tomorrow",)]
    seconds = values(spark, texts, "t string", F.unix_seconds(T.instant(F.col("t"))))
    assert seconds[0] == seconds[1] == 1520434800 and seconds[2] is None


def test_volume_text_and_class(spark):
    rows = [(v,) for v in (88421.0, 7.25, 0.0, -3.0, float(2**127 - 1), 1e15)]
    assert values(spark, rows, "v double", V.volume_text(F.col("v"))) == ["88421", "7.25", "0", "-3", "", "1000000000000000"]
    assert values(spark, rows, "v double", V.volume_class(F.col("v"))) == ["present", "present", "zero_or_negative", "zero_or_negative", "unset", "unset"]


def test_number_text(spark):
    rows = [("119.40",), ("",), ("x",), ("NaN",), (None,)]
    assert values(spark, rows, "t string", V.number(F.col("t"))) == [119.4, None, None, None, None]


def test_error_classes(spark):
    rows = [
        (2099, "below"), (2100, "first"), (2199, "last"), (2200, "above"), (162, "too fast: PACING VIOLATION seen"), (162, "the source returned no data at all"),
        (163, "pacing violation under another number"), (200, "nothing of that name"), (162, "else"), (162, None),
    ]
    got = values(spark, rows, "c int, t string", V.error_class(F.col("c"), F.col("t")))
    assert got == ["error", "info", "info", "error", "pacing", "no_data", "error", "error", "error", "error"]


def test_diagnoses(spark):
    rows = [
        ("complete", None, "", 5), ("complete", None, "", 0), ("error", 162, "account has NO MARKET DATA PERMISSIONS here", 0),
        ("error", 354, "ask the desk", 0), ("no_data", 162, "empty window", 0),
        ("error", 200, "unheard of", 0), ("pacing", 162, "slow down", 0), ("timeout", None, "", 0),
        ("error", 999, "anything", 0),
    ]
    got = values(spark, rows, "s string, c int, t string, n int", V.diagnosis(F.col("s"), F.col("c"), F.col("t"), F.col("n")))
    assert got[:4] == ["data returned", "completed with nothing returned", "market data permission missing", "market data permission missing"]
    assert got[4].startswith("no data for this window") and got[5].startswith("contract not found") and got[6].startswith("pacing")
    assert got[7].startswith("no answer") and got[8] == "IBKR error (see error_text)"


def test_attempt_rules(spark):
    rows = [("pacing", 1, 9), ("pacing", 1, 10), ("partial", 2, 0), ("partial", 3, 0), ("error", 2, 0), ("complete", 1, 0), ("empty", 3, 0)]
    args = (F.col("s"), F.col("a"), F.col("p"))
    schema = "s string, a int, p int"
    assert values(spark, rows, schema, V.wants_retry(*args)) == [True, False, True, False, True, False, False]
    assert values(spark, rows, schema, V.wants_save(*args)) == [False, False, False, True, False, True, False]


def test_candle_rule(spark):
    inf = float("inf")
    rows = [
        (1.0, 2.0, 0.5, 1.5), (1.0, 1.2, 0.5, 1.5), (1.0, 2.0, 1.1, 1.5), (0.0, 2.0, 0.5, 1.5), (None, 2.0, 0.5, 1.5), (1.0, inf, 0.5, 1.5),
        (1.0, float("nan"), 0.5, 1.5), (1.0, 1.0, 1.0, 1.0),
    ]
    rule = V.broken_candle(*[F.col(c) for c in ("o", "h", "l", "c")])
    assert values(spark, rows, "o double, h double, l double, c double", rule) == [False, True, True, True, True, True, True, False]


def test_period_names(spark):
    names = [("2024",), ("202402",), ("20240229",)]
    assert [str(d) for d in values(spark, names, "p string", P.first_date(F.col("p")))] == ["2024-01-01", "2024-02-01", "2024-02-29"]
    assert [str(d) for d in values(spark, names, "p string", P.last_date(F.col("p")))] == ["2024-12-31", "2024-02-29", "2024-02-29"]
    assert values(spark, names, "p string", P.period_kind(F.col("p"))) == ["year", "month", "day"]
    files = [("ohlcv_data_2024.csv",), ("ohlcv_data_20241.csv",), ("notes.txt",), ("ohlcv_live_20240101.csv",), ("ohlcv_data_202402.csv",)]
    assert values(spark, files, "f string", P.period_of_file(F.col("f"))) == ["2024", None, None, None, "202402"]


def test_roll_up_rule(spark):
    now = F.lit("2026-10-06 12:00:00").cast("timestamp")
    names = ["20261005", "202609", "2025", "20260814", "202512", "20251231", "20261101"]
    got = values(spark, [(n,) for n in names], "p string", P.organized_period(F.col("p"), now))
    assert got == ["20261005", "202609", "2025", "202608", "2025", "2025", "20261101"]
    late = F.lit("2026-09-30 23:30:00").cast("timestamp")
    assert values(spark, [("20260930",)], "p string", P.organized_period(F.col("p"), late)) == ["20260930"]


def test_epoch_and_zone_gap(spark):
    row = spark.range(1).select(
        T.wall_to_epoch(F.lit("2019-12-30 16:00:00")).alias("e"),
        T.zone_gap_hours(T.instant_literal("2024-01-10 12:00:00"), Z.QATAR).alias("winter"),
        T.zone_gap_hours(T.instant_literal("2024-07-10 12:00:00"), Z.QATAR).alias("summer"),
    ).first()
    assert row["e"] == 1577739600 and row["winter"] == 8.0 and row["summer"] == 7.0


def test_latest_rows_hide_prices(spark):
    rows = [("daily_bars_latest", "1/2/3/4"), ("daily_bars", "1/2/3/4")]
    assert values(spark, rows, "t string, p string", V.hide_latest(F.col("t"), F.col("p"))) == ["", "1/2/3/4"]


def test_numbers_and_their_text(spark):
    values = [1.23456789e7, 1.2e-4, 5e-5, 1e22, -1.5e-7, 100.25, 1e7, 0.001, -123456789012.5, 1.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", V.plain_text(F.col("v")).alias("text")).collect()
    for r in rows:
        want = format(Decimal(repr(r["v"])), "f")
        assert r["text"] == (want if "." in want else f"{want}.0")
    texts = {"1.5d": None, "2f": None, "1e3": 1000.0, " 7 ": 7.0, "-.5": -0.5, "NaN": None, "abc": None, "": None, "1.": 1.0, "0x1p3": None}
    found = spark.createDataFrame([(k,) for k in texts], "t string").select("t", V.number(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in found} == texts
