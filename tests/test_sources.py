import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bars import text_rows
from candlewright import schema as S
from candlewright.functions import times as T
from candlewright.operators import merge as M, zones as O
from candlewright.plans import reports as R
from candlewright.sources import files as FS, readers as RD, sinks as SK, tables as TB


def write_bars(path, rows, header="timestamp,open,high,low,close,volume,created_ts,date"):
    path.write_text("\n".join([header, *[",".join(r) for r in rows]]) + "\n")


def test_bar_files_stay_text(spark, tmp_path):
    write_bars(tmp_path / "ohlcv_data_20251201.csv", text_rows("2025-12-01")[:3])
    extra = [(*r, "2025-12-02", "7") for r in text_rows("2025-12-02", utc=True)[:2]]
    write_bars(tmp_path / "ohlcv_data_202512.csv", extra, "timestamp,open,high,low,close,volume,created_ts,date,date,highest_val")
    paths = [e.path for e in FS.listing(spark, str(tmp_path)) if e.name.endswith(".csv")]
    rows = RD.read_bar_text(spark, paths, "X").orderBy("ts").collect()
    assert len(rows) == 5 and "date.1" not in rows[0].__fields__ and rows[0]["open"] == "100.00" and rows[0]["created_ts"] == ""
    assert rows[0]["highest_val"] == "" and rows[4]["highest_val"] == "7" and rows[4]["timestamp"] == "2025-12-02 14:31:00+00:00"
    assert RD.read_timestamps(spark, paths, "X").columns == ["symbol", "ts"]
    period = RD.read_bar_text(spark, paths).select(RD.file_period().alias("p")).distinct()
    assert sorted(r["p"] for r in period.collect()) == ["202512", "20251201"]


def test_period_catalog(spark, tmp_path):
    for name in ("ohlcv_data_2024.csv", "ohlcv_data_202401.csv", "ohlcv_data_20240101.csv", "ohlcv_data_20231231.csv", "notes.txt", "ohlcv_live_20240101.csv"):
        (tmp_path / name).write_text("timestamp\n")
    (tmp_path / "merged").mkdir()
    (tmp_path / "merged" / "ohlcv_data_20240102.csv").write_text("timestamp\n")
    (tmp_path / "empty").mkdir()
    assert FS.period_catalog(spark, str(tmp_path / "empty")).count() == 0
    rows = FS.period_catalog(spark, str(tmp_path)).collect()
    assert [r["period_str"] for r in rows] == ["20231231", "2024", "202401", "20240101"] and rows[0]["length"] == 10
    assert FS.period_catalog(spark, str(tmp_path / "absent")).count() == 0
    assert FS.has_extension("a/b.csv", "csv") and not FS.has_extension("a/.csv", "csv") and not FS.has_extension("a/b.txt", "csv")


def test_zone_reader_casts_and_filters(spark, tmp_path):
    text = "ny_timestamp,open,high,low,close,volume,stock_splits\n2024-11-04 09:30:00,1,2,0.5,x,10,0\n2024-11-05 09:30:00,1,2,0.5,1.5,11,0\n"
    (tmp_path / "a.csv").write_text(text)
    frame = RD.read_zone(spark, [str(tmp_path / "a.csv")], ordered=True)
    assert dict(frame.dtypes)["volume"] == "int" and [r["close"] for r in frame.collect()] == [None, 1.5]
    assert RD.read_zone(spark, [str(tmp_path / "a.csv")], first=datetime(2024, 11, 5)).count() == 1
    with pytest.raises(ValueError):
        RD.read_zone(spark, [])
    with pytest.raises(ValueError):
        RD.read_zone(spark, ["x"], first="2024-11-05")


def test_access_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a")], "n int, s string")
    assert not SK.write_table(frame, path, "parquet", "N") and not FS.exists(spark, path)
    assert not SK.write_table(frame.limit(0), path, "parquet", "W")
    assert SK.write_table(frame, path, "parquet", all_text=True) and spark.read.parquet(path).dtypes == [("n", "string"), ("s", "string")]
    assert not SK.write_table(frame, path, "parquet") and spark.read.parquet(path).count() == 1
    assert SK.write_table(frame, path, "parquet", "a", all_text=True) and spark.read.parquet(path).count() == 2
    assert SK.write_table(frame, path, "parquet", "W", all_text=True) and spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        SK.write_table(frame, path, "parquet", "X")


def test_reading_many_skips_what_is_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    (tmp_path / "junk.parquet").write_text("not parquet")
    assert RD.read_one(spark, str(tmp_path / "none.csv"), "csv") is None and RD.read_one(spark, str(tmp_path / "junk.parquet"), "parquet") is None
    both = RD.read_many(spark, [str(tmp_path / n) for n in ("a.csv", "none.csv", "b.csv")], "csv")
    assert sorted(both.columns) == ["x", "y", "z"] and both.count() == 2
    spark.createDataFrame([(1, "a")], "n int, s string").coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([(2, 0.5)], "n int, f double").coalesce(1).write.parquet(str(tmp_path / "two"))
    parquet = RD.read_many(spark, [str(tmp_path / n) for n in ("one", "junk.parquet", "none", "two")], "parquet")
    assert sorted(parquet.columns) == ["f", "n", "s"] and sorted(r["n"] for r in parquet.collect()) == [1, 2]
    assert RD.read_many(spark, [str(tmp_path / "junk.parquet")], "parquet") is None
    assert RD.read_prefix(spark, str(tmp_path), "csv").count() == 2 and RD.read_many(spark, [], "csv") is None


def test_documents(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps({"a": {"x": 1}, "b": "t"}, indent=2))
    (tmp_path / "list.json").write_text("[1, 2]")
    old = RD.read_document(spark, str(tmp_path / "doc.json"))
    assert {r["key"]: r["value"] for r in old.collect()} == {"a": '{"x":1}', "b": "t"}
    assert RD.read_document(spark, str(tmp_path / "list.json")).count() == 0
    path = str(tmp_path / "store")
    new = spark.createDataFrame([("a", '{"y":2}')], "key string, value string")
    assert SK.upsert_document(old, path, "A") and not SK.upsert_document(new, path, "I")
    assert SK.upsert_document(new, path, "A")
    assert {r["key"]: r["value"] for r in RD.read_document(spark, path).collect()} == {"a": '{"y":2}', "b": "t"}
    # Stored values keep their JSON type, and a document written by hand can be merged into.
    merged = str(tmp_path / "doc.json")
    assert SK.upsert_document(spark.createDataFrame([("n", "7"), ('q"', 'say "hi"'), ("none", None)], "key string, value string"), merged, "A")
    text = "".join(r["value"] for r in spark.read.text(merged, wholetext=True).collect())
    assert json.loads(text) == {"a": {"x": 1}, "b": "t", "n": 7, 'q"': 'say "hi"', "none": None}


def test_log_keeps_its_column_order(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([("partial", "2025-12-05", 3)], "status_str string, date string, attempt_int int")
    assert SK.append_log(row, path, S.DOWNLOAD_LOG_COLUMNS) and SK.append_log(row, path, S.DOWNLOAD_LOG_COLUMNS)
    assert not SK.append_log(row.limit(0), path, S.DOWNLOAD_LOG_COLUMNS)
    log = spark.read.parquet(path)
    assert log.columns == S.DOWNLOAD_LOG_COLUMNS and len(log.columns) == 18 and len(S.INDEX_DOWNLOAD_LOG_COLUMNS) == 23 and log.count() == 2
    assert SK.write_report(row, str(tmp_path / "report")) and spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 1


def test_tables(spark):
    assert TB.create_table(spark, "spy_bars", {"timestamp": "timestamp", "close": "double"}) and not TB.create_table(spark, "spy_bars", {})
    assert "spy_bars" in TB.list_tables(spark) and TB.read_table(spark, "spy_bars").columns == ["timestamp", "close", "id"]
    TB.append_rows(spark, "spy_bars", spark.createDataFrame([(1.5, 7)], "close double, id int"))
    assert [r.asDict() for r in TB.read_table(spark, "spy_bars").collect()] == [{"timestamp": None, "close": 1.5, "id": 7}]
    with pytest.raises(ValueError):
        TB.append_rows(spark, "spy_bars", spark.createDataFrame([(1,)], "price int"))
    with pytest.raises(ValueError):
        TB.append_rows(spark, "absent", spark.createDataFrame([(1,)], "price int"))
    assert TB.drop_table(spark, "spy_bars") and not TB.drop_table(spark, "spy_bars")


def zone_rows(spark, stamps):
    frame = spark.createDataFrame([(s, float(i)) for i, s in enumerate(stamps)], "t string, close double")
    return frame.select(F.to_timestamp("t").cast("timestamp_ntz").alias("ny_timestamp"), "close")


def test_week_slices_and_guarded_write(spark, tmp_path):
    path = str(tmp_path / "weeks")
    stamps = ["2025-02-17 09:29:59", "2025-02-17 09:30:00", "2025-02-18 23:00:00", "2025-02-21 15:59:00", "2025-02-21 15:59:01", "2025-02-22 10:00:00", "2025-02-24 10:00:00"]
    sliced = O.week_slices(zone_rows(spark, stamps))
    assert {r["week"]: r["count"] for r in sliced.groupBy("week").count().collect()} == {"20250217-20250221": 3, "20250224-20250228": 1}
    first = {r["week"]: r["action"] for r in R.load_weeks(zone_rows(spark, stamps), path).collect()}
    assert set(first.values()) == {"write"}
    grown = zone_rows(spark, [*stamps, "2025-02-25 10:00:00"])
    assert {r["week"]: r["action"] for r in R.load_weeks(grown, path).collect()} == {"20250217-20250221": "skip", "20250224-20250228": "overwrite"}
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="20250217"):
        R.load_weeks(zone_rows(spark, stamps[2:]), path)
    assert spark.read.parquet(path).count() == 5


def test_zone_shaping(spark):
    raw = spark.createDataFrame([("2025-02-18 09:30:00", 1.0, 0.0, 0.0)], "t string, Open double, Dividends double, `Stock Splits` double")
    raw = raw.select(T.from_wall(F.col("t")).alias("Datetime"), "Open", "Dividends", "Stock Splits")
    shaped = O.canonical_columns(raw)
    assert shaped.columns == ["ny_timestamp", "open", "stock_splits"] and str(shaped.first()["ny_timestamp"]) == "2025-02-18 09:30:00"
    pair = O.tz_pair(shaped).first()
    assert pair.__fields__[:2] == ["qatar_timestamp", "ny_timestamp"] and str(pair["qatar_timestamp"]) == "2025-02-18 17:30:00"
    back = O.tz_pair(O.tz_pair(shaped).select("qatar_timestamp", "open"), "qatar_timestamp", "qatar").first()
    assert str(back["ny_timestamp"]) == "2025-02-18 09:30:00"
    with pytest.raises(ValueError):
        O.tz_pair(shaped, current="utc")
    names = spark.createDataFrame([("yf_SP500_1m_20250217-20250221.csv",), ("other.csv",)], "file_name_str string")
    loaded = O.loaded_weeks(names, "yf_SP500_1m_")
    assert [r["week"] for r in loaded.collect()] == ["20250217-20250221"]
    wanted = spark.createDataFrame([("20250217-20250221",), ("20250224-20250228",)], "week string")
    assert [r["week"] for r in O.required_ranges(wanted, loaded).collect()] == ["20250224-20250228"]
    assert M.row_count_delta(wanted, loaded).first()["row_count_diff"] == -1


def test_rows_stand_as_the_files_are_listed(spark, tmp_path):
    """The first listed file is the smaller one; its rows still come first, and lines keep their order."""
    small, large = tmp_path / "small.csv", tmp_path / "large.csv"
    head = "timestamp,close\n"
    small.write_text(head + "2024-01-03 10:00:00-05:00,small\n")
    large.write_text(head + "".join(f"2024-01-03 10:{i:02d}:00-05:00,large{k}\n" for i in range(60) for k in (0, 1)))
    rows = RD.read_bar_text(spark, [str(small), str(large)], "x")
    merged = {r["ts"]: r["close"] for r in M.merge_existing_wins([rows.drop("file_path")], order="row_pos").collect()}
    values = [merged[t] for t in sorted(merged)]
    assert values == ["small", *["large0"] * 59]
    other = RD.read_bar_text(spark, [str(large), str(small)], "x")
    assert "small" not in {r["close"] for r in M.merge_existing_wins([other.drop("file_path")], order="row_pos").collect()}


def test_headers_are_found_without_opening_files_on_the_driver(spark, tmp_path, monkeypatch):
    """Three layouts over many files, one empty and one with a blank in its name; a path that is not there is skipped."""
    heads = ["timestamp,open,close", "close,timestamp,open,close", '"timestamp",extra']
    paths = []
    for i in range(60):
        file = tmp_path / f"part {i}.csv"
        cells = {0: f"2025-12-0{i % 9 + 1} 10:00:00-05:00,1.0,2.0", 1: f"3.0,2025-12-0{i % 9 + 1} 10:00:00-05:00,1.5,9.0", 2: f"2025-12-0{i % 9 + 1} 10:00:00-05:00,note"}[i % 3]
        file.write_text(heads[i % 3] + "\n" + cells + "\n")
        paths.append(str(file))
    (tmp_path / "empty.csv").write_text("")
    paths.insert(7, str(tmp_path / "empty.csv"))

    def opened(*args):
        raise AssertionError("a file was opened on the driver")

    monkeypatch.setattr(FS, "first_line", opened)
    monkeypatch.setattr(FS, "exists", opened)
    found = RD.layouts(spark, paths)
    assert {k: len(v) for k, v in found.items()} == {("timestamp", "open", "close"): 20, ("close", "timestamp", "open", "close.1"): 20, ("timestamp", "extra"): 20}
    assert [p for p in paths if p in set(found["timestamp", "open", "close"])] == found["timestamp", "open", "close"]
    rows = RD.read_bar_text(spark, paths, "x").orderBy("row_pos").collect()
    assert [r["timestamp"][:10] for r in rows] == [f"2025-12-0{i % 9 + 1}" for i in range(60)]
    assert {(r["open"], r["close"], r["extra"]) for r in rows} == {("1.0", "2.0", ""), ("1.5", "3.0", ""), ("", "", "note")}
    many = RD.read_many(spark, [*paths, str(tmp_path / "absent.csv"), "/no/such/folder/x.csv"], "csv")
    assert many.count() == 60
    plan = spark.read.text(paths[:2]).select("value", F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.min_by("value", F.length("value")), F.collect_set(F.lit(True)))
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_documents_of_any_size_and_the_bound_of_one_object(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "pairs"), [("a", "1"), ("b", '{"x": [1]}'), ("c", "text"), ("d", None)]
    pairs = spark.createDataFrame(rows, "key string, value string")
    assert SK.upsert_pairs(pairs, path) and not SK.upsert_pairs(pairs, path) and not SK.upsert_pairs(pairs, path, "N")
    later = spark.createDataFrame([("b", "2"), ("e", "new")], "key string, value string")
    assert SK.upsert_pairs(later, path, "A")
    stored = {r["key"]: r["value"] for r in spark.read.parquet(path).collect()}
    assert stored == {"a": "1", "b": "2", "c": '"text"', "d": "null", "e": '"new"'}
    assert SK.upsert_pairs(later, path, "W") and spark.read.parquet(path).count() == 2
    monkeypatch.setattr(SK, "DOCUMENT_KEYS", 3)
    with pytest.raises(ValueError, match="too many for one JSON object"):
        SK.upsert_document(pairs, str(tmp_path / "large.json"), "W")
    assert not FS.exists(spark, str(tmp_path / "large.json"))
    assert SK.upsert_document(later, str(tmp_path / "small.json"), "W")


@pytest.mark.parametrize("lost", [False, True])
def test_a_failed_week_swap_leaves_or_completes_the_weeks(spark, tmp_path, monkeypatch, lost):
    """An error in the swap brings the old weeks back; a swap whose driver is lost is completed by the next load."""
    path = str(tmp_path / "weeks")
    rows = lambda n: spark.range(n).selectExpr("timestamp_ntz'2024-01-02 10:00:00' + make_interval(0, 0, id % 3) AS ny_timestamp", "id")
    first = R.load_weeks(rows(27), path).collect()
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert len(first) == 3 and len(before) == 27
    real, calls = FS.move, []

    def broken(session, source, target):
        calls.append(source)
        if len(calls) == 4:
            raise KeyboardInterrupt if lost else OSError("no connection")
        real(session, source, target)

    monkeypatch.setattr(FS, "move", broken)
    with pytest.raises(KeyboardInterrupt if lost else OSError):
        R.load_weeks(rows(54), path)
    monkeypatch.undo()
    if not lost:
        spark.catalog.refreshByPath(path)
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
    actions = {r["action"] for r in R.load_weeks(rows(54), path).collect()}
    assert actions == ({"skip"} if lost else {"overwrite"}) and spark.read.parquet(path).count() == 54
    assert [e.name for e in FS.listing(spark, str(tmp_path))] == ["weeks"]
