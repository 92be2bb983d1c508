"""Jobs applied for real that take staged, left-over or late data in: index gate, daily merge, orphans, stage, back-fill."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from candlewright import schema as S
from candlewright.functions import periods as P, times as T
from candlewright.plans import staging as G, zone as Z
from candlewright.queries import adapters as A, jobs_q, merge_q
from candlewright.session import run_folder
from candlewright.sources import files, readers, sinks


def index_apply(spark, sf_dir):
    """Staged hourly sessions under the index rule: what raw holds once the accepted days have moved in."""
    raw, staging = run_folder(spark, "index-raw"), run_folder(spark, "index-staging")
    bars = jobs_q.as_text(merge_q.staged(spark, sf_dir)).withColumn("period", F.regexp_replace("date", "-", ""))
    Z.write_zone(bars, staging)
    Z.write_zone(bars.where(F.col("date") <= "2024-01-08"), raw)
    G.merge_minutes(spark, staging, raw, None, True, True, index_rule=True, step_seconds=A.HOUR)
    rows = Z.read_zone(spark, raw)
    return rows.groupBy("symbol", P.first_date(F.col("period")).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


def _daily(spark, sf_dir):
    """Daily bars of order totals by priority; one series has broken candles in one year."""
    days = A.order_dates(spark, sf_dir).groupBy("symbol", "date").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
    )
    broken = (F.col("symbol") == "1-URGENT") & (F.year("date") == 1997)
    days = days.withColumn("high", F.when(broken, F.col("low") - 1).otherwise(F.col("high"))).withColumn("ts", T.from_wall(F.col("date").cast("timestamp")))
    return jobs_q.as_text(days).withColumn("period", F.substring("date", 1, 4))


def daily_apply(spark, sf_dir):
    """Staged years of daily bars merged into raw years that hold the odd days: whose rows stand there afterwards."""
    raw, staging = run_folder(spark, "daily-raw"), run_folder(spark, "daily-staging")
    days = _daily(spark, sf_dir)
    odd = F.substring("date", 10, 1).cast("int") % 2 == 1
    Z.write_zone(days.where(odd).withColumn("created_ts", F.lit("raw")), raw)
    Z.write_zone(days.withColumn("created_ts", F.lit("staged")), staging)
    G.merge_daily(spark, staging, raw, True)
    return Z.read_zone(spark, raw).groupBy("symbol", "period", F.col("created_ts").alias("won_by")).agg(F.count(F.lit(1)).alias("row_count"))


def orphans_apply(spark, sf_dir):
    """Day periods beside the month that already exists for them: folded in, rows of the month win."""
    zone = run_folder(spark, "orphans")
    odd = F.pmod("event_id", F.lit(2))
    rows = jobs_q.as_text(A.event_bars(spark, sf_dir, step=60), odd.cast("string"), "event_id")
    period = F.when(F.col("created_ts") == "0", F.lit("202401")).otherwise(F.regexp_replace("date", "-", ""))
    Z.write_zone(rows.withColumn("period", period).withColumn("row_pos", F.col("event_id")).drop("event_id"), zone)
    Z.clean_orphans(spark, zone, True)
    return Z.read_zone(spark, zone).groupBy("period", "symbol", F.col("created_ts").alias("won_by")).agg(F.count(F.lit(1)).alias("row_count"))


def stage_save(spark, sf_dir):
    """Sessions loaded twice into staging: a later load replaces the day of its own series."""
    staging = run_folder(spark, "stage")
    bars = A.event_bars(spark, sf_dir, step=60)
    Z.save_stage(spark, jobs_q.as_text(bars, F.lit("first")), staging, daily=False)
    again = bars.where((F.col("date") >= "2024-01-16") & (F.pmod("event_id", F.lit(3)) == 0))
    Z.save_stage(spark, jobs_q.as_text(again, F.lit("second")), staging, daily=False)
    rows = Z.read_zone(spark, staging)
    return rows.groupBy("symbol", "date", F.col("created_ts").alias("loaded")).agg(F.count(F.lit(1)).alias("row_count"))


def period_files(spark, sf_dir):
    """A folder with one text file for each day and other files between them: its catalog."""
    written, folder = run_folder(spark, "period-files-written"), run_folder(spark, "period-files")
    rows = jobs_q.as_text(A.event_bars(spark, sf_dir, step=60)).drop("symbol", "ts")
    period = F.regexp_replace("date", "-", "")
    rows.withColumn("period", period).repartition(8, "period").write.partitionBy("period").option("header", True).csv(written)
    for day in Z.periods(spark, written):
        part = next(e for e in files.listing(spark, f"{written}/period={day}") if files.has_extension(e.path, "csv"))
        files.move(spark, part.path, f"{folder}/ohlcv_data_{day}.csv")
    files.write_line(spark, f"{folder}/ohlcv_data_2024x.csv", "no period")
    files.write_line(spark, f"{folder}/merged/ohlcv_data_20231229.csv", "not of this folder")
    found = files.period_catalog(spark, folder)
    return found.select("file_name_str", "period_str", "period_kind_str", "first_date", "last_date")


def document_pairs(spark, sf_dir):
    """Every order as a key of one document that grows with the table, merged with a second one for the even orders."""
    path = run_folder(spark, "document-pairs")
    orders = A.table(spark, sf_dir, "orders").withColumn("key", F.col("o_orderkey").cast("string"))
    sinks.upsert_pairs(orders.select("key", F.to_json(F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"))).alias("value")), path)
    sinks.upsert_pairs(orders.where("o_orderkey % 2 = 0").select("key", F.col("o_orderpriority").alias("value")), path, "A")
    return spark.read.parquet(path)


def sink_modes(spark, sf_dir):
    """The events through every sink and access mode, read back: rows by type in each."""
    root = run_folder(spark, "sinks")
    rows = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "value")
    high = rows.where("value > 250")
    sinks.write_table(rows, f"{root}/table", "parquet", "W", all_text=True)
    sinks.write_table(high, f"{root}/table", "parquet", "I", all_text=True)  # kept as it is
    sinks.write_table(high, f"{root}/table", "parquet", "A", all_text=True)
    sinks.write_table(rows, f"{root}/csv", "csv", "I")
    sinks.write_table(high, f"{root}/csv", "csv", "W")
    sinks.write_table(rows, f"{root}/none", "parquet", "N")
    for _ in range(2):
        sinks.append_log(rows.select(F.col("symbol").alias("status_str"), F.col("value").alias("bar_count_int")), f"{root}/log", S.MERGE_LOG_COLUMNS)
    for part in (rows, high):
        sinks.write_report(part, f"{root}/report")
    log = spark.read.parquet(f"{root}/log").select(F.col("status_str").alias("symbol"), F.col("bar_count_int").alias("value"))
    found = {
        "table": spark.read.parquet(f"{root}/table"), "csv": spark.read.option("header", True).csv(f"{root}/csv"), "log": log,
        "report": spark.read.option("header", True).csv(f"{root}/report"),
    }
    parts = [f.select(F.lit(name).alias("sink"), "symbol", "value") for name, f in found.items()]
    united = reduce(DataFrame.unionByName, parts)
    none = F.lit(files.exists(spark, f"{root}/none")).alias("none_exists")
    return united.groupBy("sink", "symbol").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("value_sum")).select("*", none)


def zone_text(spark, sf_dir):
    """The events as text files of the typed zone, read back with both clocks between two instants: rows and range by day."""
    path = run_folder(spark, "zone-text")
    second = F.date_trunc("second", "ts")
    price = [F.col("value").alias(c) for c in ("open", "high", "low", "close")]
    clock = lambda column, name: F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)
    rows = A.table(spark, sf_dir, "events").select(
        clock(second + F.expr("INTERVAL 8 HOURS"), "qatar_timestamp"), clock(second, "ny_timestamp"), *price,
        F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("n/a")).otherwise(F.lit("12")).alias("volume"), F.lit("0.0").alias("stock_splits"),
    )
    rows.write.option("header", True).csv(path)
    found = readers.read_zone(spark, [path], datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 20, 12, tzinfo=timezone.utc), work=True, ordered=True)
    return found.groupBy(F.to_date("ny_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("volume").cast("bigint").alias("volume_sum"), F.count_if(F.col("volume").isNull()).alias("no_number"),
        F.date_format(F.max("qatar_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("last_qatar"),
    )


REPORTS = {
    "zone_text": (
        zone_text,
        """WITH r AS (SELECT date_trunc('second', ts) AS t, event_id FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00')
SELECT CAST(t AS DATE) AS date, count(*) AS row_count, CAST(sum(CASE WHEN event_id % 5 <> 0 THEN 12 END) AS BIGINT) AS volume_sum,
  count(*) FILTER (event_id % 5 = 0) AS no_number, strftime(max(t) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS last_qatar FROM r GROUP BY 1""",
    ),
    "sink_modes": (
        sink_modes,
        """WITH r AS (SELECT event_type AS symbol, CAST(value AS DECIMAL(12, 2)) AS value FROM events),
s AS (SELECT 'table' AS sink, * FROM r UNION ALL SELECT 'table', * FROM r WHERE value > 250 UNION ALL SELECT 'csv', * FROM r WHERE value > 250
  UNION ALL SELECT 'log', * FROM r UNION ALL SELECT 'log', * FROM r UNION ALL SELECT 'report', * FROM r WHERE value > 250)
SELECT sink, symbol, count(*) AS row_count, CAST(sum(value) AS DOUBLE) AS value_sum, FALSE AS none_exists FROM s GROUP BY 1, 2""",
    ),
    "document_pairs": (
        document_pairs,
        """SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderpriority || '"'
  ELSE '{"customer":' || o_custkey || ',"status":"' || o_orderstatus || '"}' END AS value FROM orders""",
    ),
    "index_apply": (
        index_apply,
        f"""WITH {merge_q.STAGED}, day AS (SELECT symbol, date, count(*) AS row_count, count(*) FILTER ({merge_q.BROKEN}) AS broken FROM staged GROUP BY 1, 2)
SELECT symbol, date, row_count FROM day WHERE date <= DATE '2024-01-08' OR broken = 0""",
    ),
    "daily_apply": (
        daily_apply,
        """WITH days AS (SELECT DISTINCT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT symbol, strftime(date, '%Y') AS period, CASE WHEN day(date) % 2 = 1 THEN 'raw' ELSE 'staged' END AS won_by, count(*) AS row_count
FROM days WHERE day(date) % 2 = 1 OR NOT (symbol = '1-URGENT' AND year(date) = 1997) GROUP BY 1, 2, 3""",
    ),
    "orphans_apply": (
        orphans_apply,
        f"""WITH {jobs_q.MINUTES}, k AS (SELECT symbol, ts, min(event_id % 2) AS won FROM bars GROUP BY 1, 2)
SELECT '202401' AS period, symbol, CAST(won AS VARCHAR) AS won_by, count(*) AS row_count FROM k GROUP BY 1, 2, 3""",
    ),
    "stage_save": (
        stage_save,
        f"""WITH {jobs_q.MINUTES}, days AS (SELECT symbol, strftime(ts, '%Y-%m-%d') AS date, count(DISTINCT ts) AS first_load,
  count(DISTINCT ts) FILTER (ts >= TIMESTAMP '2024-01-16' AND event_id % 3 = 0) AS second_load FROM bars GROUP BY 1, 2)
SELECT symbol, date, CASE WHEN second_load > 0 THEN 'second' ELSE 'first' END AS loaded, CASE WHEN second_load > 0 THEN second_load ELSE first_load END AS row_count FROM days""",
    ),
    "period_files": (
        period_files,
        """SELECT DISTINCT 'ohlcv_data_' || strftime(ts, '%Y%m%d') || '.csv' AS file_name_str, strftime(ts, '%Y%m%d') AS period_str, 'day' AS period_kind_str,
  CAST(ts AS DATE) AS first_date, CAST(ts AS DATE) AS last_date FROM events""",
    ),
}
