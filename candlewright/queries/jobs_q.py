"""Table-changing jobs applied for real: zones of the events table under the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import periods as P, times as T
from candlewright.operators import calendar as C
from candlewright.plans import reports as R, staging as G, zone as Z
from candlewright.queries import adapters as A, checks_q, merge_q
from candlewright.session import run_folder
from candlewright.sources import files, readers, sinks

NOW = "2024-02-06 12:00:00"


def as_text(bars, created=None, *carry):
    """Typed bars as text cells of a zone."""
    cells = [F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")]
    created = F.lit("") if created is None else created
    return bars.select(
        "symbol", "ts", T.offset_text(F.col("ts")).alias("timestamp"), *cells, F.lit("").alias("volume"), created.alias("created_ts"),
        F.date_format(T.wall_date(F.col("ts")), "yyyy-MM-dd").alias("date"), *carry,
    )


def _minutes(spark, sf_dir):
    return as_text(A.event_bars(spark, sf_dir, step=60))


def organize_apply(spark, sf_dir):
    """Day periods of minute bars, duplicates included, rolled up into months: rows per period afterwards."""
    zone = run_folder(spark, "organize")
    rows = _minutes(spark, sf_dir)
    Z.write_zone(rows.withColumn("period", F.date_format(T.wall_date(F.col("ts")), "yyyyMMdd")), zone)
    done = Z.organize(spark, zone, T.instant_literal(NOW), True)
    left = Z.read_zone(spark, zone).groupBy("period").agg(F.count(F.lit(1)).alias("row_count"))
    return left.join(done.withColumnRenamed("target_str", "period"), "period").select(
        "period", "row_count", "input_row_count", "output_row_count", "duplicate_row_count", "conflict_minute_count", "status_str"
    )


def rebuild_apply(spark, sf_dir):
    """A zone with a year, its months and left-over days rebuilt elsewhere: the longest period's rows win."""
    source, target = run_folder(spark, "rebuild-source"), run_folder(spark, "rebuild-target")
    rows = _minutes(spark, sf_dir).withColumn("seen", F.col("close").cast("double"))
    day = T.wall_date(F.col("ts"))
    parts = None
    for index, pattern in enumerate(("yyyy", "yyyyMM", "yyyyMMdd")):
        part = rows.where(F.pmod(F.floor(F.col("seen") * 100).cast("bigint"), F.lit(3)) == index).drop("seen")
        part = part.withColumn("period", F.date_format(day, pattern)).withColumn("created_ts", F.lit(str(index)))
        parts = part if parts is None else parts.unionByName(part)
    Z.write_zone(parts, source)
    Z.rebuild(spark, source, target, T.instant_literal(NOW), True)
    return Z.read_zone(spark, target).groupBy("period", "symbol", F.col("created_ts").alias("won_by")).agg(F.count(F.lit(1)).alias("row_count"))


def _staged(spark, sf_dir):
    raw, staging = run_folder(spark, "raw"), run_folder(spark, "staging")
    bars = as_text(merge_q.staged(spark, sf_dir))
    dated = bars.withColumn("period", F.regexp_replace("date", "-", ""))
    Z.write_zone(dated, staging)
    Z.write_zone(dated.where(F.col("date") <= "2024-01-08"), raw)
    closed = C.closed_sessions(A.calendar(spark, hourly=True), T.instant_literal("2024-01-30 15:00:00"), step_seconds=A.HOUR)
    return raw, staging, closed


def staging_apply(spark, sf_dir):
    """Hourly days staged, gated and appended to a raw zone that already holds the first days."""
    raw, staging, closed = _staged(spark, sf_dir)
    G.merge_minutes(spark, staging, raw, closed, True, True, step_seconds=A.HOUR)
    rows = Z.read_zone(spark, raw)
    return rows.groupBy("symbol", P.first_date(F.col("period")).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


def weeks_apply(spark, sf_dir):
    """Monday-Friday weeks written behind the snapshot guard, then offered again with more rows."""
    path = run_folder(spark, "weeks")
    rows = A.table(spark, sf_dir, "events").select(F.col("ts").alias("ny_timestamp"), "event_type", "value")
    R.load_weeks(rows.where(F.col("ny_timestamp") < F.lit("2024-01-18").cast("timestamp_ntz")), path)
    plan = R.load_weeks(rows, path)
    stored = spark.read.parquet(path).select(F.col("week").cast("string").alias("week")).groupBy("week").agg(F.count(F.lit(1)).alias("row_count"))
    return plan.join(stored, "week").select("week", "row_count", "old_rows", "new_rows", "action")


def zone_issues(spark, sf_dir):
    """Issue report over a stored zone from a start date, read back from its partitions."""
    zone = run_folder(spark, "issues")
    Z.ingest(_minutes(spark, sf_dir), zone, T.instant_literal(A.NOW))
    return R.zone_issues(spark, [zone], A.calendar(spark), A.now(), A.LAST_DAY, "2024-01-10")


def zone_issues_stalled(spark, sf_dir):
    """Two series stop on the fifth: their periods lie before the start date, and they are still expected."""
    zone = run_folder(spark, "issues-stalled")
    rows = _minutes(spark, sf_dir).where(~F.col("symbol").isin(STALLED) | (F.col("date") <= "2024-01-05"))
    Z.write_zone(rows.withColumn("period", F.regexp_replace("date", "-", "")), zone)
    return R.zone_issues(spark, [zone], A.calendar(spark), A.now(), A.LAST_DAY, "2024-01-10")


def _ordered_minutes(spark, sf_dir):
    """Minute bars whose place is the event number, in two loads: the larger one came later."""
    rows = as_text(A.event_bars(spark, sf_dir, step=60), F.col("event_id").cast("string"), "event_id", F.col("event_id").alias("row_pos"))
    return rows.withColumn("load_seq", F.when(F.pmod("event_id", F.lit(4)) == 0, 1).otherwise(2).cast("bigint"))


def _winners(spark, zone):
    """Which event every minute kept."""
    rows = Z.read_zone(spark, zone)
    return rows.select("period", "symbol", A.text("ts").alias("minute"), F.col("created_ts").cast("bigint").alias("won_by"))


def organize_rows(spark, sf_dir):
    """The rows that win when days roll up: of repeated minutes the first of the earlier load, in several part files per day."""
    zone = run_folder(spark, "organize-rows")
    rows = _ordered_minutes(spark, sf_dir).withColumn("period", F.regexp_replace("date", "-", "")).drop("event_id")
    Z.write_zone(rows.where("load_seq = 2"), zone)
    Z.write_zone(rows.where("load_seq = 1"), zone)
    Z.organize(spark, zone, T.instant_literal(NOW), True)
    return _winners(spark, zone)


def rebuild_rows(spark, sf_dir):
    """The rows that win a rebuild: those of the longest period, and inside a period the first of the earlier load."""
    source, target = run_folder(spark, "rows-source"), run_folder(spark, "rows-target")
    pattern = F.element_at(F.array(F.lit("yyyy"), F.lit("yyyyMM"), F.lit("yyyyMMdd")), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    day = T.wall_date(F.col("ts"))
    period = F.when(pattern == "yyyy", F.date_format(day, "yyyy")).when(pattern == "yyyyMM", F.date_format(day, "yyyyMM")).otherwise(F.date_format(day, "yyyyMMdd"))
    rows = _ordered_minutes(spark, sf_dir).withColumn("period", period).drop("event_id")
    Z.write_zone(rows.where("load_seq = 2"), source)
    Z.write_zone(rows.where("load_seq = 1"), source)
    Z.rebuild(spark, source, target, T.instant_literal(NOW), True)
    return _winners(spark, target)


def staging_left(spark, sf_dir):
    """What a merge leaves in staging: the days that were not added, row by row."""
    raw, staging, closed = _staged(spark, sf_dir)
    G.merge_minutes(spark, staging, raw, closed, True, True, step_seconds=A.HOUR)
    rows = Z.read_zone(spark, staging)
    return rows.groupBy("symbol", P.first_date(F.col("period")).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


def date_rows_stored(spark, sf_dir):
    """Rows of one date, from a zone that holds years, months and days."""
    zone = run_folder(spark, "date-rows")
    Z.ingest(_minutes(spark, sf_dir), zone, T.instant_literal(A.NOW))
    found = Z.date_rows(spark, [zone], "2024-01-10")
    return found.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("ts").alias("minute_count"))


def document_upsert(spark, sf_dir):
    """Nations by name as a JSON document, merged with a second one and read back."""
    path = f"{run_folder(spark, 'document')}/nations.json"
    nations = A.table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.col("n_nationkey").cast("string").alias("value"), "n_regionkey")
    sinks.upsert_document(nations.select("key", "value"), path, "A")
    even = F.concat(F.lit("region "), F.col("n_regionkey").cast("string"))
    sinks.upsert_document(nations.where("n_regionkey % 2 = 0").select("key", even.alias("value")), path, "A")
    return readers.read_document(spark, path)


def text_layouts(spark, sf_dir):
    """Bars as CSV files in two layouts, read back as one table: rows and cells by layout."""
    folder = run_folder(spark, "layouts")
    rows = _minutes(spark, sf_dir).drop("symbol", "ts")
    odd = F.substring("timestamp", 16, 1).isin("1", "3", "5", "7", "9")
    rows.where(odd).coalesce(1).write.option("header", True).csv(f"{folder}/a")
    rows.where(~odd).withColumn("extra", F.lit("x")).select("extra", *reversed(rows.columns)).coalesce(2).write.option("header", True).csv(f"{folder}/b")
    paths = [e.path for part in "ab" for e in files.listing(spark, f"{folder}/{part}") if files.has_extension(e.path, "csv")]
    found = readers.read_bar_text(spark, paths, "all")
    return found.groupBy("date", F.col("extra").alias("layout")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("ts").alias("minute_count"), F.sum(F.col("close").cast("decimal(12,2)")).cast("double").alias("close_sum")
    )


def text_layouts_many(spark, sf_dir):
    """One text file for each day in each of three layouts, read back as one table: rows and cells by day and layout."""
    folder = run_folder(spark, "layouts-many")
    rows = _minutes(spark, sf_dir).drop("symbol", "ts").withColumn("day", F.regexp_replace("date", "-", ""))
    third = F.substring("timestamp", 15, 2).cast("int") % 3
    tail = [c for c in rows.columns if c not in ("timestamp", "day")]
    for k, cells in enumerate((["timestamp", *tail], ["note", *reversed(tail), "timestamp"], ["timestamp", *tail, "close_again"])):
        part = rows.where(third == k).withColumn("note", F.lit("second")).withColumn("close_again", F.lit("third"))
        part.select("day", *cells).repartition(4, "day").write.partitionBy("day").option("header", True).csv(f"{folder}/{k}")
    days = [d.path for k in range(3) for d in files.listing(spark, f"{folder}/{k}") if d.is_folder]
    paths = [e.path for d in days for e in files.listing(spark, d) if files.has_extension(e.path, "csv")]
    found = readers.read_bar_text(spark, paths, "all")
    layout = F.when(F.col("note") != "", F.col("note")).when(F.col("close_again") != "", F.col("close_again")).otherwise(F.lit("first"))
    return found.groupBy("date", layout.alias("layout")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("row_pos").alias("place_count"), F.sum(F.col("close").cast("decimal(12,2)")).cast("double").alias("close_sum")
    )


STALLED = ["click", "view"]

MINUTES = "bars AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, value, event_id FROM events)"

ZONE_ISSUES = f"""WITH bars AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-10'),
starts AS (SELECT DISTINCT event_type AS symbol, DATE '2024-01-10' AS start FROM events),
all_{A.SQL_MINUTE_CALENDAR.replace('cal AS', 'days AS')},
cal AS (SELECT * FROM all_days WHERE last_ts + INTERVAL 6 MINUTE <= TIMESTAMP '{A.NOW}'),
{checks_q.ISSUE_CTES.format(step="INTERVAL 1 MINUTE")} SELECT * FROM issues"""

REPORTS = {
    "organize_apply": (
        organize_apply,
        f"""WITH {MINUTES}, k AS (SELECT symbol, ts, count(*) AS n, count(DISTINCT value) AS d FROM bars GROUP BY 1, 2)
SELECT strftime(ts, '%Y%m') AS period, count(*) AS row_count, CAST(sum(n) AS BIGINT) AS input_row_count, count(*) AS output_row_count,
  CAST(sum(n) AS BIGINT) - count(*) AS duplicate_row_count, count(*) FILTER (d > 1) AS conflict_minute_count, 'merged' AS status_str FROM k GROUP BY 1""",
    ),
    "rebuild_apply": (
        rebuild_apply,
        f"""WITH {MINUTES}, k AS (SELECT symbol, ts, min(CAST(floor(value * 100) AS BIGINT) % 3) AS won FROM bars GROUP BY 1, 2)
SELECT strftime(ts, '%Y%m') AS period, symbol, CAST(won AS VARCHAR) AS won_by, count(*) AS row_count FROM k GROUP BY 1, 2, 3""",
    ),
    "staging_apply": (
        staging_apply,
        f"""{merge_q.GATE}, added AS (SELECT symbol, date FROM gate WHERE in_raw_bool OR decision_str = 'add' OR decision_str LIKE 'skip: partial%')
SELECT s.symbol, s.date, count(*) AS row_count FROM staged s JOIN added a ON a.symbol = s.symbol AND a.date = s.date GROUP BY 1, 2""",
    ),
    "weeks_apply": (
        weeks_apply,
        """WITH r AS (SELECT ts, date_trunc('week', ts) AS w FROM events WHERE ts BETWEEN date_trunc('week', ts) + INTERVAL 570 MINUTE AND date_trunc('week', ts) + INTERVAL 4 DAY + INTERVAL 959 MINUTE),
n AS (SELECT w, count(*) AS n, count(*) FILTER (ts < TIMESTAMP '2024-01-18') AS o FROM r GROUP BY 1)
SELECT strftime(w, '%Y%m%d') || '-' || strftime(w + INTERVAL 4 DAY, '%Y%m%d') AS week, n AS row_count, o AS old_rows, n AS new_rows,
  CASE WHEN o = 0 THEN 'write' WHEN o = n THEN 'skip' ELSE 'overwrite' END AS action FROM n""",
    ),
    "zone_issues": (zone_issues, ZONE_ISSUES),
    "zone_issues_stalled": (
        zone_issues_stalled,
        ZONE_ISSUES.replace("WHERE ts >= TIMESTAMP '2024-01-10'", "WHERE ts >= TIMESTAMP '2024-01-10' AND event_type NOT IN ('click', 'view')"),
    ),
    "organize_rows": (
        organize_rows,
        f"""WITH {MINUTES} SELECT strftime(ts, '%Y%m') AS period, symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, event_id AS won_by FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id % 4 <> 0, event_id) = 1""",
    ),
    "rebuild_rows": (
        rebuild_rows,
        f"""WITH {MINUTES} SELECT strftime(ts, '%Y%m') AS period, symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, event_id AS won_by FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id % 3, event_id % 4 <> 0, event_id) = 1""",
    ),
    "staging_left": (
        staging_left,
        f"""{merge_q.GATE}, added AS (SELECT symbol, date FROM gate WHERE NOT in_raw_bool AND (decision_str = 'add' OR decision_str LIKE 'skip: partial%'))
SELECT s.symbol, s.date, count(*) AS row_count FROM staged s ANTI JOIN added a ON a.symbol = s.symbol AND a.date = s.date GROUP BY 1, 2""",
    ),
    "date_rows_stored": (
        date_rows_stored,
        f"""WITH {MINUTES} SELECT symbol, '2024-01-10' AS date, count(*) AS row_count, count(DISTINCT ts) AS minute_count FROM bars
WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY 1""",
    ),
    "document_upsert": (
        document_upsert,
        "SELECT n_name AS key, CASE WHEN n_regionkey % 2 = 0 THEN 'region ' || n_regionkey ELSE CAST(n_nationkey AS VARCHAR) END AS value FROM nation",
    ),
    "text_layouts": (
        text_layouts,
        f"""WITH {MINUTES} SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN minute(ts) % 2 = 0 THEN 'x' ELSE '' END AS layout, count(*) AS row_count,
  count(DISTINCT ts) AS minute_count, CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS close_sum FROM bars GROUP BY 1, 2""",
    ),
    "text_layouts_many": (
        text_layouts_many,
        f"""WITH {MINUTES} SELECT strftime(ts, '%Y-%m-%d') AS date, CASE minute(ts) % 3 WHEN 0 THEN 'first' WHEN 1 THEN 'second' ELSE 'third' END AS layout,
  count(*) AS row_count, count(*) AS place_count, CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS close_sum FROM bars GROUP BY 1, 2""",
    ),
}
