"""Present, missing and planned dates over the orders table (symbol = order priority)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import periods as P, times as T
from candlewright.operators import coverage as V
from candlewright.queries import adapters as A

NOW = "2001-09-14 16:04:00"
PLAN_LAST = "2001-09-14"
PARTIAL_FIRST, PARTIAL_LAST = "1997-03-03", "1997-06-30"


def present_dates(spark, sf_dir):
    """Dates with an order inside a range, plus the dates that day files of shipped months name."""
    orders = A.order_dates(spark, sf_dir)
    shipped = A.table(spark, sf_dir, "lineitem").select(
        F.lit("5-LOW").alias("symbol"), F.date_format("l_shipdate", "yyyyMMdd").alias("period_str")
    )
    return V.present_dates(orders, PARTIAL_FIRST, PARTIAL_LAST, shipped)


def missing_sessions(spark, sf_dir):
    """Weekdays since the start without an order of the priority."""
    present = V.present_dates(A.order_dates(spark, sf_dir))
    return V.missing_sessions(A.order_series(spark, sf_dir), A.order_calendar(spark), present, F.lit(A.ORDER_LAST).cast("date"))


def missing_summary(spark, sf_dir):
    present = V.present_dates(A.order_dates(spark, sf_dir))
    return V.missing_summary(A.order_series(spark, sf_dir), A.order_calendar(spark), present, F.lit(A.ORDER_LAST).cast("date"))


def load_plan(spark, sf_dir):
    """Default plan: closed sessions after the last present date, up to now."""
    present = V.present_dates(A.order_dates(spark, sf_dir))
    calendar = A.order_calendar(spark, PLAN_LAST)
    return V.load_plan(A.order_series(spark, sf_dir), calendar, present, T.instant_literal(NOW))


def load_plan_from_start(spark, sf_dir):
    """Every gap since the start, with the fixed-hour rule for today's session."""
    present = V.present_dates(A.order_dates(spark, sf_dir))
    calendar = A.order_calendar(spark, PLAN_LAST)
    return V.load_plan(A.order_series(spark, sf_dir), calendar, present, T.instant_literal(NOW), from_start=True, finished_rule=True)


def load_plan_range(spark, sf_dir):
    """An explicit range, asked again although present."""
    present = V.present_dates(A.order_dates(spark, sf_dir))
    calendar = A.order_calendar(spark, PLAN_LAST)
    return V.load_plan(
        A.order_series(spark, sf_dir), calendar, present, T.instant_literal(NOW), first="1994-12-01", last="1995-03-31", reload=True, clamp_to_start=True
    )


def year_chunks(spark, sf_dir):
    """Yearly requests over the missing sessions."""
    plan = load_plan_from_start(spark, sf_dir)
    chunks = V.year_chunks(plan, A.order_calendar(spark, PLAN_LAST), T.instant_literal(NOW))
    return chunks.select(
        "symbol", "label", "wanted_count", "first_date", "last_date", "session_count",
        F.array_join(F.transform("wanted_dates", lambda d: d.cast("string")), " ").alias("wanted"),
        F.size("session_dates").cast("bigint").alias("listed_sessions"), "end_str",
    )


def coverage_status(spark, sf_dir):
    """Symbol x bar kind x place over events: hourly and daily bars, raw before 20 January, then staging."""
    events = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
    place = F.when(F.col("date") < F.lit("2024-01-20").cast("date"), F.lit("raw")).otherwise(F.lit("staging"))
    minute = events.withColumn("bar_kind", F.lit("1min")).withColumn("place", place)
    daily = events.where(F.col("date") < F.lit("2024-01-20").cast("date")).distinct().withColumn("bar_kind", F.lit("daily")).withColumn("place", place)
    grid = V.coverage_grid(events.select("symbol").distinct(), ["1min", "daily"], ["raw", "staging", "staging/merged"])
    summary = V.place_summary(minute.unionByName(daily), ["symbol", "bar_kind", "place"])
    return V.coverage_status(grid, summary)


def date_rows(spark, sf_dir):
    """Rows of every session date, with the period whose file covers the date."""
    rows = A.order_dates(spark, sf_dir)
    period = P.period_for_date(F.col("date"), F.lit("2001-09-14").cast("date"))
    return rows.groupBy("symbol", "date", period.alias("period_str")).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


GAPS = f"""WITH {A.SQL_ORDER_DAYS}, {A.sql_weekdays(A.ORDER_LAST)},
marked AS (SELECT s.symbol, c.date, d.date IS NULL AS gap FROM (SELECT DISTINCT symbol FROM days) s CROSS JOIN cal c
  LEFT JOIN days d ON d.symbol = s.symbol AND d.date = c.date)"""
PLAN = f"""WITH {A.SQL_ORDER_DAYS}, {A.sql_weekdays('2001-09-13')},
plan AS (SELECT s.symbol, c.date FROM (SELECT DISTINCT symbol FROM days) s CROSS JOIN cal c
  WHERE NOT EXISTS (SELECT 1 FROM days d WHERE d.symbol = s.symbol AND d.date = c.date))"""

REPORTS = {
    "present_dates": (
        present_dates,
        f"""SELECT DISTINCT symbol, date FROM (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders
  UNION ALL SELECT '5-LOW', CAST(l_shipdate AS DATE) FROM lineitem) WHERE date BETWEEN DATE '{PARTIAL_FIRST}' AND DATE '{PARTIAL_LAST}'""",
    ),
    "missing_sessions": (missing_sessions, GAPS + " SELECT symbol, date FROM marked WHERE gap"),
    "missing_summary": (
        missing_summary,
        GAPS
        + """, l AS (SELECT symbol, count(*) AS expected_count, count(*) FILTER (gap) AS missing_count,
  COALESCE(list(CAST(date AS VARCHAR) ORDER BY date) FILTER (gap), []) AS g FROM marked GROUP BY 1)
SELECT symbol, expected_count, missing_count, COALESCE(array_to_string(g[1:3], ' '), '') AS first_missing,
  COALESCE(array_to_string(g[greatest(len(g) - 2, 1):len(g)], ' '), '') AS last_missing FROM l""",
    ),
    "load_plan": (
        load_plan,
        f"""WITH {A.SQL_ORDER_DAYS}, {A.sql_weekdays('2001-09-13')}, newest AS (SELECT symbol, max(date) AS d FROM days GROUP BY 1)
SELECT symbol, c.date FROM newest n JOIN cal c ON c.date > n.d""",
    ),
    "load_plan_from_start": (load_plan_from_start, PLAN + " SELECT symbol, date FROM plan"),
    "load_plan_range": (
        load_plan_range,
        f"""WITH {A.SQL_ORDER_DAYS}, {A.sql_weekdays('1995-03-31')} SELECT s.symbol, c.date FROM (SELECT DISTINCT symbol FROM days) s CROSS JOIN cal c""",
    ),
    "year_chunks": (
        year_chunks,
        PLAN
        + f""", {A.sql_weekdays(PLAN_LAST, name='every')},
chunks AS (SELECT symbol, strftime(date, '%Y') AS label, count(*) AS wanted_count, min(date) AS first_date, max(date) AS last_date,
  array_to_string(list(CAST(date AS VARCHAR) ORDER BY date), ' ') AS wanted FROM plan GROUP BY 1, 2),
ends AS (SELECT c.*, (SELECT count(*) FROM every e WHERE e.date BETWEEN first_date AND last_date) AS session_count,
  timezone('UTC', timezone('America/New_York', CAST(last_date + 3 AS TIMESTAMP))) AS e FROM chunks c)
SELECT symbol, label, wanted_count, first_date, last_date, session_count, wanted, session_count AS listed_sessions,
  CASE WHEN last_date + 3 < TIMESTAMP '{NOW}' THEN strftime(e, '%Y%m%d-%H:%M:%S') ELSE '' END AS end_str FROM ends""",
    ),
    "coverage_status": (
        coverage_status,
        """WITH e AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date FROM events),
bars AS (SELECT symbol, date, '1min' AS bar_kind, CASE WHEN date < DATE '2024-01-20' THEN 'raw' ELSE 'staging' END AS place FROM e
  UNION ALL SELECT DISTINCT symbol, date, 'daily', 'raw' FROM e WHERE date < DATE '2024-01-20'),
grid AS (SELECT * FROM (SELECT DISTINCT symbol FROM e) CROSS JOIN (VALUES ('1min'), ('daily')) k(bar_kind) CROSS JOIN (VALUES ('raw'), ('staging'), ('staging/merged')) p(place)),
s AS (SELECT symbol, bar_kind, place, count(*) AS n, count(DISTINCT date) AS d, min(date) AS lo, max(date) AS hi FROM bars GROUP BY ALL)
SELECT g.symbol, g.bar_kind, g.place, COALESCE(n, 0) AS row_count_int, COALESCE(d, 0) AS date_count_int, COALESCE(CAST(lo AS VARCHAR), '') AS first_date_str,
  COALESCE(CAST(hi AS VARCHAR), '') AS last_date_str, n IS NOT NULL AS exists_bool
FROM grid g LEFT JOIN s ON s.symbol = g.symbol AND s.bar_kind = g.bar_kind AND s.place = g.place""",
    ),
    "date_rows": (
        date_rows,
        """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
  CASE WHEN year(o_orderdate) < 2001 THEN strftime(o_orderdate, '%Y') WHEN month(o_orderdate) < 9 THEN strftime(o_orderdate, '%Y%m')
    ELSE strftime(o_orderdate, '%Y%m%d') END AS period_str, count(*) AS row_count, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3""",
    ),
}
