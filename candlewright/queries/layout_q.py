"""Period layout reports over names made from order dates: years before 1999, months of 1999-2000, days after."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import times as T
from candlewright.operators import layout as Y, merge as M
from candlewright.queries import adapters as A

NOW = "2001-06-15 12:00:00"


def _periods(spark, sf_dir):
    """Every priority's files: a mixed, half-organised layout."""
    orders = A.order_dates(spark, sf_dir)
    date = F.col("date")
    period = (
        F.when(F.year(date) < 1999, F.date_format(date, "yyyy"))
        .when(F.year(date) < 2001, F.date_format(date, "yyyyMM"))
        .otherwise(F.date_format(date, "yyyyMMdd"))
    )
    # Days of the last week of a month were rolled up only for some priorities, so orphans exist.
    left_over = orders.where((F.dayofmonth(date) == 1) & (F.col("symbol") < "3"))
    named = orders.select("symbol", period.alias("period_str")).unionByName(
        left_over.select("symbol", F.date_format("date", "yyyyMMdd").alias("period_str"))
    )
    return Y.catalog_of(named.distinct())


def period_catalog(spark, sf_dir):
    return _periods(spark, sf_dir)


def period_overlap(spark, sf_dir):
    """Files that meet the order span of each customer-year quarter of the priority."""
    orders = A.order_dates(spark, sf_dir)
    ranges = orders.groupBy("symbol", F.date_format(F.date_trunc("quarter", "date"), "yyyyMM").alias("range_id")).agg(
        F.min("date").alias("low"), F.max("date").alias("high")
    )
    met = Y.period_overlap(_periods(spark, sf_dir), ranges, ["symbol"])
    return met.select("symbol", "range_id", "period_str")


def orphan_periods(spark, sf_dir):
    return Y.orphan_periods(_periods(spark, sf_dir), ["symbol"]).select("symbol", "period_str", "target_period_str")


def rollup_plan(spark, sf_dir):
    return Y.rollup_plan(_periods(spark, sf_dir), T.instant_literal(NOW)).select("symbol", "period_str", "target_period_str")


def rollup_moves(spark, sf_dir):
    return Y.moves(Y.rollup_plan(_periods(spark, sf_dir), T.instant_literal(NOW)), ["symbol"])


def rebuild_plan(spark, sf_dir):
    """Orders as bars (one per priority and date, lowest key wins) rebuilt over the existing files."""
    orders = A.order_dates(spark, sf_dir).select("symbol", T.from_wall(F.col("date")).alias("ts"), F.col("o_totalprice").alias("close"), "o_orderkey")
    merged = M.merge_existing_wins([orders], order="o_orderkey").withColumn("date", T.wall_date(F.col("ts")))
    return Y.rebuild_plan(merged, _periods(spark, sf_dir), T.instant_literal(NOW), True, ["symbol"])


PERIODS = """WITH d AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders),
names AS (SELECT DISTINCT symbol, CASE WHEN year(date) < 1999 THEN strftime(date, '%Y') WHEN year(date) < 2001 THEN strftime(date, '%Y%m') ELSE strftime(date, '%Y%m%d') END AS period_str FROM d
  UNION SELECT symbol, strftime(date, '%Y%m%d') FROM d WHERE day(date) = 1 AND symbol < '3'),
files AS (SELECT symbol, period_str, 'ohlcv_data_' || period_str || '.csv' AS file_name_str,
  CASE length(period_str) WHEN 4 THEN 'year' WHEN 6 THEN 'month' ELSE 'day' END AS period_kind_str,
  CAST(strptime(period_str || CASE length(period_str) WHEN 4 THEN '0101' WHEN 6 THEN '01' ELSE '' END, '%Y%m%d') AS DATE) AS first_date FROM names),
catalog AS (SELECT *, CASE length(period_str) WHEN 4 THEN make_date(year(first_date), 12, 31) WHEN 6 THEN last_day(first_date) ELSE first_date END AS last_date FROM files)"""
ORGANIZED = """, plan AS (SELECT symbol, period_str, CASE WHEN length(period_str) > 4 AND year(first_date) < 2001 THEN substr(period_str, 1, 4)
  WHEN length(period_str) > 6 AND year(first_date) = 2001 AND month(first_date) < 6 THEN substr(period_str, 1, 6) ELSE period_str END AS target_period_str FROM catalog)"""

REPORTS = {
    "period_catalog": (period_catalog, PERIODS + " SELECT * FROM catalog"),
    "period_overlap": (
        period_overlap,
        PERIODS
        + """, ranges AS (SELECT symbol, strftime(date_trunc('quarter', date), '%Y%m') AS range_id, min(date) AS low, max(date) AS high FROM d GROUP BY 1, 2)
SELECT r.symbol, range_id, period_str FROM ranges r JOIN catalog c ON c.symbol = r.symbol AND c.last_date >= r.low AND c.first_date <= r.high""",
    ),
    "orphan_periods": (
        orphan_periods,
        PERIODS
        + """ SELECT c.symbol, c.period_str, COALESCE(y.period_str, m.period_str, c.period_str) AS target_period_str FROM catalog c
LEFT JOIN names y ON y.symbol = c.symbol AND length(c.period_str) > 4 AND y.period_str = substr(c.period_str, 1, 4)
LEFT JOIN names m ON m.symbol = c.symbol AND length(c.period_str) = 8 AND m.period_str = substr(c.period_str, 1, 6)""",
    ),
    "rollup_plan": (rollup_plan, PERIODS + ORGANIZED + " SELECT * FROM plan"),
    "rollup_moves": (
        rollup_moves,
        PERIODS
        + ORGANIZED
        + """ SELECT symbol, target_period_str, count(*) AS source_count, min(period_str) AS first_source, max(period_str) AS last_source
FROM plan WHERE period_str <> target_period_str GROUP BY 1, 2""",
    ),
    "rebuild_plan": (
        rebuild_plan,
        PERIODS
        + """, built AS (SELECT symbol, CASE WHEN year(date) < 2001 THEN strftime(date, '%Y') WHEN year(date) = 2001 AND month(date) < 6 THEN strftime(date, '%Y%m')
  ELSE strftime(date, '%Y%m%d') END AS p, count(*) AS n FROM (SELECT DISTINCT symbol, date FROM d) GROUP BY 1, 2)
SELECT COALESCE(b.symbol, c.symbol) AS symbol, 'ohlcv_data_' || COALESCE(p, period_str) || '.csv' AS file_name_str, COALESCE(n, 0) AS row_count_int,
  CASE WHEN n IS NULL THEN 'remove (stale)' WHEN period_str IS NOT NULL THEN 'replace' ELSE 'create' END AS action_str
FROM built b FULL JOIN names c ON c.symbol = b.symbol AND c.period_str = b.p""",
    ),
}
