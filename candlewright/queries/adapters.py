"""The test tables seen as bars. ``events.ts`` is read as a New York wall clock.

The adapters only feed the reports; they are not part of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewright.functions import times as T
from candlewright.operators import calendar as C

FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-31"
HOLIDAYS = ["2024-01-01", "2024-01-15"]
EARLY_CLOSE = ("2024-01-19", "13:00")
NOW = "2024-01-31 12:00:00"
HOUR = 3600

ORDER_FIRST, ORDER_LAST = "1995-01-01", "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now() -> Column:
    return T.instant_literal(NOW)


def holidays(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"(DATE '{d}')" for d in HOLIDAYS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(date)")


def early_closes(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES (DATE '{EARLY_CLOSE[0]}', '{EARLY_CLOSE[1]}') AS t(date, close_time)")


def calendar(spark: SparkSession, hourly: bool = False, early: bool = False) -> DataFrame:
    return C.sessions(
        spark, FIRST_DAY, LAST_DAY, holidays(spark), early_closes(spark) if early else None,
        open_time="09:00" if hourly else "09:30", step_seconds=HOUR if hourly else 60,
    )


def event_labels(spark: SparkSession, sf_dir: str, symbol: str = "event_type", step: int = 60) -> DataFrame:
    """symbol, ts: the label of every event on a bar grid."""
    events = table(spark, sf_dir, "events")
    label = T.floor_to(F.col("ts").cast("timestamp"), step)
    return events.select(F.col(symbol).cast("string").alias("symbol"), T.from_wall(label).alias("ts"))


def event_bars(spark: SparkSession, sf_dir: str, step: int = HOUR, planted: bool = False) -> DataFrame:
    """Every event as a bar row on the grid: symbol, date, ts, prices, volume and arrival order.

    ``planted`` bends some candles and volumes so that the checks have something to find.
    """
    events = table(spark, sf_dir, "events")
    raw = F.col("ts").cast("timestamp")
    number, value = F.col("event_id"), F.col("value")
    every = lambda k: F.pmod(number, F.lit(k)) == 0
    high = F.when(every(97), value - 1).otherwise(value + 1) if planted else value
    low = F.when(every(101), F.lit(-1.0)).otherwise(value) if planted else value
    volume = F.lit(1.0)
    if planted:
        volume = (
            F.when(every(53), F.lit(float(2**127 - 1)))
            .when(every(59), F.lit(0.0))
            .when(every(61), F.lit(-1.0))
            .when(every(67), F.lit(12.5))
            .otherwise((F.pmod(number, F.lit(1000)) + 1).cast("double"))
        )
    return events.select(
        F.col("event_type").alias("symbol"),
        F.to_date(raw).alias("date"),
        T.from_wall(T.floor_to(raw, step)).alias("ts"),
        value.alias("open"), high.alias("high"), low.alias("low"), value.alias("close"), volume.alias("volume"),
        number.alias("event_id"), F.col("user_id"),
    )


def hourly_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique hourly OHLCV bars per event type."""
    from candlewright.operators import bars as B

    return B.ohlcv_rollup(event_bars(spark, sf_dir), ["symbol", "date", "ts"], "event_id")


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice")


def order_calendar(spark: SparkSession, last: str = ORDER_LAST) -> DataFrame:
    """Weekdays as sessions."""
    return C.sessions(spark, ORDER_FIRST, last)


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = order_dates(spark, sf_dir).select("symbol").distinct()
    return symbols.withColumn("start_date", F.lit(ORDER_FIRST).cast("date"))


def text(ts: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(T.wall(F.col(ts)), pattern)


# SQL pieces shared by the check statements.
SQL_HOLIDAYS = "(DATE '2024-01-01', DATE '2024-01-15')"
SQL_MINUTE_CALENDAR = f"""cal AS (
  SELECT CAST(d AS DATE) AS date, d + INTERVAL 570 MINUTE AS first_ts, d + INTERVAL 959 MINUTE AS last_ts, 390 AS n
  FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) t(d)
  WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN {SQL_HOLIDAYS})"""
SQL_HOUR_CALENDAR = f"""cal AS (
  SELECT CAST(d AS DATE) AS date, d + INTERVAL 9 HOUR AS first_ts, d + INTERVAL 15 HOUR AS last_ts, 7 AS n
  FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) t(d)
  WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN {SQL_HOLIDAYS})"""
SQL_PLANTED = """planted AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts, value AS open,
    CASE WHEN event_id % 97 = 0 THEN value - 1 ELSE value + 1 END AS high,
    CASE WHEN event_id % 101 = 0 THEN -1.0 ELSE value END AS low, value AS close,
    CASE WHEN event_id % 53 = 0 THEN CAST(170141183460469231731687303715884105727 AS DOUBLE) WHEN event_id % 59 = 0 THEN 0.0
      WHEN event_id % 61 = 0 THEN -1.0 WHEN event_id % 67 = 0 THEN 12.5 ELSE CAST(event_id % 1000 + 1 AS DOUBLE) END AS volume,
    event_id, user_id FROM events)"""
SQL_HOURLY = """hourly AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts, arg_min(value, event_id) AS open,
    max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2, 3)"""
SQL_ORDER_DAYS = """days AS (SELECT DISTINCT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders)"""


def sql_weekdays(last: str, first: str = ORDER_FIRST, name: str = "cal") -> str:
    return f"""{name} AS (SELECT CAST(d AS DATE) AS date FROM range(TIMESTAMP '{first}', TIMESTAMP '{last}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
  WHERE isodow(d) < 6)"""
