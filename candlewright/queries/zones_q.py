"""Week slices, timezone pairs and date fields over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import times as T, values as V
from candlewright.operators import zones as Z
from candlewright.queries import adapters as A

NTZ = "yyyy-MM-dd HH:mm:ss"


def _zone_rows(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    return events.select("event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("ny_timestamp"), "event_type", "value")


def week_slices(spark, sf_dir):
    """Rows of Monday 09:30 to Friday 15:59, counted per week and type."""
    sliced = Z.week_slices(_zone_rows(spark, sf_dir))
    counted = sliced.groupBy("week", "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("ny_timestamp").alias("low"), F.max("ny_timestamp").alias("high")
    )
    return counted.select(
        "week", "event_type", "row_count", F.date_format("low", NTZ).alias("first_row"), F.date_format("high", NTZ).alias("last_row")
    )


def canonical_columns(spark, sf_dir):
    """The events as downloaded bars, with names and zoned times as they come, in the columns of the zone."""
    prices = [F.col("value").alias(c) for c in ("Open", "High", "Low", "Close")]
    bars = A.table(spark, sf_dir, "events").select(
        "event_id", T.from_wall(F.date_trunc("second", F.col("ts").cast("timestamp"))).alias("Datetime"), *prices,
        F.col("user_id").alias("Volume"), F.lit(0.5).alias("Dividends"), F.lit(0.0).alias("Stock Splits"),
    )
    shaped = Z.canonical_columns(bars)
    return shaped.withColumn("ny_timestamp", F.date_format("ny_timestamp", NTZ))


def week_slices_unix(spark, sf_dir):
    """The same slice when the time column holds epoch seconds read on the Qatar clock."""
    rows = A.table(spark, sf_dir, "events").select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("qatar_unix"), "event_type")
    return Z.week_slices(rows, "qatar_unix").groupBy("week", "event_type").agg(F.count(F.lit(1)).alias("row_count"))


def tz_pair(spark, sf_dir):
    """Both clocks of every event and the hours between them."""
    paired = Z.tz_pair(_zone_rows(spark, sf_dir))
    gap = T.zone_gap_hours(T.from_wall(F.col("ny_timestamp")), Z.QATAR)
    return paired.select(
        "event_id", F.date_format("qatar_timestamp", NTZ).alias("qatar_timestamp"), F.date_format("ny_timestamp", NTZ).alias("ny_timestamp"), gap.alias("gap_hours")
    )


def ny_session_date(spark, sf_dir):
    """Order instants (UTC midnight plus the key as seconds) on the New York clock, daylight saving included."""
    orders = A.table(spark, sf_dir, "orders")
    instant = T.plus_micros(F.col("o_orderdate").cast("timestamp"), F.pmod("o_orderkey", F.lit(86400)) * F.lit(T.MICROS_PER_SECOND))
    return orders.select("o_orderkey", T.wall_date(instant).alias("session_date"), T.offset_text(instant).alias("label"))


def bar_date_parse(spark, sf_dir):
    """A field that mixes dates, epoch seconds and clock text with and without a zone."""
    events = A.table(spark, sf_dir, "events")
    local = F.date_trunc("second", F.col("ts").cast("timestamp"))
    clock = F.date_format(local, "yyyyMMdd HH:mm:ss")
    field = (
        F.when(F.col("event_type") == "view", F.date_format(local, "yyyyMMdd"))
        .when(F.col("event_type") == "click", F.unix_seconds(T.from_wall(local)).cast("string"))
        .when(F.col("event_type") == "purchase", F.concat(clock, F.lit(" US/Eastern")))
        .when(F.col("event_type") == "signup", F.concat(clock, F.lit(" UTC")))
        .otherwise(clock)
    )
    rows = events.select("event_id", "event_type", field.alias("field"))
    parsed = T.bar_date(F.col("field"))
    return rows.select(
        "event_id", F.unix_seconds(parsed).alias("epoch"), T.label_text(parsed, T.bar_date_is_daily(F.col("field"))).alias("label")
    )


def instant_parse(spark, sf_dir):
    """ISO text with different offsets of the same clock -> instants; junk becomes null."""
    events = A.table(spark, sf_dir, "events")
    clock = F.date_format(F.date_trunc("second", F.col("ts").cast("timestamp")), NTZ)
    suffix = F.when(F.col("event_type") == "view", "-05:00").when(F.col("event_type") == "click", "+03:00").when(F.col("event_type") == "error", "?").otherwise("+00:00")
    epoch = F.unix_seconds(T.instant(F.concat(clock, suffix))).cast("string")
    return events.select("event_id", F.coalesce(epoch, F.lit("")).alias("epoch"))


def number_parse(spark, sf_dir):
    """Numbers out of text that is not always a number, summed per type."""
    events = A.table(spark, sf_dir, "events")
    text = F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit("n/a")).when(F.pmod("event_id", F.lit(11)) == 0, F.lit("")).otherwise(F.col("value").cast("string"))
    number = V.number(text)
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.count(number).alias("numbers"), F.round(F.sum(number), 2).alias("total"))


def epoch_roundtrip(spark, sf_dir):
    """Epoch of a New York clock and back, over dates with and without daylight saving."""
    orders = A.table(spark, sf_dir, "orders")
    local = T.plus_micros(F.col("o_orderdate").cast("timestamp"), F.lit(16 * 3600 * T.MICROS_PER_SECOND))
    epoch = T.wall_to_epoch(local)
    return orders.select(
        "o_orderkey", epoch.alias("epoch"), F.date_format(T.epoch_to_wall(epoch), NTZ).alias("ny_clock"), F.date_format(T.epoch_to_wall(epoch, Z.QATAR), NTZ).alias("qatar_clock")
    )


def required_ranges(spark, sf_dir):
    """Weeks with events of a user that no 'purchase' file of the user covers yet."""
    rows = A.table(spark, sf_dir, "events").select("user_id", "event_type", Z.week_label(F.to_date("ts")).alias("week"))
    wanted = rows.select("user_id", "week").distinct()
    loaded = rows.where(F.col("event_type") == "purchase").select("user_id", "week").distinct()
    return Z.required_ranges(wanted, loaded, ["user_id"])


WEEK = "strftime(date_trunc('week', {t}), '%Y%m%d') || '-' || strftime(date_trunc('week', {t}) + INTERVAL 4 DAY, '%Y%m%d')"

REPORTS = {
    "week_slices": (
        week_slices,
        f"""WITH r AS (SELECT date_trunc('second', ts) AS t, event_type FROM events)
SELECT {WEEK.format(t='t')} AS week, event_type, count(*) AS row_count, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_row, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_row
FROM r WHERE t BETWEEN date_trunc('week', t) + INTERVAL 570 MINUTE AND date_trunc('week', t) + INTERVAL 4 DAY + INTERVAL 959 MINUTE GROUP BY 1, 2""",
    ),
    "week_slices_unix": (
        week_slices_unix,
        f"""WITH r AS (SELECT date_trunc('second', ts) + INTERVAL 3 HOUR AS t, event_type FROM events)
SELECT {WEEK.format(t='t')} AS week, event_type, count(*) AS row_count
FROM r WHERE t BETWEEN date_trunc('week', t) + INTERVAL 570 MINUTE AND date_trunc('week', t) + INTERVAL 4 DAY + INTERVAL 959 MINUTE GROUP BY 1, 2""",
    ),
    "tz_pair": (
        tz_pair,
        """WITH r AS (SELECT event_id, date_trunc('second', ts) AS t, timezone('Asia/Qatar', timezone('America/New_York', date_trunc('second', ts))) AS q FROM events)
SELECT event_id, strftime(q, '%Y-%m-%d %H:%M:%S') AS qatar_timestamp, strftime(t, '%Y-%m-%d %H:%M:%S') AS ny_timestamp, date_diff('second', t, q) / 3600.0 AS gap_hours FROM r""",
    ),
    "ny_session_date": (
        ny_session_date,
        """WITH r AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS u FROM orders),
n AS (SELECT o_orderkey, u, timezone('America/New_York', timezone('UTC', u)) AS t FROM r)
SELECT o_orderkey, CAST(t AS DATE) AS session_date, strftime(t, '%Y-%m-%d %H:%M:%S') || CASE WHEN date_diff('hour', t, u) = 4 THEN '-04:00' ELSE '-05:00' END AS label FROM n""",
    ),
    "bar_date_parse": (
        bar_date_parse,
        """WITH r AS (SELECT event_id, event_type, date_trunc('second', ts) AS t FROM events),
n AS (SELECT event_id, event_type, CASE event_type WHEN 'view' THEN date_trunc('day', t) + INTERVAL 5 HOUR WHEN 'signup' THEN t ELSE t + INTERVAL 5 HOUR END AS u FROM r)
SELECT event_id, CAST(epoch(u) AS BIGINT) AS epoch, CASE WHEN event_type = 'view' THEN strftime(u - INTERVAL 5 HOUR, '%Y-%m-%d') ELSE strftime(u - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') END AS label FROM n""",
    ),
    "instant_parse": (
        instant_parse,
        """SELECT event_id, CASE event_type WHEN 'error' THEN '' ELSE CAST(CAST(epoch(date_trunc('second', ts)) AS BIGINT)
  + CASE event_type WHEN 'view' THEN 18000 WHEN 'click' THEN -10800 ELSE 0 END AS VARCHAR) END AS epoch FROM events""",
    ),
    "number_parse": (
        number_parse,
        """SELECT event_type, count(*) AS rows, count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 <> 0) AS numbers,
  round(sum(value) FILTER (event_id % 7 <> 0 AND event_id % 11 <> 0), 2) AS total FROM events GROUP BY 1""",
    ),
    "epoch_roundtrip": (
        epoch_roundtrip,
        """WITH r AS (SELECT o_orderkey, o_orderdate + INTERVAL 16 HOUR AS t, timezone('America/New_York', o_orderdate + INTERVAL 16 HOUR) AS z FROM orders)
SELECT o_orderkey, CAST(epoch(timezone('UTC', z)) AS BIGINT) AS epoch, strftime(t, '%Y-%m-%d %H:%M:%S') AS ny_clock,
  strftime(timezone('Asia/Qatar', z), '%Y-%m-%d %H:%M:%S') AS qatar_clock FROM r""",
    ),
    "required_ranges": (
        required_ranges,
        f"""WITH r AS (SELECT user_id, event_type, {WEEK.format(t='ts')} AS week FROM events)
SELECT user_id, week FROM r GROUP BY 1, 2 HAVING count(*) FILTER (event_type = 'purchase') = 0""",
    ),
    "canonical_columns": (
        canonical_columns,
        """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ny_timestamp, value AS open, value AS high, value AS low, value AS close,
  user_id AS volume, CAST(0 AS DOUBLE) AS stock_splits FROM events""",
    ),
}
