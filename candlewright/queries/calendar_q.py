"""Sessions and weekday calendars next to the rows of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import times as T
from candlewright.operators import calendar as C
from candlewright.queries import adapters as A

CLOCK = "2024-01-30 16:04:00"
PLAN_NOW = "2024-02-16 10:15:00"


def closed_sessions(spark, sf_dir):
    """Sessions with events, and whether they count as closed or finished at a fixed time."""
    clock = T.instant_literal(CLOCK)
    days = A.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("event_count"))
    return A.calendar(spark, early=True).join(days, "date").select(
        "date", "event_count", F.col("bar_count_int").cast("bigint").alias("bar_count_int"),
        A.text("last_bar_ts").alias("last_bar"), C.is_closed(clock).alias("closed"), C.is_finished(clock).alias("finished"),
    )


def next_session(spark, sf_dir):
    """First session on or after the date of every event, within ten days."""
    lookup = C.next_session_lookup(A.calendar(spark), A.FIRST_DAY, A.LAST_DAY)
    events = A.table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("date"))
    per_day = events.groupBy("event_type", "date").agg(F.count(F.lit(1)).alias("event_count"))
    return C.with_next_session(per_day, lookup).select("event_type", "date", "next_date", "event_count")


def session_status(spark, sf_dir):
    """Market status at the second of every event."""
    calendar = A.calendar(spark, early=True)
    lookup = C.next_session_lookup(calendar, A.FIRST_DAY, A.LAST_DAY, 14)
    second = T.floor_to(F.col("ts").cast("timestamp"), 1)
    events = A.table(spark, sf_dir, "events").select("event_id", T.from_wall(second).alias("ts"))
    return C.with_market_status(events, calendar, lookup).select(
        "event_id", "session_today_bool", "market_open_bool", A.text("next_first_bar_ts").alias("next_open"),
        "seconds_until_open_int", "seconds_until_close_int",
    )


def weekday_minutes(spark, sf_dir):
    """Trading minutes of every weekday with events, and how many of them saw one."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    seen = A.table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), minute.alias("minute")).groupBy("date", "minute").agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = C.weekday_minutes(seen.select("date").distinct())
    return grid.join(seen, ["date", "minute"], "left").groupBy("date").agg(
        F.count(F.lit(1)).alias("trading_minutes"), F.count("n").alias("active_minutes"), F.coalesce(F.sum("n"), F.lit(0)).alias("event_count")
    )


def explicit_dates(spark, sf_dir):
    """Asked-for dates (every date a user was active) split into sessions and non-sessions."""
    wanted = A.table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"))
    sessions, others = C.split_requested(wanted, A.calendar(spark))
    return sessions.select("date", F.lit(True).alias("is_session")).unionByName(others.withColumn("is_session", F.lit(False)))


def range_validity(spark, sf_dir):
    """Weekly load plan of every user after the last event, with range rules and weeks already loaded."""
    events = A.table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("local"))
    label = T.floor_to(F.col("local"), 60)
    series = events.groupBy("user_id").agg(F.max(T.from_wall(label)).alias("last_ts"))
    monday, friday = C.work_week(F.to_date("local"))
    loaded = events.select(
        "user_id", F.concat(F.date_format(monday, "yyyyMMdd"), F.lit("-"), F.date_format(friday, "yyyyMMdd")).alias("week")
    )
    return C.weekly_load_plan(series, loaded, ["user_id"], T.instant_literal(PLAN_NOW))


SPANS = f"""{A.SQL_MINUTE_CALENDAR},
spans AS (SELECT date, first_ts, CASE WHEN date = DATE '2024-01-19' THEN date + INTERVAL 779 MINUTE ELSE last_ts END AS last_ts FROM cal)"""

REPORTS = {
    "closed_sessions": (
        closed_sessions,
        f"""WITH {SPANS}, days AS (SELECT CAST(ts AS DATE) AS date, count(*) AS event_count FROM events GROUP BY 1)
SELECT s.date, event_count, date_diff('minute', first_ts, last_ts) + 1 AS bar_count_int, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_bar,
  last_ts + INTERVAL 6 MINUTE <= TIMESTAMP '{CLOCK}' AS closed,
  s.date < DATE '2024-01-30' OR (s.date = DATE '2024-01-30' AND TIMESTAMP '{CLOCK}' >= TIMESTAMP '2024-01-30 17:00:00') AS finished
FROM spans s JOIN days d ON d.date = s.date""",
    ),
    "next_session": (
        next_session,
        f"""WITH {A.SQL_MINUTE_CALENDAR}, days AS (SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS event_count FROM events GROUP BY 1, 2)
SELECT event_type, d.date, (SELECT min(c.date) FROM cal c WHERE c.date >= d.date AND c.date <= d.date + 10) AS next_date, event_count FROM days d""",
    ),
    "session_status": (
        session_status,
        f"""WITH {SPANS}, clock AS (SELECT event_id, date_trunc('second', ts) AS now FROM events),
next_of AS (SELECT d.date, (SELECT min(first_ts) FROM spans s WHERE s.date > d.date) AS later FROM (SELECT DISTINCT CAST(now AS DATE) AS date FROM clock) d),
st AS (SELECT event_id, now, s.date IS NOT NULL AS session_today_bool, COALESCE(now >= first_ts AND now < last_ts + INTERVAL 1 MINUTE, FALSE) AS market_open_bool,
  CASE WHEN first_ts > now THEN first_ts ELSE later END AS nxt, last_ts
  FROM clock c LEFT JOIN spans s ON s.date = CAST(now AS DATE) LEFT JOIN next_of n ON n.date = CAST(now AS DATE))
SELECT event_id, session_today_bool, market_open_bool, strftime(nxt, '%Y-%m-%d %H:%M:%S') AS next_open,
  CASE WHEN nxt IS NOT NULL AND NOT market_open_bool THEN date_diff('second', now, nxt) ELSE 0 END AS seconds_until_open_int,
  CASE WHEN market_open_bool THEN date_diff('second', now, last_ts + INTERVAL 1 MINUTE) ELSE 0 END AS seconds_until_close_int FROM st""",
    ),
    "weekday_minutes": (
        weekday_minutes,
        """WITH seen AS (SELECT CAST(ts AS DATE) AS date, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2),
grid AS (SELECT date, unnest(generate_series(date + INTERVAL 570 MINUTE, date + INTERVAL 959 MINUTE, INTERVAL 1 MINUTE)) AS minute
  FROM (SELECT DISTINCT date FROM seen) WHERE isodow(date) < 6)
SELECT g.date, count(*) AS trading_minutes, count(n) AS active_minutes, CAST(COALESCE(sum(n), 0) AS BIGINT) AS event_count
FROM grid g LEFT JOIN seen s ON s.minute = g.minute GROUP BY 1""",
    ),
    "explicit_dates": (
        explicit_dates,
        f"""WITH {A.SQL_MINUTE_CALENDAR} SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(ts AS DATE) IN (SELECT date FROM cal) AS is_session FROM events""",
    ),
    "range_validity": (
        range_validity,
        f"""WITH series AS (SELECT user_id, date_trunc('minute', max(ts)) AS last_ts FROM events GROUP BY 1),
minutes AS (SELECT user_id, unnest(generate_series(last_ts, TIMESTAMP '{PLAN_NOW}', INTERVAL 1 MINUTE)) AS m FROM series),
active AS (SELECT user_id FROM minutes WHERE isodow(m) < 6 AND CAST(m AS TIME) BETWEEN TIME '09:30:00' AND TIME '15:59:00' GROUP BY 1 HAVING count(*) > 1),
steps AS (SELECT user_id, unnest(generate_series(last_ts, TIMESTAMP '{PLAN_NOW}', INTERVAL 24 HOUR)) AS d FROM series WHERE user_id IN (SELECT user_id FROM active)),
weeks AS (SELECT DISTINCT user_id, CAST(date_trunc('week', d) AS DATE) AS first_date FROM steps WHERE isodow(d) < 6),
known AS (SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) AS first_date FROM events)
SELECT w.user_id, strftime(w.first_date, '%Y%m%d') || '-' || strftime(w.first_date + 4, '%Y%m%d') AS week, w.first_date, w.first_date + 4 AS last_date,
  w.first_date > DATE '2024-02-16' - 30 AS valid, k.user_id IS NOT NULL AS loaded
FROM weeks w LEFT JOIN known k ON k.user_id = w.user_id AND k.first_date = w.first_date""",
    ),
}
