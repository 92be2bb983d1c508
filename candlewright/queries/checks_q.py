"""Completeness reports over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import values as V
from candlewright.operators import calendar as C, checks as K
from candlewright.queries import adapters as A


def issue_report(spark, sf_dir):
    """Flagship: minute issues of every event type against the weekday sessions of January."""
    closed = C.closed_sessions(A.calendar(spark), A.now())
    return K.issue_report(A.event_labels(spark, sf_dir), closed, A.LAST_DAY)


def issue_report_by_user(spark, sf_dir):
    """The same per user on an hourly grid, where whole sessions are missing; coverage from 3 January."""
    closed = C.closed_sessions(A.calendar(spark, hourly=True), A.now(), step_seconds=A.HOUR)
    bars = A.event_labels(spark, sf_dir, "user_id", A.HOUR)
    return K.issue_report(bars, closed, A.LAST_DAY, start_date="2024-01-03", step_seconds=A.HOUR)


def issue_dates(spark, sf_dir):
    """How many dates show each issue over all event types, and the first of them."""
    closed = C.closed_sessions(A.calendar(spark), A.now())
    return K.issue_dates(K.issue_report(A.event_labels(spark, sf_dir), closed, A.LAST_DAY), 5)


def session_check(spark, sf_dir):
    """Hourly session status per event type and date."""
    bars = A.event_bars(spark, sf_dir).select("symbol", "date", "ts")
    return K.session_check(bars, A.calendar(spark, hourly=True), step_seconds=A.HOUR, max_listed=3)


def session_check_seconds(spark, sf_dir):
    """Session status on a grid of 23,400 seconds a day: every event is a bar of its second."""
    calendar = C.sessions(spark, A.FIRST_DAY, A.LAST_DAY, A.holidays(spark), step_seconds=1)
    bars = A.event_bars(spark, sf_dir, step=1).select("symbol", "date", "ts")
    return K.session_check(bars, calendar, step_seconds=1, max_listed=3)


def in_session(spark, sf_dir):
    """Bars inside a session that closes early on one day, counted per type and date."""
    kept = K.in_session(A.event_labels(spark, sf_dir), A.calendar(spark, early=True))
    spans = kept.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("bar_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return spans.select("symbol", "date", "bar_count", A.text("first_ts").alias("first_bar"), A.text("last_ts").alias("last_bar"))


def core_hours_check(spark, sf_dir):
    """Hourly core check 09:00-15:00 per event type and day."""
    bars = A.event_bars(spark, sf_dir).select("symbol", "date", "ts")
    return K.core_hours_check(bars, None, "09:00", "15:00", A.HOUR, 3)


def core_hours_check_by_user(spark, sf_dir):
    """The core check where most sessions start late, end early or miss the core hours altogether."""
    events = A.event_bars(spark, sf_dir).select(F.col("user_id").cast("string").alias("symbol"), "date", "ts")
    return K.core_hours_check(events, None, "09:00", "15:00", A.HOUR, 2)


def daily_chunk_check(spark, sf_dir):
    """Year chunks of daily order dates against the weekdays of the year."""
    received = A.order_dates(spark, sf_dir).select("symbol", F.date_format("date", "yyyy").alias("label"), "date")
    sessions = A.order_calendar(spark)
    wanted = A.order_series(spark, sf_dir).select(
        "symbol", F.explode(F.sequence("start_date", F.lit(A.ORDER_LAST).cast("date"))).alias("date")
    ).join(sessions.select("date"), "date").select("symbol", F.date_format("date", "yyyy").alias("label"), "date")
    return K.daily_chunk_check(received, wanted, sessions, 5)


def bar_summary(spark, sf_dir):
    """Label span, gaps, volume class and first candle per event type and date."""
    return K.bar_summary(A.event_bars(spark, sf_dir, step=60, planted=True), ["symbol", "date"], "event_id")


def volume_class(spark, sf_dir):
    """Volumes as written text and their class, counted."""
    bars = A.event_bars(spark, sf_dir, planted=True)
    return bars.groupBy(V.volume_class(F.col("volume")).alias("volume_info"), V.volume_text(F.col("volume")).alias("volume_text")).agg(
        F.count(F.lit(1)).alias("n")
    )


def candle_issues(spark, sf_dir):
    return K.candle_issues(A.event_bars(spark, sf_dir, planted=True), ["symbol", "date"])


def session_text(spark, sf_dir):
    """Text rows of the session files: first row per session minute, ISO text with the offset; tiny and huge prices too."""
    bars = A.event_bars(spark, sf_dir, step=60, planted=True).select("symbol", "date", "ts", *_written_prices(), "volume", "event_id")
    text = K.session_text(bars, A.calendar(spark, early=True), "event_id")
    return text.select("symbol", "timestamp", "open", "high", "low", "close", "volume", "created_ts", "date")


def _written_prices():
    """Whole numbers by event, moved by powers of ten from a ten-thousandth to ten million."""
    number = F.col("event_id")
    return [
        (number + 1).cast("double").alias("open"), (F.pmod(number, F.lit(9)) * 10_000_000 + 12_345_678).cast("double").alias("high"),
        F.element_at(F.array(*[F.lit(float(x)) for x in TINY]), (F.pmod(number, F.lit(len(TINY))) + 1).cast("int")).alias("low"),
        (number + F.lit(0.5)).alias("close"),
    ]


def day_text(spark, sf_dir):
    """Text rows of index days: every bar of its own day, first row per label."""
    bars = A.event_bars(spark, sf_dir, step=60, planted=True).select("symbol", "date", "ts", *_written_prices(), "volume", "event_id")
    return K.day_text(bars, "event_id")


#: Prices below a thousandth and around it, with their text.
TINY = ("0.00012", "0.00005", "0.001", "0.0999", "0.000001234")

WRITTEN_BARS = f"""bars AS (SELECT p.symbol, p.date, p.event_id, p.volume, date_trunc('minute', e.ts) AS ts,
  (p.event_id + 1) || '.0' AS open, ((p.event_id % 9) * 10000000 + 12345678) || '.0' AS high,
  list_value({", ".join(f"'{x}'" for x in TINY)})[p.event_id % {len(TINY)} + 1] AS low, p.event_id || '.5' AS close
  FROM planted p JOIN events e ON e.event_id = p.event_id)"""
WRITTEN_ROW = """symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') || '-05:00' AS timestamp, open, high, low, close,
  CASE WHEN volume >= pow(2, 126) THEN '' WHEN volume = floor(volume) THEN CAST(CAST(volume AS BIGINT) AS VARCHAR) ELSE CAST(volume AS VARCHAR) END AS volume,
  '' AS created_ts, CAST(date AS VARCHAR) AS date"""

ISSUE_CTES = """
per_ts AS (SELECT symbol, ts, CAST(ts AS DATE) AS date, count(*) AS n FROM bars GROUP BY 1, 2, 3),
expected AS (SELECT s.symbol, c.date, g.ts FROM starts s JOIN cal c ON c.date >= s.start,
  LATERAL (SELECT unnest(generate_series(c.first_ts, c.last_ts, {step})) AS ts) g),
cmp AS (SELECT COALESCE(e.symbol, p.symbol) AS symbol, COALESCE(e.date, p.date) AS date, COALESCE(e.ts, p.ts) AS ts,
    e.ts IS NOT NULL AS exp, COALESCE(p.n, 0) AS n
  FROM expected e FULL JOIN per_ts p ON e.symbol = p.symbol AND e.ts = p.ts),
agg AS (SELECT symbol, date, count(*) FILTER (exp) AS expected_count_int, CAST(sum(n) AS BIGINT) AS bar_count_int,
    count(*) FILTER (n > 0) AS unique_count_int, count(*) FILTER (exp AND n = 0) AS missing_count_int,
    list(strftime(ts, '%H:%M') ORDER BY ts) FILTER (exp AND n = 0) AS m, count(*) FILTER (NOT exp) AS extra_count_int,
    list(strftime(ts, '%H:%M') ORDER BY ts) FILTER (NOT exp) AS x FROM cmp GROUP BY 1, 2),
issues AS (SELECT symbol, date, concat_ws(',',
    CASE WHEN expected_count_int = 0 THEN 'no_session' END,
    CASE WHEN expected_count_int > 0 AND bar_count_int = 0 THEN 'missing_session' END,
    CASE WHEN missing_count_int > 0 AND bar_count_int > 0 THEN 'missing_minutes' END,
    CASE WHEN extra_count_int > 0 AND expected_count_int > 0 THEN 'extra_minutes' END,
    CASE WHEN bar_count_int > unique_count_int THEN 'duplicate_rows' END) AS issue_str,
  expected_count_int, bar_count_int, unique_count_int, missing_count_int,
  COALESCE(array_to_string(m[1:10], ', '), '') || CASE WHEN missing_count_int > 10 THEN ' (+' || (missing_count_int - 10) || ' more)' ELSE '' END AS missing_str,
  extra_count_int,
  COALESCE(array_to_string(x[1:10], ', '), '') || CASE WHEN extra_count_int > 10 THEN ' (+' || (extra_count_int - 10) || ' more)' ELSE '' END AS extra_str,
  bar_count_int - unique_count_int AS duplicate_count_int
  FROM agg WHERE missing_count_int > 0 OR extra_count_int > 0 OR bar_count_int > unique_count_int)
"""

SQL_ISSUES = f"""WITH bars AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts FROM events),
starts AS (SELECT symbol, CAST(min(ts) AS DATE) AS start FROM bars GROUP BY 1),
all_{A.SQL_MINUTE_CALENDAR.replace('cal AS', 'days AS')},
cal AS (SELECT * FROM all_days WHERE last_ts + INTERVAL 6 MINUTE <= TIMESTAMP '{A.NOW}'),
{ISSUE_CTES.format(step="INTERVAL 1 MINUTE")}"""

SQL_CORE = """
own AS (SELECT symbol, date, ts, count(*) AS n FROM bars GROUP BY 1, 2, 3),
days AS (SELECT symbol, date, count(*) AS bar_count_int, CAST(sum(n) AS BIGINT) AS row_total, min(ts) AS first_ts, max(ts) AS last_ts,
  greatest(min(ts), date + INTERVAL 9 HOUR) AS low, least(max(ts), date + INTERVAL 15 HOUR) AS high FROM own GROUP BY symbol, date),
grid AS (SELECT symbol, date, unnest(generate_series(low, high, INTERVAL 1 HOUR)) AS ts FROM days WHERE low <= high),
gaps AS (SELECT g.symbol, g.date, count(*) AS expected, count(*) FILTER (o.ts IS NULL) AS missing,
    list(strftime(g.ts, '%H:%M') ORDER BY g.ts) FILTER (o.ts IS NULL) AS m
  FROM grid g LEFT JOIN own o ON o.symbol = g.symbol AND o.ts = g.ts GROUP BY 1, 2)
SELECT d.symbol, d.date, CASE WHEN COALESCE(missing, 0) > 0 THEN 'partial' ELSE 'complete' END AS status_str, bar_count_int,
  COALESCE(expected, 0) AS expected_count_int, COALESCE(missing, 0) AS missing_count_int, CAST(0 AS BIGINT) AS extra_count_int,
  row_total - bar_count_int AS duplicate_count_int, strftime(first_ts, '%H:%M') AS first_bar_str, strftime(last_ts, '%H:%M') AS last_bar_str,
  COALESCE(array_to_string(m[1:{n}], ' '), '') || CASE WHEN COALESCE(missing, 0) > {n} THEN ' ...' ELSE '' END AS missing_str, '' AS extra_str
FROM days d LEFT JOIN gaps g ON d.symbol = g.symbol AND d.date = g.date"""

REPORTS = {
    "issue_report": (issue_report, SQL_ISSUES + "SELECT * FROM issues"),
    "issue_report_by_user": (
        issue_report_by_user,
        f"""WITH bars AS (SELECT CAST(user_id AS VARCHAR) AS symbol, date_trunc('hour', ts) AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-03'),
starts AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol, DATE '2024-01-03' AS start FROM events),
all_{A.SQL_HOUR_CALENDAR.replace('cal AS', 'days AS')},
cal AS (SELECT * FROM all_days WHERE last_ts + INTERVAL 65 MINUTE <= TIMESTAMP '{A.NOW}'),
{ISSUE_CTES.format(step="INTERVAL 1 HOUR")} SELECT * FROM issues""",
    ),
    "issue_dates": (
        issue_dates,
        SQL_ISSUES
        + """, kinds AS (SELECT DISTINCT unnest(string_split(issue_str, ',')) AS issue, date FROM issues)
SELECT issue, count(*) AS date_count, array_to_string(list(CAST(date AS VARCHAR) ORDER BY date)[1:5], ' ') AS first_dates FROM kinds GROUP BY 1""",
    ),
    "session_check": (
        session_check,
        f"""WITH {A.SQL_HOUR_CALENDAR},
per_ts AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2, 3),
pairs AS (SELECT DISTINCT symbol, date FROM per_ts),
expected AS (SELECT p.symbol, c.date, unnest(generate_series(c.first_ts, c.last_ts, INTERVAL 1 HOUR)) AS ts FROM pairs p JOIN cal c ON c.date = p.date),
cmp AS (SELECT COALESCE(e.symbol, p.symbol) AS symbol, COALESCE(e.date, p.date) AS date, COALESCE(e.ts, p.ts) AS ts,
    e.ts IS NOT NULL AS exp, COALESCE(p.n, 0) AS n FROM expected e FULL JOIN per_ts p ON e.symbol = p.symbol AND e.ts = p.ts),
agg AS (SELECT symbol, date, count(*) FILTER (exp) AS expected_count_int, CAST(sum(n) AS BIGINT) AS bar_count_int,
    count(*) FILTER (exp AND n = 0) AS missing_count_int, count(*) FILTER (NOT exp) AS extra_count_int,
    CAST(sum(n) AS BIGINT) - count(*) FILTER (n > 0) AS duplicate_count_int,
    list(strftime(ts, '%H:%M') ORDER BY ts) FILTER (exp AND n = 0) AS m, list(strftime(ts, '%H:%M') ORDER BY ts) FILTER (NOT exp) AS x
  FROM cmp GROUP BY 1, 2)
SELECT symbol, date, CASE WHEN expected_count_int = 0 THEN 'no_session' WHEN missing_count_int = 0 THEN 'complete' ELSE 'partial' END AS status_str,
  expected_count_int, bar_count_int, missing_count_int, extra_count_int, duplicate_count_int,
  COALESCE(array_to_string(m[1:3], ', '), '') || CASE WHEN missing_count_int > 3 THEN ' (+' || (missing_count_int - 3) || ' more)' ELSE '' END AS missing_str,
  COALESCE(array_to_string(x[1:3], ', '), '') || CASE WHEN extra_count_int > 3 THEN ' (+' || (extra_count_int - 3) || ' more)' ELSE '' END AS extra_str
FROM agg""",
    ),
    "session_check_seconds": (
        session_check_seconds,
        f"""WITH {A.SQL_MINUTE_CALENDAR},
seconds AS (SELECT date, first_ts, last_ts + INTERVAL 59 SECOND AS last_ts FROM cal),
per_ts AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('second', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2, 3),
pairs AS (SELECT DISTINCT symbol, date FROM per_ts),
expected AS (SELECT p.symbol, c.date, unnest(generate_series(c.first_ts, c.last_ts, INTERVAL 1 SECOND)) AS ts FROM pairs p JOIN seconds c ON c.date = p.date),
cmp AS (SELECT COALESCE(e.symbol, p.symbol) AS symbol, COALESCE(e.date, p.date) AS date, COALESCE(e.ts, p.ts) AS ts,
    e.ts IS NOT NULL AS exp, COALESCE(p.n, 0) AS n FROM expected e FULL JOIN per_ts p ON e.symbol = p.symbol AND e.ts = p.ts),
agg AS (SELECT symbol, date, count(*) FILTER (exp) AS expected_count_int, CAST(sum(n) AS BIGINT) AS bar_count_int,
    count(*) FILTER (exp AND n = 0) AS missing_count_int, count(*) FILTER (NOT exp) AS extra_count_int,
    CAST(sum(n) AS BIGINT) - count(*) FILTER (n > 0) AS duplicate_count_int,
    list(strftime(ts, '%H:%M:%S') ORDER BY ts) FILTER (exp AND n = 0) AS m, list(strftime(ts, '%H:%M:%S') ORDER BY ts) FILTER (NOT exp) AS x
  FROM cmp GROUP BY 1, 2)
SELECT symbol, date, CASE WHEN expected_count_int = 0 THEN 'no_session' WHEN missing_count_int = 0 THEN 'complete' ELSE 'partial' END AS status_str,
  expected_count_int, bar_count_int, missing_count_int, extra_count_int, duplicate_count_int,
  COALESCE(array_to_string(m[1:3], ', '), '') || CASE WHEN missing_count_int > 3 THEN ' (+' || (missing_count_int - 3) || ' more)' ELSE '' END AS missing_str,
  COALESCE(array_to_string(x[1:3], ', '), '') || CASE WHEN extra_count_int > 3 THEN ' (+' || (extra_count_int - 3) || ' more)' ELSE '' END AS extra_str
FROM agg""",
    ),
    "in_session": (
        in_session,
        f"""WITH {A.SQL_MINUTE_CALENDAR},
spans AS (SELECT date, first_ts, CASE WHEN date = DATE '2024-01-19' THEN date + INTERVAL 779 MINUTE ELSE last_ts END AS last_ts FROM cal),
bars AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts FROM events)
SELECT symbol, date, count(*) AS bar_count, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_bar, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_bar
FROM bars JOIN spans ON CAST(ts AS DATE) = date AND ts BETWEEN first_ts AND last_ts GROUP BY 1, 2""",
    ),
    "core_hours_check": (
        core_hours_check,
        "WITH bars AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts FROM events),"
        + SQL_CORE.format(n=3),
    ),
    "core_hours_check_by_user": (
        core_hours_check_by_user,
        "WITH bars AS (SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts FROM events),"
        + SQL_CORE.format(n=2),
    ),
    "daily_chunk_check": (
        daily_chunk_check,
        f"""WITH {A.sql_weekdays(A.ORDER_LAST)},
got AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1, 2),
wanted AS (SELECT symbol, date FROM (SELECT DISTINCT symbol FROM got), cal),
marks AS (SELECT COALESCE(w.symbol, g.symbol) AS symbol, COALESCE(w.date, g.date) AS date, w.date IS NOT NULL AS want, COALESCE(n, 0) AS n
  FROM wanted w FULL JOIN got g ON w.symbol = g.symbol AND w.date = g.date),
bounded AS (SELECT *, strftime(date, '%Y') AS label, min(CASE WHEN want THEN date END) OVER (PARTITION BY symbol, strftime(date, '%Y')) AS low,
  max(CASE WHEN want THEN date END) OVER (PARTITION BY symbol, strftime(date, '%Y')) AS high FROM marks),
agg AS (SELECT symbol, label, count(*) FILTER (want AND n > 0) AS bar_count_int, count(*) FILTER (want) AS expected_count_int,
  count(*) FILTER (want AND n = 0) AS missing_count_int, count(*) FILTER (NOT want AND date BETWEEN low AND high) AS extra_count_int,
  CAST(sum(n) AS BIGINT) - count(*) FILTER (n > 0) AS duplicate_count_int,
  CAST(min(CASE WHEN want AND n > 0 THEN date END) AS VARCHAR) AS first_bar_str, CAST(max(CASE WHEN want AND n > 0 THEN date END) AS VARCHAR) AS last_bar_str,
  list(CAST(date AS VARCHAR) ORDER BY date) FILTER (want AND n = 0) AS m,
  list(CAST(date AS VARCHAR) ORDER BY date) FILTER (NOT want AND date BETWEEN low AND high) AS x FROM bounded GROUP BY 1, 2)
SELECT symbol, label, CASE WHEN bar_count_int = 0 THEN 'empty' WHEN missing_count_int > 0 THEN 'partial' ELSE 'complete' END AS status_str,
  bar_count_int, expected_count_int, missing_count_int, extra_count_int, duplicate_count_int, first_bar_str, last_bar_str,
  COALESCE(array_to_string(m[1:5], ' '), '') || CASE WHEN missing_count_int > 5 THEN ' ...' ELSE '' END AS missing_str,
  COALESCE(array_to_string(x[1:5], ' '), '') || CASE WHEN extra_count_int > 5 THEN ' ...' ELSE '' END AS extra_str FROM agg""",
    ),
    "bar_summary": (
        bar_summary,
        f"""WITH {A.SQL_PLANTED},
bars AS (SELECT p.* EXCLUDE (ts), date_trunc('minute', e.ts) AS ts FROM planted p JOIN events e ON e.event_id = p.event_id),
agg AS (SELECT symbol, date, count(*) AS bars, min(ts) AS low, max(ts) AS high, count(DISTINCT ts) AS labels, max(volume) AS v,
  arg_min(concat_ws('/', CAST(open AS VARCHAR), CAST(high AS VARCHAR), CAST(low AS VARCHAR), CAST(close AS VARCHAR)), struct_pack(t := ts, i := event_id)) AS ohlc
  FROM bars GROUP BY 1, 2)
SELECT symbol, date, bars, strftime(low, '%Y-%m-%d %H:%M') AS first_bar, strftime(high, '%Y-%m-%d %H:%M') AS last_bar,
  date_diff('minute', low, high) + 1 - labels AS missing_minutes,
  CASE WHEN v >= 1e15 THEN 'unset' WHEN v <= 0 THEN 'zero_or_negative' ELSE 'present' END AS volume_info, ohlc AS first_bar_ohlc FROM agg""",
    ),
    "volume_class": (
        volume_class,
        f"""WITH {A.SQL_PLANTED}
SELECT CASE WHEN volume >= 1e15 THEN 'unset' WHEN volume <= 0 THEN 'zero_or_negative' ELSE 'present' END AS volume_info,
  CASE WHEN volume >= pow(2, 126) THEN '' WHEN volume = floor(volume) THEN CAST(CAST(volume AS BIGINT) AS VARCHAR) ELSE CAST(volume AS VARCHAR) END AS volume_text,
  count(*) AS n FROM planted GROUP BY 1, 2""",
    ),
    "candle_issues": (
        candle_issues,
        f"""WITH {A.SQL_PLANTED}
SELECT symbol, date, count(*) AS row_count_int, count(*) FILTER (least(open, high, low, close) <= 0 OR high < greatest(open, close, low)
  OR low > least(open, close, high)) AS price_issue_count_int FROM planted GROUP BY 1, 2""",
    ),
    "session_text": (
        session_text,
        f"""WITH {A.SQL_MINUTE_CALENDAR}, {A.SQL_PLANTED},
spans AS (SELECT date, first_ts, CASE WHEN date = DATE '2024-01-19' THEN date + INTERVAL 779 MINUTE ELSE last_ts END AS last_ts FROM cal),
{WRITTEN_BARS},
kept AS (SELECT b.* FROM bars b JOIN spans s ON s.date = b.date AND b.ts BETWEEN first_ts AND last_ts
  QUALIFY row_number() OVER (PARTITION BY symbol, b.ts ORDER BY event_id) = 1)
SELECT {WRITTEN_ROW} FROM kept""",
    ),
    "day_text": (
        day_text,
        f"""WITH {A.SQL_PLANTED}, {WRITTEN_BARS},
kept AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id) = 1)
SELECT {WRITTEN_ROW} FROM kept""",
    ),
}
