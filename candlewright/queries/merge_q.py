"""Merges and gates over the events table, split into sources by ``event_id % 3``."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import times as T
from candlewright.operators import align as L, calendar as C, coverage as V, gates as G, merge as M
from candlewright.queries import adapters as A

VALUES = ["open", "high", "low", "close", "volume"]


def _sources(spark, sf_dir):
    """Three sources with text cells; minutes overlap between and inside them."""
    bars = A.event_bars(spark, sf_dir, step=60).select("symbol", "ts", *VALUES, "event_id")
    return [bars.where(F.pmod("event_id", F.lit(3)) == part) for part in range(3)]


def merge_existing_wins(spark, sf_dir):
    """One row per minute and type: the first source wins, then the order inside the source."""
    sources = _sources(spark, sf_dir)
    sources[1] = sources[1].withColumn("note", F.lit("second"))
    merged = M.merge_existing_wins(sources, order="event_id")
    return merged.select("symbol", A.text("ts").alias("minute"), F.col("close").cast("double").alias("close"), "note")


def _stacked(spark, sf_dir):
    return M.stack_sources(_sources(spark, sf_dir), order="event_id")


def merge_conflicts(spark, sf_dir):
    found = M.merge_conflicts(_stacked(spark, sf_dir))
    return found.select("symbol", A.text("ts").alias("minute"), "copies")


def merge_stats(spark, sf_dir):
    return M.merge_stats(_stacked(spark, sf_dir), by=["symbol"])


def merge_verify(spark, sf_dir):
    """Verification of a whole merge, and of a merge that lost its third source."""
    sources = _sources(spark, sf_dir)
    inputs = M.stack_sources(sources, order="event_id")
    good = M.merge_verify(inputs, M.merge_existing_wins(sources, order="event_id")).withColumn("case", F.lit("whole"))
    bad = M.merge_verify(inputs, M.merge_existing_wins(sources[:2], order="event_id")).withColumn("case", F.lit("lost source"))
    return good.unionByName(bad)


def kv_upsert(spark, sf_dir):
    """Last document of every user, where events after 20 January update the earlier ones."""
    events = A.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"), "event_id", "ts")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    return M.kv_upsert(events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut), order="event_id")


def _snapshot(spark, sf_dir):
    return A.table(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("week", F.col("ts").cast("timestamp")), "yyyyMMdd").alias("week"), "ts", "event_type", "value"
    )


def _snapshots(spark, sf_dir):
    """An old and a new state: a week that lost a type, a week that grew, one that is new, one unchanged."""
    rows = _snapshot(spark, sf_dir)
    old = rows.where(F.col("ts") < F.lit("2024-01-18").cast("timestamp_ntz"))
    new = rows.where(~((F.col("week") == "20240108") & (F.col("event_type") == "view")))
    return old, new


def snapshot_guard(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return M.snapshot_guard(old, new, ["week"])


def frames_equal(spark, sf_dir):
    """Equality as text of a table with itself re-read, and with a later state."""
    old, new = _snapshots(spark, sf_dir)
    same = M.frames_equal(_snapshot(spark, sf_dir), _snapshot(spark, sf_dir)).withColumn("case", F.lit("same"))
    return same.unionByName(M.frames_equal(old, new).withColumn("case", F.lit("changed")))


def row_count_delta(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return M.row_count_delta(old, new, ["week"])


def _raw_dates(spark, sf_dir):
    events = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
    return V.present_dates(events, last="2024-01-08")


def staged(spark, sf_dir):
    """Hourly bars with a broken candle where the last event of the hour has an id divisible by 97."""
    bars = A.event_bars(spark, sf_dir)
    rolled = bars.groupBy("symbol", "date", "ts").agg(
        F.min_by("open", "event_id").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "event_id").alias("close"), F.max("event_id").alias("last_id"),
    )
    return rolled.withColumn("high", F.when(F.pmod("last_id", F.lit(97)) == 0, F.col("low") - 1).otherwise(F.col("high")))


def _gate(spark, sf_dir):
    closed = C.closed_sessions(A.calendar(spark, hourly=True), T.instant_literal("2024-01-30 15:00:00"), step_seconds=A.HOUR)
    jump = F.col("close") > 100
    return G.merge_gate(staged(spark, sf_dir), _raw_dates(spark, sf_dir), closed, bad_tick=jump, step_seconds=A.HOUR)


def merge_gate(spark, sf_dir):
    """Decision of every staged day: present, not a session, broken candle, partial or add."""
    return _gate(spark, sf_dir)


def merge_gate_hist(spark, sf_dir):
    return G.decision_counts(_gate(spark, sf_dir), ["symbol"])


def merge_gate_index(spark, sf_dir):
    """The index rule over raw labels of events: duplicates block, core hours 09:00-15:00 count."""
    single = A.event_bars(spark, sf_dir, planted=True).where(~F.col("symbol").isin("view", "click"))
    rolled = staged(spark, sf_dir).where(F.col("symbol").isin("view", "click"))
    columns = ["symbol", "date", "ts", "open", "high", "low", "close"]
    return G.merge_gate_index(single.select(*columns).unionByName(rolled.select(*columns)), _raw_dates(spark, sf_dir), False, "09:00", "15:00", A.HOUR)


def merge_gate_daily(spark, sf_dir):
    """Files of daily bars (type and week): a broken candle or a repeated date blocks the file."""
    daily = L.first_daily(staged(spark, sf_dir).withColumn("volume", F.lit(1.0)), "ts")
    renamed = daily.select("symbol", "date", *[F.col(f"daily_{c}").alias(c) for c in ("open", "high", "low", "close")])
    files = renamed.select(
        "symbol", F.date_format(F.date_trunc("week", "date"), "yyyyMMdd").alias("label"), T.from_wall(F.col("date")).alias("ts"), "open", "high", "low", "close"
    )
    twice = files.where(F.col("label") == "20240115")
    return G.merge_gate_daily(files.unionByName(twice), ["symbol", "label"])


BARS = "bars AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, value AS close, event_id, event_id % 3 AS rank FROM events)"
SNAPSHOTS = """WITH rows_ AS (SELECT strftime(date_trunc('week', ts), '%Y%m%d') AS week, ts, event_type, value FROM events),
old AS (SELECT * FROM rows_ WHERE ts < TIMESTAMP '2024-01-18'), new AS (SELECT * FROM rows_ WHERE NOT (week = '20240108' AND event_type = 'view'))"""
STAGED = """staged AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts, arg_min(value, event_id) AS open,
  CASE WHEN max(event_id) % 97 = 0 THEN min(value) - 1 ELSE max(value) END AS high, min(value) AS low, arg_max(value, event_id) AS close FROM events GROUP BY 1, 2, 3)"""
BROKEN = "(least(open, high, low, close) <= 0 OR high < greatest(open, close, low) OR low > least(open, close, high))"
GATE = f"""WITH {A.SQL_HOUR_CALENDAR}, {STAGED}, open_cal AS (SELECT * FROM cal WHERE last_ts + INTERVAL 65 MINUTE <= TIMESTAMP '2024-01-30 15:00:00'),
day AS (SELECT s.symbol, s.date, any_value(c.n) AS n, count(*) AS bars, count(*) FILTER (s.ts BETWEEN c.first_ts AND c.last_ts) AS inside,
  count(*) FILTER ({BROKEN}) AS broken, count(*) FILTER (close > 100) AS jumps FROM staged s LEFT JOIN open_cal c ON c.date = s.date GROUP BY 1, 2),
gate AS (SELECT symbol, date, CASE WHEN n IS NULL THEN 'no_session' WHEN inside < n THEN 'partial' ELSE 'complete' END AS check_status_str, bars AS bar_count_int,
  CASE WHEN n IS NULL THEN 0 ELSE n - inside END AS missing_count_int, broken AS sanity_issue_count_int, jumps AS bad_tick_count_int, date <= DATE '2024-01-08' AS in_raw_bool,
  CASE WHEN date <= DATE '2024-01-08' THEN 'skip: date already in raw (raw data is never replaced)' WHEN n IS NULL THEN 'skip: not a closed NYSE session'
    WHEN broken > 0 THEN 'skip: candlestick sanity issues' WHEN inside < n THEN 'skip: partial (' || (n - inside) || ' missing minutes; use --include-partial)' ELSE 'add' END AS decision_str FROM day)"""

REPORTS = {
    "merge_existing_wins": (
        merge_existing_wins,
        f"""WITH {BARS} SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, close, CASE WHEN rank = 1 THEN 'second' ELSE '' END AS note FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY rank, event_id) = 1""",
    ),
    "merge_conflicts": (
        merge_conflicts,
        f"""WITH {BARS} SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, count(*) AS copies FROM bars GROUP BY symbol, ts HAVING count(DISTINCT close) > 1""",
    ),
    "merge_stats": (
        merge_stats,
        f"""WITH {BARS}, k AS (SELECT symbol, ts, count(*) AS n, count(DISTINCT close) AS d FROM bars GROUP BY 1, 2)
SELECT symbol, CAST(sum(n) AS BIGINT) AS input_row_count, count(*) AS output_row_count, CAST(sum(n) AS BIGINT) - count(*) AS duplicate_row_count,
  count(*) FILTER (d > 1) AS conflict_minute_count FROM k GROUP BY 1""",
    ),
    "merge_verify": (
        merge_verify,
        f"""WITH {BARS}, lost AS (SELECT count(*) AS n FROM (SELECT symbol, ts FROM bars GROUP BY 1, 2 HAVING min(rank) = 2))
SELECT 'whole' AS "case", CAST(0 AS BIGINT) AS lost_key_count, CAST(0 AS BIGINT) AS foreign_key_count, CAST(0 AS BIGINT) AS repeated_key_count, TRUE AS verified
UNION ALL SELECT 'lost source', n, 0, 0, n = 0 FROM lost""",
    ),
    "kv_upsert": (kv_upsert, "SELECT CAST(user_id AS VARCHAR) AS key, arg_max(props, event_id) AS value FROM events GROUP BY 1"),
    "snapshot_guard": (
        snapshot_guard,
        SNAPSHOTS
        + """, o AS (SELECT week, count(*) AS n FROM old GROUP BY 1), w AS (SELECT week, count(*) AS n FROM new GROUP BY 1),
diff AS (SELECT DISTINCT week FROM ((SELECT * FROM old EXCEPT ALL SELECT * FROM new) UNION ALL (SELECT * FROM new EXCEPT ALL SELECT * FROM old)))
SELECT w.week, COALESCE(o.n, 0) AS old_rows, w.n AS new_rows, CASE WHEN o.n IS NULL THEN 'write' WHEN w.week NOT IN (SELECT week FROM diff) THEN 'skip'
  WHEN w.n < o.n THEN 'error' ELSE 'overwrite' END AS action FROM w LEFT JOIN o ON o.week = w.week""",
    ),
    "frames_equal": (
        frames_equal,
        SNAPSHOTS
        + """ SELECT TRUE AS equal, 'same' AS "case" UNION ALL
SELECT NOT EXISTS ((SELECT * FROM old EXCEPT ALL SELECT * FROM new) UNION ALL (SELECT * FROM new EXCEPT ALL SELECT * FROM old)), 'changed'""",
    ),
    "row_count_delta": (
        row_count_delta,
        SNAPSHOTS
        + """, o AS (SELECT week, count(*) AS n FROM old GROUP BY 1), w AS (SELECT week, count(*) AS n FROM new GROUP BY 1)
SELECT COALESCE(o.week, w.week) AS week, COALESCE(o.n, 0) AS before_count, COALESCE(w.n, 0) AS after_count, COALESCE(w.n, 0) - COALESCE(o.n, 0) AS row_count_diff
FROM o FULL JOIN w ON o.week = w.week""",
    ),
    "merge_gate": (merge_gate, GATE + " SELECT * FROM gate"),
    "merge_gate_hist": (
        merge_gate_hist,
        GATE + " SELECT symbol, string_split(decision_str, ':')[1] AS decision, count(*) AS count FROM gate GROUP BY 1, 2",
    ),
    "merge_gate_index": (
        merge_gate_index,
        f"""WITH {A.SQL_PLANTED}, {STAGED},
bars AS (SELECT symbol, date, ts, open, high, low, close FROM planted WHERE symbol NOT IN ('view', 'click') UNION ALL
  SELECT symbol, date, ts, open, high, low, close FROM staged WHERE symbol IN ('view', 'click')),
day AS (SELECT symbol, date, count(*) AS n, count(DISTINCT ts) AS u, count(*) FILTER ({BROKEN}) AS broken, greatest(min(ts), date + INTERVAL 9 HOUR) AS lo,
  least(max(ts), date + INTERVAL 15 HOUR) AS hi FROM bars GROUP BY symbol, date),
gaps AS (SELECT d.symbol, d.date, count(*) AS missing FROM (SELECT symbol, date, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM day WHERE lo <= hi) d
  WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = d.symbol AND b.ts = d.ts) GROUP BY 1, 2),
j AS (SELECT d.*, COALESCE(missing, 0) AS m FROM day d LEFT JOIN gaps g ON g.symbol = d.symbol AND g.date = d.date)
SELECT symbol, date, CASE WHEN m > 0 THEN 'partial' ELSE 'complete' END AS status_str, n AS row_count_int, m AS missing_count_int, broken AS price_issue_count_int,
  n - u AS duplicate_count_int, date <= DATE '2024-01-08' AS in_raw_bool, CASE WHEN date <= DATE '2024-01-08' THEN 'skip: date already in raw (raw data is never replaced)'
    WHEN broken > 0 OR n > u THEN 'skip: ' || broken || ' price issue(s), ' || (n - u) || ' duplicate minute(s)'
    WHEN m > 0 THEN 'skip: partial (' || m || ' missing minutes; use --include-partial)' ELSE 'add' END AS decision_str FROM j""",
    ),
    "merge_gate_daily": (
        merge_gate_daily,
        f"""WITH {STAGED}, d AS (SELECT symbol, date, strftime(date_trunc('week', date), '%Y%m%d') AS label, arg_min(open, ts) AS open, arg_min(high, ts) AS high,
  arg_min(low, ts) AS low, arg_min(close, ts) AS close FROM staged GROUP BY 1, 2),
files AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE label = '20240115'),
agg AS (SELECT symbol, label, count(*) AS n, count(*) FILTER ({BROKEN}) AS p, count(*) - count(DISTINCT date) AS dup FROM files GROUP BY 1, 2)
SELECT symbol, label, n AS row_count_int, p AS price_issue_count_int, dup AS duplicate_count_int,
  CASE WHEN p > 0 OR dup > 0 THEN 'skip: ' || p || ' price issue(s), ' || dup || ' duplicate date(s)' ELSE 'merge' END AS decision_str FROM agg""",
    ),
}
