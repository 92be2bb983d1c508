"""Roll-ups, returns and alignment over hourly bars of the events table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from candlewright.operators import align as L, bars as B, checks as K
from candlewright.queries import adapters as A

PRICES = ["open", "high", "low", "close"]


def _rounded(frame, *keys):
    return frame.select(*keys, *[F.round(c, 4).alias(c) for c in [*PRICES, "volume"]], "bar_count_int")


def ohlcv_rollup(spark, sf_dir):
    """Hourly bars per event type from single events."""
    rolled = B.ohlcv_rollup(A.event_bars(spark, sf_dir, planted=True), ["symbol", "date", "ts"], "event_id")
    return _rounded(rolled, "symbol", A.text("ts").alias("hour"))


def ohlcv_rollup_daily(spark, sf_dir):
    """Daily bars from the hourly bars."""
    return _rounded(B.ohlcv_rollup(A.hourly_candles(spark, sf_dir), ["symbol", "date"]), "symbol", "date")


def daily_coverage(spark, sf_dir):
    bars = A.event_labels(spark, sf_dir)
    covered = B.daily_coverage(bars, ["symbol"])
    return covered.select("symbol", "date", A.text("min_timestamp").alias("min_timestamp"), A.text("max_timestamp").alias("max_timestamp"), "row_count")


def first_per_label(spark, sf_dir):
    """First event of every minute and type."""
    bars = A.event_bars(spark, sf_dir, step=60)
    first = B.first_per_label(bars, ["symbol", "ts"], "event_id", ["event_id", "close"])
    return first.select("symbol", A.text("ts").alias("minute"), "event_id", "close")


def _returns(spark, sf_dir):
    return B.bar_returns(A.hourly_candles(spark, sf_dir), A.HOUR)


def bar_returns(spark, sf_dir):
    return _returns(spark, sf_dir).select("symbol", "date", A.text("ts").alias("hour"), F.round("ret", 6).alias("ret"))


def _lags(spark, sf_dir):
    every = _returns(spark, sf_dir)
    return L.lag_corr(every.where(F.col("symbol") != "view"), every.where(F.col("symbol") == "view"), A.HOUR)


def lag_corr(spark, sf_dir):
    """Every type against 'view', lags -3..+3 hours, pooled over the days."""
    return _lags(spark, sf_dir).select("symbol", F.col("lag").cast("bigint").alias("lag"), "pairs", F.round("corr", 6).alias("corr"))


def lag_verdict(spark, sf_dir):
    found = L.lag_verdict(_lags(spark, sf_dir))
    return found.select(
        "symbol", F.col("best_lag").cast("bigint").alias("best_lag"), "pairs", F.round("best_corr", 6).alias("best_corr"),
        F.round("zero_corr", 6).alias("zero_corr"), "verdict",
    )


def edge_bars(spark, sf_dir):
    """First and last three bars of every type and day."""
    edges = B.edge_bars(A.hourly_candles(spark, sf_dir))
    return edges.select("symbol", "date", "edge", F.col("position").cast("bigint").alias("position"), A.text("ts").alias("hour"), *PRICES)


def _session_hours(spark, sf_dir):
    return K.in_session(A.hourly_candles(spark, sf_dir), A.calendar(spark, hourly=True))


def _weekday_dailies(spark, sf_dir, gaps=False):
    """Daily bars over the whole day, on weekdays (holidays included); ``gaps`` plants one at every seventh day of the year."""
    rolled = B.ohlcv_rollup(A.hourly_candles(spark, sf_dir), ["symbol", "date"]).where(F.weekday("date") < 5)
    return (rolled.where(F.dayofyear("date") % 7 != 0) if gaps else rolled).withColumn("pos", F.lit(0))


def daily_vs_minute(spark, sf_dir):
    """Whole-day bars against the roll-up of the session hours."""
    both = L.daily_vs_minute(_session_hours(spark, sf_dir), _weekday_dailies(spark, sf_dir), "ts", "pos")
    return both.select("symbol", "date", *[F.round(c, 4).alias(c) for c in both.columns[2:]])


def _packed(first, *others):
    """Keys in one number of fixed width (18 digits and those given), so that the aggregate over it needs no sort."""
    value = F.col(first).cast("decimal(38,0)")
    for name, digits in others:
        value = (value * F.lit(Decimal(10) ** digits) + F.col(name).cast("decimal(18,0)")).cast("decimal(38,0)")
    return value


def order_vs_lines(spark, sf_dir):
    """Two grains of one table: order totals of a status and date against the lines of those orders."""
    orders = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("symbol"), F.to_date("o_orderdate").alias("date"), "o_totalprice"
    )
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice")
    minute = joined.select(
        "symbol", "date", _packed("l_orderkey", ("l_linenumber", 4), ("l_partkey", 9), ("l_suppkey", 7)).alias("pos"),
        *[price.alias(c) for c in PRICES], F.col("l_quantity").alias("volume"),
    )
    total = F.col("o_totalprice")
    daily = orders.select("symbol", "date", F.col("o_orderkey").alias("pos"), *[total.alias(c) for c in PRICES], F.lit(100.0).alias("volume"))
    both = L.daily_vs_minute(minute, daily, "pos", "pos")
    return both.select("symbol", "date", *[F.round(c, 4).alias(c) for c in both.columns[2:]])


def _checks(spark, sf_dir):
    return L.alignment_check(_session_hours(spark, sf_dir), _weekday_dailies(spark, sf_dir, gaps=True), "pos")


FLAGS = ["open_equals_first", "close_equals_last", "high_equals_max", "low_equals_min"]


def alignment_check(spark, sf_dir):
    checks = _checks(spark, sf_dir)
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FLAGS}
    return checks.select(*[shown.get(c, F.col(c)).alias(c) for c in checks.columns])


def check_verdict(spark, sf_dir):
    return L.check_verdict(_checks(spark, sf_dir))


def verdict_lines(spark, sf_dir):
    """The alignment run as report lines: checks of every type, and its lag against 'view'."""
    return L.verdict_lines(_checks(spark, sf_dir), _lags(spark, sf_dir)).withColumn("line_no", F.col("line_no").cast("bigint"))


def last_common_dates(spark, sf_dir):
    """Newest ten dates with both an order and a shipment."""
    orders = A.order_dates(spark, sf_dir)
    shipped = A.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return L.last_common_dates(orders, shipped)


def holdout_guard(spark, sf_dir):
    """Rows per type before the cut-off date, and how many the guard keeps out."""
    events = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
    kept = L.before_cutoff(events, "2024-01-25").groupBy("symbol").agg(F.count(F.lit(1)).alias("kept"), F.max("date").alias("last_kept"))
    labelled = events.groupBy("symbol").agg(F.count_if(L.held_out(F.col("date"), "2024-01-25")).alias("held_out"))
    return kept.join(labelled, "symbol")


RETURNS = f"""WITH {A.SQL_HOURLY}, prev AS (SELECT *, lag(ts) OVER w AS pts, lag(close) OVER w AS pc FROM hourly WINDOW w AS (PARTITION BY symbol, date ORDER BY ts)),
rets AS (SELECT symbol, date, ts, ln(close) - ln(pc) AS ret FROM prev WHERE pts = ts - INTERVAL 1 HOUR AND close > 0 AND pc > 0)"""
LAG_PAIRS = """, lags AS (SELECT unnest(range(-3, 4)) AS lag),
pairs AS (SELECT i.symbol, l.lag, i.ret AS a, v.ret AS b FROM rets i CROSS JOIN lags l
  JOIN rets v ON v.symbol = 'view' AND v.date = i.date AND v.ts = i.ts + l.lag * INTERVAL 1 HOUR WHERE i.symbol <> 'view'),
corrs AS (SELECT symbol, lag, count(*) AS pairs, CASE WHEN count(*) >= 100 THEN corr(a, b) END AS corr FROM pairs GROUP BY 1, 2),
full_corrs AS (SELECT s.symbol, l.lag, COALESCE(pairs, 0) AS pairs, corr FROM (SELECT DISTINCT symbol FROM rets WHERE symbol <> 'view') s CROSS JOIN lags l
  LEFT JOIN corrs c ON c.symbol = s.symbol AND c.lag = l.lag)"""
SIDES = f"""WITH {A.SQL_HOURLY}, {A.SQL_HOUR_CALENDAR},
mins AS (SELECT h.* FROM hourly h JOIN cal c ON c.date = h.date AND h.ts BETWEEN first_ts AND last_ts),
daily AS (SELECT symbol, date, arg_min(open, ts) AS o, max(high) AS h, min(low) AS l, arg_max(close, ts) AS c, sum(volume) AS v FROM hourly
  WHERE isodow(date) < 6 GROUP BY 1, 2),
mday AS (SELECT symbol, date, count(*) AS n, arg_min(open, ts) AS o, max(high) AS h, min(low) AS l, arg_max(close, ts) AS c, sum(volume) AS v,
  min(ts) AS lo, max(ts) AS hi FROM mins GROUP BY 1, 2)"""
CHECKS = SIDES.replace("isodow(date) < 6", "isodow(date) < 6 AND dayofyear(date) % 7 <> 0") + """, hits AS (SELECT m.symbol, m.date, min(m.ts) FILTER (abs(m.open - d.o) <= 0.005) AS oh, max(m.ts) FILTER (abs(m.close - d.c) <= 0.005) AS ch
  FROM mins m JOIN daily d ON d.symbol = m.symbol AND d.date = m.date GROUP BY 1, 2),
checks AS (SELECT COALESCE(m.symbol, d.symbol) AS symbol, COALESCE(m.date, d.date) AS date,
  concat_ws(' ', CASE WHEN d.symbol IS NULL THEN 'no daily bar' END, CASE WHEN m.symbol IS NULL THEN 'no minute bars' END) AS note,
  COALESCE(n, 0) AS minute_bars, d.symbol IS NOT NULL AND m.symbol IS NOT NULL AS u, lo, hi, oh, ch, d.o AS dop, m.o AS mop, d.c AS dcl, m.c AS mcl,
  d.h AS dhi, m.h AS mhi, d.l AS dlo, m.l AS mlo
  FROM mday m FULL JOIN daily d ON d.symbol = m.symbol AND d.date = m.date LEFT JOIN hits t ON t.symbol = m.symbol AND t.date = m.date),
shown AS (SELECT symbol, date, note, minute_bars, CASE WHEN u THEN strftime(lo, '%Y-%m-%d %H:%M') ELSE '' END AS first_bar,
  CASE WHEN u THEN strftime(hi, '%Y-%m-%d %H:%M') ELSE '' END AS last_bar, CASE WHEN u THEN dop END AS daily_open, CASE WHEN u THEN mop END AS first_bar_open,
  CASE WHEN u THEN abs(dop - mop) <= 0.005 END AS open_equals_first, COALESCE(CASE WHEN u THEN strftime(oh, '%Y-%m-%d %H:%M') END, '') AS open_match_bar,
  CASE WHEN u THEN dcl END AS daily_close, CASE WHEN u THEN mcl END AS last_bar_close, CASE WHEN u THEN abs(dcl - mcl) <= 0.005 END AS close_equals_last,
  COALESCE(CASE WHEN u THEN strftime(ch, '%Y-%m-%d %H:%M') END, '') AS close_match_bar, CASE WHEN u THEN dhi END AS daily_high, CASE WHEN u THEN mhi END AS minute_max_high,
  CASE WHEN u THEN abs(dhi - mhi) <= 0.005 END AS high_equals_max, CASE WHEN u THEN dlo END AS daily_low, CASE WHEN u THEN mlo END AS minute_min_low,
  CASE WHEN u THEN abs(dlo - mlo) <= 0.005 END AS low_equals_min FROM checks)
"""
PAIR_COLUMNS = ", ".join(
    f"round(d.{k}, 4) AS daily_{n}, round(m.{k}, 4) AS minute_{n}" for k, n in zip("ohlcv", ("open", "high", "low", "close", "volume"))
)

REPORTS = {
    "ohlcv_rollup": (
        ohlcv_rollup,
        f"""WITH {A.SQL_PLANTED} SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS hour, round(arg_min(open, event_id), 4) AS open, round(max(high), 4) AS high,
  round(min(low), 4) AS low, round(arg_max(close, event_id), 4) AS close, round(sum(volume), 4) AS volume, count(*) AS bar_count_int
FROM planted GROUP BY symbol, ts""",
    ),
    "ohlcv_rollup_daily": (
        ohlcv_rollup_daily,
        f"""WITH {A.SQL_HOURLY} SELECT symbol, date, round(arg_min(open, ts), 4) AS open, round(max(high), 4) AS high, round(min(low), 4) AS low,
  round(arg_max(close, ts), 4) AS close, round(sum(volume), 4) AS volume, count(*) AS bar_count_int FROM hourly GROUP BY 1, 2""",
    ),
    "daily_coverage": (
        daily_coverage,
        """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, strftime(date_trunc('minute', min(ts)), '%Y-%m-%d %H:%M:%S') AS min_timestamp,
  strftime(date_trunc('minute', max(ts)), '%Y-%m-%d %H:%M:%S') AS max_timestamp, count(*) AS row_count FROM events GROUP BY 1, 2""",
    ),
    "first_per_label": (
        first_per_label,
        """SELECT event_type AS symbol, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, min(event_id) AS event_id,
  arg_min(value, event_id) AS close FROM events GROUP BY 1, 2""",
    ),
    "bar_returns": (bar_returns, RETURNS + " SELECT symbol, date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS hour, round(ret, 6) AS ret FROM rets"),
    "lag_corr": (lag_corr, RETURNS + LAG_PAIRS + " SELECT symbol, lag, pairs, round(corr, 6) AS corr FROM full_corrs"),
    "lag_verdict": (
        lag_verdict,
        RETURNS
        + LAG_PAIRS
        + """, best AS (SELECT *, first_value(corr) OVER (PARTITION BY symbol ORDER BY abs(lag)) AS zero_corr FROM full_corrs
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY abs(corr) DESC NULLS LAST, lag) = 1)
SELECT symbol, CASE WHEN corr IS NOT NULL THEN lag END AS best_lag, CASE WHEN corr IS NOT NULL THEN pairs END AS pairs, round(corr, 6) AS best_corr, round(zero_corr, 6) AS zero_corr,
  CASE WHEN corr IS NULL THEN 'too few pairs' WHEN lag = 0 OR abs(corr) - abs(zero_corr) < 0.03 THEN 'no shift' WHEN lag > 0 THEN 'shift +' || lag
  ELSE 'late by ' || (-lag) END AS verdict FROM best""",
    ),
    "edge_bars": (
        edge_bars,
        f"""WITH {A.SQL_HOURLY}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY ts) AS a, row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC) AS z FROM hourly)
SELECT symbol, date, 'first' AS edge, a AS position, strftime(ts, '%Y-%m-%d %H:%M:%S') AS hour, open, high, low, close FROM r WHERE a <= 3
UNION ALL SELECT symbol, date, 'last', z, strftime(ts, '%Y-%m-%d %H:%M:%S'), open, high, low, close FROM r WHERE z <= 3""",
    ),
    "daily_vs_minute": (
        daily_vs_minute,
        SIDES
        + f""" SELECT d.symbol, d.date, {PAIR_COLUMNS}, CASE WHEN m.v <> 0 THEN round(d.v / m.v, 4) END AS volume_ratio_float
FROM daily d JOIN mday m ON m.symbol = d.symbol AND m.date = d.date""",
    ),
    "order_vs_lines": (
        order_vs_lines,
        f"""WITH o AS (SELECT o_orderkey, o_orderstatus AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders),
l AS (SELECT symbol, date, l_extendedprice AS p, l_quantity AS q, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r
  FROM lineitem JOIN o ON l_orderkey = o_orderkey),
m AS (SELECT symbol, date, arg_min(p, r) AS o, max(p) AS h, min(p) AS l, arg_max(p, r) AS c, sum(q) AS v FROM l GROUP BY 1, 2),
d AS (SELECT symbol, date, arg_min(o_totalprice, o_orderkey) AS o, arg_min(o_totalprice, o_orderkey) AS h, arg_min(o_totalprice, o_orderkey) AS l,
  arg_min(o_totalprice, o_orderkey) AS c, 100.0 AS v FROM o GROUP BY 1, 2)
SELECT d.symbol, d.date, {PAIR_COLUMNS.replace('round(d.v, 4)', 'CAST(100 AS DOUBLE)')}, CASE WHEN m.v <> 0 THEN round(CAST(100 AS DOUBLE) / m.v, 4) END AS volume_ratio_float
FROM d JOIN m ON m.symbol = d.symbol AND m.date = d.date""",
    ),
    "alignment_check": (
        alignment_check,
        CHECKS + "SELECT * REPLACE (" + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '') AS {c}" for c in FLAGS) + ") FROM shown",
    ),
    "check_verdict": (
        check_verdict,
        CHECKS
        + """SELECT symbol, count(*) FILTER (first_bar <> '') AS session_count, count(*) FILTER (open_equals_first) AS open_matches, count(*) FILTER (close_equals_last) AS close_matches,
  count(*) FILTER (high_equals_max) AS high_matches, count(*) FILTER (low_equals_min) AS low_matches,
  array_to_string(list_sort(list(DISTINCT right(first_bar, 5)) FILTER (first_bar <> '')), ' ') AS first_labels,
  array_to_string(list_sort(list(DISTINCT right(last_bar, 5)) FILTER (first_bar <> '')), ' ') AS last_labels,
  array_to_string(list_sort(list(DISTINCT right(open_match_bar, 5)) FILTER (first_bar <> '')), ' ') AS open_labels,
  array_to_string(list_sort(list(DISTINCT right(close_match_bar, 5)) FILTER (first_bar <> '')), ' ') AS close_labels FROM shown GROUP BY 1""",
    ),
    "last_common_dates": (
        last_common_dates,
        """SELECT date FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem) ORDER BY date DESC LIMIT 10""",
    ),
    "holdout_guard": (
        holdout_guard,
        """SELECT event_type AS symbol, count(*) FILTER (ts < TIMESTAMP '2024-01-25') AS kept, max(CAST(ts AS DATE)) FILTER (ts < TIMESTAMP '2024-01-25') AS last_kept,
  count(*) FILTER (ts >= TIMESTAMP '2024-01-25') AS held_out FROM events GROUP BY 1""",
    ),
}

REPORTS["verdict_lines"] = (
    verdict_lines,
    f"""WITH c AS ({REPORTS["check_verdict"][1]}), v AS ({REPORTS["lag_verdict"][1]}),
lines AS (SELECT c.symbol, CASE WHEN session_count = 0 THEN ['no session with both daily and intraday bars'] ELSE [
    session_count || ' sessions: open ' || open_matches || ', close ' || close_matches || ', high ' || high_matches || ', low ' || low_matches || ' agree',
    'first labels [' || first_labels || '], daily open at [' || open_labels || ']; last labels [' || last_labels || '], daily close at [' || close_labels || ']',
    COALESCE('strongest at lag ' || CASE WHEN best_lag >= 0 THEN '+' ELSE '' END || best_lag || ': ' || printf('%+.3f', best_corr) || ' -> ' || verdict, 'too few pairs')
  ] END AS line FROM c LEFT JOIN v USING (symbol))
SELECT symbol, unnest(range(len(line))) AS line_no, unnest(line) AS line FROM lines""",
)
