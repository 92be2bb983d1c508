"""The events table read as an attempt log: the number inside ``props`` picks code, status and attempt."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.functions import values as V
from candlewright.operators import logs as G
from candlewright.queries import adapters as A


def _number():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _log(spark, sf_dir):
    k = F.col("k")
    kind = F.col("event_type")
    events = A.table(spark, sf_dir, "events").withColumn("k", _number())
    code = F.when(k < 40, 162).when(k < 55, k + 2080).when(k < 65, 354).when(k < 80, 200).when(k < 90, 321).otherwise(F.lit(None).cast("int"))
    text = (
        F.when(k >= 90, F.lit(""))
        .when(kind == "view", F.lit("Historical data query cancelled: Pacing violation"))
        .when(kind == "click", F.lit("HMDS query returned no data: X"))
        .when(kind == "signup", F.lit("No market data permissions for this exchange"))
        .otherwise(F.lit("Error validating request"))
    )
    return events.withColumn("error_code", code).withColumn("error_text", text)


def error_class(spark, sf_dir):
    """Class of every message, counted by code and kind."""
    log = _log(spark, sf_dir).where(F.col("error_code").isNotNull())
    label = V.error_class(F.col("error_code"), F.col("error_text"))
    return log.groupBy("event_type", F.col("error_code").cast("bigint").alias("error_code"), label.alias("error_class")).agg(F.count(F.lit(1)).alias("n"))


def _diagnosed(spark, sf_dir):
    log = _log(spark, sf_dir)
    label = V.error_class(F.col("error_code"), F.col("error_text"))
    status = F.when(F.col("error_code").isNull(), F.lit("complete")).when(F.col("k") == 70, F.lit("timeout")).otherwise(label)
    bars = F.when(F.col("k") >= 95, F.lit(0)).when(F.col("k") >= 90, F.lit(1)).otherwise(F.lit(0))
    rows = log.withColumn("status", status).withColumn("bars", bars)
    return G.with_diagnosis(rows)


def diagnosis(spark, sf_dir):
    return _diagnosed(spark, sf_dir).groupBy("event_type", "status", "diagnosis").agg(F.count(F.lit(1)).alias("n"))


def attempt_outcome(spark, sf_dir):
    """Retry and save decisions of every attempt."""
    k = F.col("k")
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("complete", "partial", "empty", "no_data", "error", "timeout", "pacing")]), F.pmod(k, F.lit(7)) + 1
    )
    rows = A.table(spark, sf_dir, "events").withColumn("k", _number()).select(
        "event_id", status.alias("status_str"), (F.pmod(k, F.lit(4)) + 1).alias("attempt_int"), F.pmod(k, F.lit(13)).alias("pacing_int")
    )
    return G.with_outcome(rows).select("event_id", "status_str", "retry_bool", "save_bool")


def log_problems(spark, sf_dir):
    """Last attempt per type and user that did not end complete."""
    log = _log(spark, sf_dir).select(
        F.col("event_type").alias("symbol"), F.lit("1min").alias("bar_kind"), F.col("user_id").cast("string").alias("label"),
        F.when(F.col("error_code").isNull(), F.lit("complete")).otherwise(V.error_class(F.col("error_code"), F.col("error_text"))).alias("status_str"),
        (F.col("k") >= 90).alias("saved_bool"), F.coalesce(F.col("error_code").cast("string"), F.lit("")).alias("error_code_int"),
        F.col("error_text").alias("error_str"), "event_id",
    )
    return G.log_problems(log, ["symbol", "bar_kind", "label"], "event_id")


def status_counts(spark, sf_dir):
    return G.status_counts(_diagnosed(spark, sf_dir), ["event_type"], "status")


def _probe(spark, sf_dir):
    """Users as probed symbols, every 25th one a control; the type picks the probe step."""
    rows = _diagnosed(spark, sf_dir)
    test = (
        F.when(F.col("event_type") == "view", "contract_details").when(F.col("event_type") == "click", "earliest_data")
        .when(F.col("event_type") == "signup", "daily_bars").when(F.col("event_type") == "error", "minute_bars").otherwise("minute_bars_latest")
    )
    user = F.col("user_id").cast("string")
    symbol = F.when(F.pmod("user_id", F.lit(25)) == 0, F.concat(user, F.lit(" (control)"))).otherwise(user)
    first = F.when(F.col("diagnosis") == V.DATA_RETURNED, F.date_format("ts", "yyyy-MM-dd HH:mm")).otherwise(F.lit(""))
    return rows.select(
        symbol.alias("symbol"), test.alias("test"), "diagnosis", F.col("error_code").cast("bigint").alias("error_code"), "error_text",
        V.hide_latest(test, first).alias("first_bar"), F.when(F.col("k") < 93, "us_eastern").otherwise("utc").alias("end_format"), F.col("event_id").alias("row_id"),
    )


def probe_verdict(spark, sf_dir):
    return G.probe_symbol_summary(_probe(spark, sf_dir))


def probe_errors(spark, sf_dir):
    return G.probe_errors(_probe(spark, sf_dir))


def probe_overall(spark, sf_dir):
    return G.probe_overall(_probe(spark, sf_dir))


LOG = """WITH raw AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
log AS (SELECT *, CASE WHEN k < 40 THEN 162 WHEN k < 55 THEN k + 2080 WHEN k < 65 THEN 354 WHEN k < 80 THEN 200 WHEN k < 90 THEN 321 END AS code,
  CASE WHEN k >= 90 THEN '' WHEN event_type = 'view' THEN 'Historical data query cancelled: Pacing violation' WHEN event_type = 'click' THEN 'HMDS query returned no data: X'
    WHEN event_type = 'signup' THEN 'No market data permissions for this exchange' ELSE 'Error validating request' END AS txt FROM raw),
classed AS (SELECT *, CASE WHEN code BETWEEN 2100 AND 2199 THEN 'info' WHEN code = 162 AND event_type = 'view' THEN 'pacing'
  WHEN code = 162 AND event_type = 'click' THEN 'no_data' ELSE 'error' END AS cls FROM log),
st AS (SELECT *, CASE WHEN code IS NULL THEN 'complete' WHEN k = 70 THEN 'timeout' ELSE cls END AS status, CASE WHEN k BETWEEN 90 AND 94 THEN 1 ELSE 0 END AS bars FROM classed),
diag AS (SELECT *, CASE WHEN status = 'complete' AND bars > 0 THEN 'data returned' WHEN status = 'complete' THEN 'completed with nothing returned'
  WHEN code = 354 OR event_type = 'signup' THEN 'market data permission missing'
  WHEN status = 'no_data' THEN 'no data for this window (before the history starts, or not offered for this data type)'
  WHEN status = 'pacing' THEN 'pacing violation (run the probe again later)' WHEN status = 'timeout' THEN 'no answer before the timeout'
  WHEN code = 200 THEN 'contract not found (symbol, security type or exchange)' ELSE 'IBKR error (see error_text)' END AS diagnosis FROM st)"""
PROBE = LOG + """, probe AS (SELECT CASE WHEN user_id % 25 = 0 THEN user_id || ' (control)' ELSE CAST(user_id AS VARCHAR) END AS symbol, user_id % 25 = 0 AS control,
  CASE event_type WHEN 'view' THEN 'contract_details' WHEN 'click' THEN 'earliest_data' WHEN 'signup' THEN 'daily_bars' WHEN 'error' THEN 'minute_bars' ELSE 'minute_bars_latest' END AS test,
  diagnosis, diagnosis = 'data returned' AS ok, code, txt, CASE WHEN diagnosis = 'data returned' AND event_type <> 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE '' END AS first_bar,
  CASE WHEN k < 93 THEN 'us_eastern' ELSE 'utc' END AS end_format, event_id FROM diag)"""

REPORTS = {
    "error_class": (
        error_class,
        LOG + " SELECT event_type, CAST(code AS BIGINT) AS error_code, cls AS error_class, count(*) AS n FROM classed WHERE code IS NOT NULL GROUP BY 1, 2, 3",
    ),
    "diagnosis": (diagnosis, LOG + " SELECT event_type, status, diagnosis, count(*) AS n FROM diag GROUP BY 1, 2, 3"),
    "attempt_outcome": (
        attempt_outcome,
        """WITH raw AS (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
a AS (SELECT event_id, (['complete', 'partial', 'empty', 'no_data', 'error', 'timeout', 'pacing'])[k % 7 + 1] AS status_str, k % 4 + 1 AS att, k % 13 AS pac FROM raw),
r AS (SELECT *, (status_str = 'pacing' AND pac < 10) OR (status_str NOT IN ('complete', 'pacing') AND att < 3) AS retry_bool FROM a)
SELECT event_id, status_str, retry_bool, status_str = 'complete' OR (status_str = 'partial' AND NOT retry_bool) AS save_bool FROM r""",
    ),
    "log_problems": (
        log_problems,
        LOG
        + """, last AS (SELECT * FROM classed QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1)
SELECT event_type AS symbol, '1min' AS bar_kind, CAST(user_id AS VARCHAR) AS label, cls AS status_str, k >= 90 AS saved_bool,
  COALESCE(CAST(code AS VARCHAR), '') AS error_code_int, txt AS error_str FROM last WHERE code IS NOT NULL""",
    ),
    "status_counts": (status_counts, LOG + " SELECT event_type, status, count(*) AS count FROM st GROUP BY 1, 2"),
    "probe_verdict": (
        probe_verdict,
        PROBE
        + """, heads AS (SELECT symbol, arg_min(first_bar, event_id) AS h FROM probe WHERE test = 'earliest_data' GROUP BY 1)
SELECT p.symbol, count(*) FILTER (test = 'contract_details' AND ok) > 0 AS contract_found, CASE WHEN COALESCE(any_value(h), '') = '' THEN 'unknown' ELSE any_value(h) END AS earliest,
  count(*) FILTER (test = 'daily_bars' AND ok) AS daily_ok, count(*) FILTER (test = 'daily_bars') AS daily_total, count(*) FILTER (test = 'minute_bars' AND ok) AS minute_ok,
  count(*) FILTER (test = 'minute_bars') AS minute_total, count(*) FILTER (test = 'minute_bars_latest' AND ok) AS latest_ok, count(*) FILTER (test = 'minute_bars_latest') AS latest_total,
  count(*) FILTER (diagnosis = 'market data permission missing') AS permission_errors
FROM probe p LEFT JOIN heads h ON h.symbol = p.symbol WHERE NOT control GROUP BY 1""",
    ),
    "probe_errors": (
        probe_errors,
        PROBE + " SELECT CAST(code AS BIGINT) AS error_code, txt AS error_text, count(*) AS count FROM probe WHERE txt <> '' AND NOT ok GROUP BY 1, 2",
    ),
    "probe_overall": (
        probe_overall,
        PROBE
        + """ SELECT COALESCE(array_to_string(list_sort(list(DISTINCT end_format) FILTER (NOT control AND ok AND test IN ('daily_bars', 'minute_bars') AND end_format <> 'us_eastern')), ' '), '') AS other_end_formats,
  count(*) FILTER (NOT control AND ok AND test IN ('daily_bars', 'minute_bars')) = 0 AND count(*) FILTER (NOT control AND ok AND test = 'minute_bars_latest') > 0 AS only_latest_works,
  CASE WHEN count(*) FILTER (control) > 0 AND count(*) FILTER (control AND NOT ok) > 0 THEN 'control failed'
    WHEN count(*) FILTER (diagnosis = 'market data permission missing') > 0 THEN 'permission missing'
    WHEN count(*) FILTER (NOT control AND ok) = 0 THEN 'no index data' ELSE 'ok' END AS conclusion FROM probe""",
    ),
}
