"""Analytics over attempt logs and probe results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewright.functions import values as V

PROBLEM_COLUMNS = ["status_str", "saved_bool", "error_code_int", "error_str"]


def with_outcome(attempts: DataFrame) -> DataFrame:
    """Whether an attempt is retried and whether its bars are saved."""
    args = (F.col("status_str"), F.col("attempt_int"), F.col("pacing_int"))
    return attempts.withColumn("retry_bool", V.wants_retry(*args)).withColumn("save_bool", V.wants_save(*args))


def log_problems(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last attempt of every request that did not end complete.

    An aggregate rather than a window: a request retried without end still combines on the map side.
    """
    last = F.max_by(F.struct(*PROBLEM_COLUMNS), order)
    return (
        log.groupBy(*keys)
        .agg(last.alias("last"))
        .select(*keys, *[F.col("last")[c].alias(c) for c in PROBLEM_COLUMNS])
        .where(F.col("status_str") != "complete")
    )


def status_counts(log: DataFrame, by: list[str], column: str = "status_str") -> DataFrame:
    return log.groupBy(*by, column).agg(F.count(F.lit(1)).alias("count"))


def with_diagnosis(rows: DataFrame) -> DataFrame:
    text = V.diagnosis(F.col("status"), F.col("error_code"), F.col("error_text"), F.col("bars"))
    return rows.withColumn("diagnosis", text)


def probe_symbol_summary(rows: DataFrame) -> DataFrame:
    """Per probed symbol: what was found, on how many sample requests, and permission errors.

    ``rows``: ``symbol, test, diagnosis, first_bar, row_id``; control symbols are left out.
    """
    ok = F.col("diagnosis") == V.DATA_RETURNED
    test = F.col("test")
    first_head = F.min_by("first_bar", F.when(test == "earliest_data", F.col("row_id")))
    return (
        rows.where(~F.col("symbol").contains("control"))
        .groupBy("symbol")
        .agg(
            (F.count_if((test == "contract_details") & ok) > 0).alias("contract_found"),
            first_head.alias("earliest"),
            F.count_if((test == "daily_bars") & ok).alias("daily_ok"),
            F.count_if(test == "daily_bars").alias("daily_total"),
            F.count_if((test == "minute_bars") & ok).alias("minute_ok"),
            F.count_if(test == "minute_bars").alias("minute_total"),
            F.count_if(test.endswith("_latest") & ok).alias("latest_ok"),
            F.count_if(test.endswith("_latest")).alias("latest_total"),
            F.count_if(F.col("diagnosis") == V.PERMISSION_MISSING).alias("permission_errors"),
        )
        .withColumn("earliest", F.when(F.coalesce("earliest", F.lit("")) == "", F.lit("unknown")).otherwise(F.col("earliest")))
    )


def probe_errors(rows: DataFrame) -> DataFrame:
    """Distinct errors of the requests that returned nothing, with their counts."""
    failed = rows.where((F.col("error_text") != "") & (F.col("diagnosis") != V.DATA_RETURNED))
    return failed.groupBy("error_code", "error_text").agg(F.count(F.lit(1)).alias("count"))


def probe_overall(rows: DataFrame) -> DataFrame:
    """One row: accepted end formats, and the conclusion about control, permissions and index data."""
    ok = F.col("diagnosis") == V.DATA_RETURNED
    control = F.col("symbol").contains("control")
    dated = ~control & F.col("test").isin("daily_bars", "minute_bars") & ok
    latest = ~control & F.col("test").endswith("_latest") & ok
    facts = rows.agg(
        F.count_if(control).alias("control_rows"),
        F.count_if(control & ok).alias("control_ok"),
        F.count_if(F.col("diagnosis") == V.PERMISSION_MISSING).alias("permission"),
        F.count_if(~control & ok).alias("index_ok"),
        F.count_if(dated).alias("dated_ok"),
        F.count_if(latest).alias("latest_ok"),
        # Formats come from a short fixed list.
        F.sort_array(F.collect_set(F.when(dated & (F.col("end_format") != "us_eastern"), F.col("end_format")))).alias("formats"),
    )
    conclusion = (
        F.when((F.col("control_rows") > 0) & (F.col("control_ok") < F.col("control_rows")), F.lit("control failed"))
        .when(F.col("permission") > 0, F.lit("permission missing"))
        .when(F.col("index_ok") == 0, F.lit("no index data"))
        .otherwise(F.lit("ok"))
    )
    return facts.select(
        F.array_join("formats", " ").alias("other_end_formats"),
        ((F.col("dated_ok") == 0) & (F.col("latest_ok") > 0)).alias("only_latest_works"),
        conclusion.alias("conclusion"),
    )
