"""Add-only merge of checked staging days into the raw zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewright import schema as S
from candlewright.functions import periods as P, times as T, values as V
from candlewright.operators import gates as G, merge as M
from candlewright.plans import publish as PB, zone as Z
from candlewright.session import run_folder
from candlewright.sources import sinks

ADDED = "added"


def typed(rows: DataFrame) -> DataFrame:
    """Zone rows as checkable bars: numbers out of the text cells, the date from the day period."""
    numbers = [V.number(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    return rows.select("symbol", "period", P.first_date(F.col("period")).alias("date"), "ts", *numbers)


def raw_dates(spark: SparkSession, raw: str, days: list[str]) -> DataFrame:
    """(symbol, date) pairs of the raw zone between the first and last staged day.

    Only periods that meet the span are read, and of those only symbol and instant.
    """
    low, high = min(days), max(days)
    covering = [p for p in Z.periods(spark, raw) if p.ljust(8, "0") <= high and p.ljust(8, "9") >= low]
    if not covering:
        return spark.createDataFrame([], "symbol string, date date")
    rows = Z.read_zone(spark, raw, covering).select("symbol", T.wall_date(F.col("ts")).alias("date"))
    return rows.where(F.col("date").between(F.to_date(F.lit(low), "yyyyMMdd"), F.to_date(F.lit(high), "yyyyMMdd"))).distinct()


def _kept(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """Write a small plan once, so that report, append and log all see the same decisions."""
    path = run_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def _pairs(accepted: DataFrame) -> DataFrame:
    return accepted.select("symbol", F.date_format("date", "yyyyMMdd").alias("period"))


def _write_accepted(spark: SparkSession, rows: DataFrame, accepted: DataFrame, raw: str) -> str:
    """Whole accepted days beside the zone, verified against the staging rows."""
    chosen = rows.join(_pairs(accepted), ["symbol", "period"], "left_semi")
    scratch = Z.beside(raw, "adding")
    Z.write_zone(chosen, scratch, "errorifexists")
    written = Z.read_zone(spark, scratch)
    balance = chosen.select("symbol", "ts", F.lit(1).alias("n")).unionByName(written.select("symbol", "ts", F.lit(-1).alias("n")))
    off = balance.groupBy("symbol", "ts").agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    if not off.isEmpty():
        Z.clear(spark, scratch)
        raise OSError("verification of the days to add failed; raw is as it was")
    return scratch


def _append_accepted(spark: SparkSession, rows: DataFrame, accepted: DataFrame, raw: str) -> DataFrame:
    """Add whole accepted days to raw, all of them or none. Returns the (symbol, period) pairs."""
    scratch = _write_accepted(spark, rows, accepted, raw)
    PB.publish(spark, Z.added_files(spark, scratch, raw), [raw], [scratch, Z.stats_path(scratch)])
    return _pairs(accepted)


def merge_minutes(
    spark: SparkSession,
    staging: str,
    raw: str,
    calendar: DataFrame | None,
    apply: bool = False,
    include_partial: bool = False,
    bad_tick: Column | None = None,
    log_path: str | None = None,
    index_rule: bool = False,
    step_seconds: int = 60,
) -> DataFrame | None:
    """One decision per staged (symbol, day); with ``apply`` the accepted days are appended to raw.

    Raw rows are never replaced and a day raw already has is never added, so a second run adds
    nothing. Added days then leave staging: a period as it was staged goes to the folder of merged ones,
    and what was not accepted stays. ``calendar`` holds closed sessions; the index rule needs none.

    Adding to raw, leaving staging and the log are one set of moves: a run that is lost between two of them
    is completed by the next one.
    """
    PB.recover(spark, raw, staging)
    days = [p for p in Z.periods(spark, staging) if len(p) == 8]
    if not days:
        return None
    rows = Z.read_zone(spark, staging, days)
    present = raw_dates(spark, raw, days)
    if index_rule:
        decisions = G.merge_gate_index(typed(rows), present, include_partial, step_seconds=step_seconds)
    else:
        decisions = G.merge_gate(typed(rows), present, calendar, include_partial, bad_tick, step_seconds)
    decisions = decisions.withColumn("file_name_str", P.file_name(F.date_format("date", "yyyyMMdd")))
    if not apply:
        return decisions
    decided = _kept(spark, decisions, "decisions")
    accepted = decided.where(F.col("decision_str") == G.ADD)
    done = decided.withColumn("decision_str", F.when(F.col("decision_str") == G.ADD, F.lit(ADDED)).otherwise(F.col("decision_str")))
    if not accepted.isEmpty():
        adding = _write_accepted(spark, rows, accepted, raw)
        rest, moves = Z.without_rows(spark, staging, _pairs(accepted), Z.beside(staging, "merged"))
        moves, spent = Z.added_files(spark, adding, raw) + moves, [adding, Z.stats_path(adding), *rest]
        if log_path is not None:
            logged = _staged_log(done.where(F.col("decision_str") == ADDED), log_path, index_rule)
            moves, spent = moves + PB.file_moves(spark, logged, log_path), [*spent, logged]
        PB.publish(spark, moves, [raw, staging], spent)
    return done


def _staged_log(added: DataFrame, path: str, index_rule: bool) -> str:
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    named = added.withColumn("merged_at_utc", stamp).withColumn("staging_file_str", F.col("file_name_str")).withColumn("raw_file_str", F.col("file_name_str"))
    if index_rule:
        rows = named.withColumn("bar_kind", F.lit("1min")).withColumn("file_str", F.col("file_name_str")).withColumn("conflict_minute_count_int", F.lit(0))
        return sinks.stage_log(rows, path, S.INDEX_MERGE_LOG_COLUMNS)
    # The date column alone does not name a series here, so the symbol leads it.
    return sinks.stage_log(named.withColumnRenamed("check_status_str", "status_str"), path, ["symbol", *S.MERGE_LOG_COLUMNS])


def merge_daily(spark: SparkSession, staging: str, raw: str, apply: bool = False, log_path: str | None = None) -> DataFrame | None:
    """Merge staged daily periods into the raw periods of the same name; rows already in raw win.

    A (symbol, period) with a price issue or a repeated date is skipped as a whole.
    """
    PB.recover(spark, raw, staging)
    names = Z.periods(spark, staging)
    if not names:
        return None
    rows = Z.read_zone(spark, staging, names)
    decisions = _kept(spark, G.merge_gate_daily(typed(rows), ["symbol", "period"]), "daily-decisions")
    accepted = decisions.where(F.col("decision_str") == G.MERGE).select("symbol", "period")
    passed = accepted.select("symbol", F.col("period").alias("target"))
    # Positions are taken from the scan itself, before any shuffle.
    chosen = Z.stack(rows, F.col("period"), F.lit(1)).join(passed, ["symbol", "target"], "left_semi")
    stacked = chosen
    present = Z.periods(spark, raw)
    if present:
        stored = Z.read_zone(spark, raw, names)
        stacked = Z.stack(stored, F.col("period"), F.lit(0)).unionByName(chosen, allowMissingColumns=True).fillna("")
    stacked = stacked.join(passed.select("target").distinct(), "target", "left_semi")
    conflicts = _kept(spark, M.merge_stats(stacked, Z.KEYS, ["target", "symbol"]), "daily-conflicts")
    outcome = Z.merge_into(spark, raw, stacked, {}, apply)
    per_target = outcome.select(F.col("target_str").alias("period"), "status_str", "message_str")
    counted = conflicts.select(F.col("target").alias("period"), "symbol", F.col("conflict_minute_count").alias("conflict_minute_count_int"))
    result = decisions.join(per_target, "period", "left").join(counted, ["period", "symbol"], "left")
    status = F.col("status_str")
    text = (
        F.when(F.col("decision_str") != G.MERGE, F.col("decision_str"))
        .when(status == "dry_run", F.lit(G.MERGE))
        .when(status == "merged", F.lit("merged"))
        .otherwise(F.concat(F.lit("skip: "), status, F.lit(" ("), "message_str", F.lit(")")))
    )
    final = _kept(
        spark,
        result.select(
            "symbol", F.lit("daily").alias("bar_kind"), P.file_name(F.col("period")).alias("file_name_str"), "row_count_int",
            F.lit(0).cast("bigint").alias("missing_count_int"), "price_issue_count_int", F.col("period").isin(present).alias("in_raw_bool"),
            text.alias("decision_str"), F.coalesce("conflict_minute_count_int", F.lit(0)).alias("conflict_minute_count_int"),
        ),
        "daily-result",
    )
    if apply and log_path is not None:
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
        merged = final.where(F.col("decision_str") == "merged").withColumn("merged_at_utc", stamp).withColumn("status_str", F.lit("complete"))
        for name in ("file_str", "staging_file_str", "raw_file_str"):
            merged = merged.withColumn(name, F.col("file_name_str"))
        sinks.append_log(merged, log_path, S.INDEX_MERGE_LOG_COLUMNS)
    return final
