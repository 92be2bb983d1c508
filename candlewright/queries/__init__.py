"""Runnable reports over the shared test tables, each next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlewright.session import in_utc

Report = Callable[[SparkSession, str], DataFrame]


def load() -> tuple[dict[str, Report], dict[str, str]]:
    from candlewright.queries import align_q, apply_q, calendar_q, checks_q, coverage_q, jobs_q, layout_q, logs_q, merge_q, stream_q, zones_q

    reports: dict[str, Report] = {}
    sql: dict[str, str] = {}
    for module in (checks_q, calendar_q, coverage_q, align_q, merge_q, layout_q, zones_q, logs_q, jobs_q, apply_q, stream_q):
        for name, (report, statement) in module.REPORTS.items():
            reports[name] = _pinned(report)
            if statement is not None:
                sql[name] = statement
    return reports, sql


def _pinned(report: Report) -> Report:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(in_utc(spark), sf_dir)

    run.__name__ = report.__name__
    run.__doc__ = report.__doc__
    return run
