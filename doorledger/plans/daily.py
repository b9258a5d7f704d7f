"""Daily job: check for data, summarise the day, write the report, find expired objects."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from doorledger.operators.summary import daily_summary
from doorledger.sources import lake


def yesterday() -> str:
    return (datetime.now(timezone.utc) - timedelta(days=1)).strftime("%Y-%m-%d")


def process_day(spark: SparkSession, lake_base: str, report_base: str, date: str) -> DataFrame:
    """Summarise one day and replace its report. A day without data gives zeros."""
    summary = daily_summary(lake.read_access_logs(spark, lake_base, date), date)
    lake.write_daily_summary(summary, report_base)
    return lake.read_daily_summaries(spark, report_base).where(f"date = '{date}'")


def run_daily(spark: SparkSession, lake_base: str, report_base: str, date: str | None = None,
              now: str | None = None, retention_days: int = 90,
              delete_expired: bool = False) -> DataFrame | None:
    """The whole chain; None when the day has no data (everything after is skipped)."""
    date = date or yesterday()
    if not lake.day_has_data(spark, lake_base, date):
        return None
    report = process_day(spark, lake_base, report_base, date)
    now = now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    if delete_expired:
        lake.expire_objects(spark, report_base, now, retention_days)
    else:
        lake.apply_retention(lake.retention_candidates(lake.list_objects(spark, report_base), now, retention_days))
    return report
