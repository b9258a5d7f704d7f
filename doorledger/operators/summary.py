"""Counts over access logs: the daily summary and the breakdowns behind the service counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed value: default histogram edges of the metrics client, in seconds
LATENCY_EDGES = (.005, .01, .025, .05, .075, .1, .25, .5, .75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _distinct_with_null(col: str) -> Column:
    """Distinct values where null is a value of its own (``distinct().count()``)."""
    return F.count_distinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))


def _summary_aggs() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("action") == "prediction").alias("total_predictions"),
            _distinct_with_null("user_id").cast("bigint").alias("unique_users")]


def daily_summary(logs: DataFrame, date: str) -> DataFrame:
    """One row for one day's logs, in one pass; an empty day gives zeros."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return logs.agg(*_summary_aggs()).select(
        F.lit(date).alias("date"), now.alias("processed_at"),
        "total_events", "total_predictions", "unique_users")


def summary_by_day(logs: DataFrame, ts: str = "event_ts") -> DataFrame:
    """The same figures for every day present."""
    day = F.date_format(ts, "yyyy-MM-dd").alias("date")
    return logs.groupBy(day).agg(*_summary_aggs())


def status_counts(logs: DataFrame, status: str = "prediction_status") -> DataFrame:
    return logs.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def request_counts(requests: DataFrame, method: str = "method", endpoint: str = "endpoint",
                   status: str = "status") -> DataFrame:
    return requests.groupBy(method, endpoint, status).agg(F.count(F.lit(1)).alias("n"))


def detection_counts(detections: DataFrame, detected: str = "detected") -> DataFrame:
    """Counts by flag; "True"/"true" text and booleans are one flag."""
    flag = F.lower(F.col(detected).cast("string")) == "true"
    return detections.groupBy(flag.alias("detected")).agg(F.count(F.lit(1)).alias("n"))


def latency_histogram(df: DataFrame, keys: Sequence[str], seconds: str,
                      edges: Sequence[float] = LATENCY_EDGES) -> DataFrame:
    """Cumulative buckets per key: rows (keys, le, n) plus total count and sum of seconds.

    One aggregate column per edge, unpivoted after the aggregation, so rows are not
    multiplied before the shuffle. ``le`` of the last bucket is infinity.
    """
    v = F.col(seconds)
    aggs = [F.count_if(v <= F.lit(float(e))).alias(f"_b{i}") for i, e in enumerate(edges)]
    agg = df.groupBy(*keys).agg(*aggs, F.count(v).alias("total"), F.sum(v).alias("sum"))
    buckets = F.array(*[F.struct(F.lit(float(e)).alias("le"), F.col(f"_b{i}").alias("n"))
                        for i, e in enumerate(edges)],
                      F.struct(F.lit(float("inf")).alias("le"), F.col("total").alias("n")))
    return (agg.select(*keys, "total", "sum", F.explode(buckets).alias("_b"))
            .select(*keys, "_b.le", "_b.n", "total", "sum"))


def attendance_report(logs: DataFrame, user: str = "user_id", ts: str = "event_ts") -> DataFrame:
    """Per day and known user: first and last successful event and their number."""
    ok = logs.where((F.col("prediction_status") == "success")
                    & (F.coalesce(user, F.lit("anonymous")) != "anonymous"))
    return ok.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("date"), user).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
        F.count(F.lit(1)).alias("events"))


def confidence_trend(logs: DataFrame, user: str = "user_id", ts: str = "event_ts") -> DataFrame:
    """Per user and day: mean, lowest and highest confidence, and the change of the mean
    since the user's previous day. The window runs over one row per day."""
    daily = (logs.where(F.col("confidence").isNotNull())
             .groupBy(user, F.date_format(ts, "yyyy-MM-dd").alias("date"))
             .agg(F.avg("confidence").alias("avg_confidence"),
                  F.min("confidence").alias("min_confidence"),
                  F.max("confidence").alias("max_confidence")))
    w = Window.partitionBy(user).orderBy("date")
    return daily.withColumn("change", F.col("avg_confidence") - F.lag("avg_confidence").over(w))
