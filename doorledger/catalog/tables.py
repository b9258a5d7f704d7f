"""Driver tables read as this library's inputs, and the same adaptation in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.functions import events as ev
from doorledger.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def access_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as flat access-log events.

    Errors become failed matches of an anonymous user, sign-ups another action, and the
    number in ``props`` a source address.
    """
    e = table(spark, sf_dir, "events")
    return with_log_columns(e)


def with_log_columns(e: DataFrame) -> DataFrame:
    failed = F.col("event_type") == "error"
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("ingest_seq"),
        F.when(failed, ev.ANONYMOUS).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") == "signup", "registration").otherwise("prediction")
        .alias("action"),
        F.concat(F.lit("ip_"), F.get_json_object("props", "$.k")).alias("source_ip"),
        F.when(failed, "no_match").otherwise("success").alias("prediction_status"),
        F.when(failed, F.lit(None)).otherwise(F.col("user_id").cast("string"))
        .alias("matched_user"),
        F.col("value").alias("processing_time_ms"),
        (F.col("value") / 500).alias("confidence"),
        F.col("event_id").cast("string").alias("prediction_id"),
        ev.iso_text(ts).alias("timestamp"), ts.alias("event_ts"),
        ev.event_millis(ts).alias("event_ms"))


LOGS_SQL = """
logs AS (
  SELECT event_id AS ingest_seq,
         CASE WHEN event_type = 'error' THEN 'anonymous'
              ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_type = 'signup' THEN 'registration' ELSE 'prediction' END AS action,
         'ip_' || json_extract_string(props, '$.k') AS source_ip,
         CASE WHEN event_type = 'error' THEN 'no_match' ELSE 'success' END AS prediction_status,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE CAST(user_id AS VARCHAR) END AS matched_user,
         value AS processing_time_ms, value / 500 AS confidence,
         CAST(event_id AS VARCHAR) AS prediction_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         ts AS event_ts, epoch_us(ts) // 1000 AS event_ms
  FROM events)
"""
