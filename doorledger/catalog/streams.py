"""Streaming queries, run until the input is used up; results are read back from files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from doorledger.catalog.detection import FRAUD_SQL, RULES
from doorledger.catalog.tables import LOGS_SQL, table, with_log_columns
from doorledger.functions import events as ev
from doorledger.schemas import ALERT
from doorledger.session import scratch_dir
from doorledger.sources import lake
from doorledger.streaming import alert_sink, fraud_job, fraud_stream, ingest_to_lake


def _event_stream(spark, sf_dir):
    """The events table as a stream, whether it is stored as one file or as a folder of files."""
    rows = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 64)
    files = {os.path.basename(f) for f in rows.inputFiles()}
    if files == {"events.parquet"}:
        return stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.parquet(f"{sf_dir}/events.parquet")


def _drain(spark, alerts):
    base = scratch_dir(spark, "alerts")
    query = alert_sink(alerts, {"format": "parquet", "path": f"{base}/out"}, f"{base}/checkpoint",
                       {"availableNow": True})
    query.awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{base}/out")


def stream_fraud_alerts(spark, sf_dir):
    return _drain(spark, fraud_stream(with_log_columns(_event_stream(spark, sf_dir)), RULES))


def _values(events):
    logs = with_log_columns(events)
    return logs.select("ingest_seq", "event_ts", F.to_json(F.struct(
        "user_id", "action", F.struct("prediction_id", "matched_user", "confidence",
                                      "processing_time_ms", "source_ip", "prediction_status")
        .alias("metadata"), "timestamp")).alias("value"))


def stream_fraud_job(spark, sf_dir):
    """From raw JSON values to JSON alerts, which are parsed again to be compared."""
    values = _values(_event_stream(spark, sf_dir)).select("ingest_seq", "value")
    out = _drain(spark, fraud_job(values, RULES))
    return out.select(F.from_json("value", ALERT).alias("a")).select("a.*")


def stream_to_lake(spark, sf_dir):
    """Raw values landed by event day, read back from the lake."""
    base = scratch_dir(spark, "lake")
    query = ingest_to_lake(_values(_event_stream(spark, sf_dir)), f"{base}/logs",
                           f"{base}/checkpoint", at=F.col("event_ts"),
                           trigger={"availableNow": True})
    query.awaitTermination()
    flat = ev.flatten_log(lake.read_lake(spark, f"{base}/logs"))
    n = flat.groupBy("Year", "Month", "Day", "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("timestamp").alias("first"))
    return n


QUERIES = {
    "stream_fraud_alerts": (stream_fraud_alerts, FRAUD_SQL),
    "stream_fraud_job": (stream_fraud_job, FRAUD_SQL),
    "stream_to_lake": (stream_to_lake, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y') AS "Year",
        strftime(event_ts, '%m') AS "Month", strftime(event_ts, '%d') AS "Day", user_id,
        count(*) AS events, min("timestamp") AS "first" FROM logs GROUP BY 1, 2, 3, 4"""),
}
