"""Queries of the lake's upkeep, of the daily job as a whole, of the gallery's fallback and of batched inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import LOGS_SQL, access_logs, table
from doorledger.operators.similarity import gallery_with_fallback
from doorledger.plans.daily import run_daily
from doorledger.session import scratch_dir
from doorledger.sources import lake
from doorledger.sources.images import batch_infer


def _landed(spark, sf_dir):
    """All events as JSON lines in day folders."""
    base = scratch_dir(spark, "landed")
    logs = access_logs(spark, sf_dir)
    body = F.to_json(F.struct("user_id", "action", F.struct("prediction_id", "source_ip", "prediction_status").alias("metadata"), "timestamp"))
    (logs.select(body.alias("value"), F.date_format("event_ts", "yyyy").alias("Year"), F.date_format("event_ts", "MM").alias("Month"),
                 F.date_format("event_ts", "dd").alias("Day"))
     .repartition("Year", "Month", "Day").write.partitionBy("Year", "Month", "Day").text(f"{base}/lake"))
    return base


def lake_manifest(spark, sf_dir):
    """What a landed lake holds, by its manifest."""
    base = _landed(spark, sf_dir)
    return lake.dataset_manifest(spark, f"{base}/lake", lake.read_lake(spark, f"{base}/lake")).select(
        "total_records", "num_users", "first_timestamp", "last_timestamp", "total_files")


def lake_objects(spark, sf_dir):
    """Objects of a landed lake by day, from their listing alone."""
    found = lake.list_objects(spark, f"{_landed(spark, sf_dir)}/lake", glob=lake.LOG_FILES)
    day = F.concat_ws("-", *(F.regexp_extract("path", f"{k}=([0-9]+)", 1) for k in ("Year", "Month", "Day")))
    return found.groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("objects"), F.min(F.col("length") > 0).alias("filled"))


def expired_objects(spark, sf_dir):
    """Of an inventory of objects, one per event, those that a retention of ten days would delete."""
    inventory = table(spark, sf_dir, "events").select(
        F.concat(F.lit("/lake/"), F.col("event_id").cast("string")).alias("path"), F.col("ts").cast("timestamp").alias("modificationTime"),
        F.length("props").cast("long").alias("length"))
    old = lake.retention_candidates(inventory, "2024-01-21", 10)
    return old.groupBy(F.date_format("modificationTime", "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes"))


def daily_job(spark, sf_dir):
    """The daily job from its check for data to the report, for one day of the landed lake."""
    base = _landed(spark, sf_dir)
    return run_daily(spark, f"{base}/lake", f"{base}/reports", "2024-01-15", now="2024-06-01").drop("processed_at")


def fallback_gallery(spark, sf_dir):
    """No online vector is usable, so the offline ones are the gallery."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    online = e.withColumn("embedding", F.when(F.col("vec_id") < 0, F.col("embedding")))
    return gallery_with_fallback(online, e).groupBy("label").agg(
        F.count(F.lit(1)).alias("vectors"), F.min("vec_id").alias("first"), F.max("vec_id").alias("last"))


def _counting_model():
    def model(images: list[bytes]) -> list[list[float] | None]:
        if any(len(i) % 11 == 0 for i in images):
            raise ValueError("broken image")
        return [None if len(i) % 7 == 0 else [float(len(i)), float(i.count(b" "))] for i in images]
    return model


def batched_inference(spark, sf_dir):
    """Whole texts in place of images, eight at a time; a broken one costs only its own result."""
    images = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return batch_infer(images, _counting_model, ["doc_id"]).select(
        "doc_id", F.col("embedding")[0].cast("long").alias("bytes"), F.col("embedding")[1].cast("long").alias("spaces"))


QUERIES = {
    "lake_manifest": (lake_manifest, f"""WITH {LOGS_SQL}
        SELECT count(*) AS total_records, count(DISTINCT user_id) FILTER (user_id <> 'anonymous') AS num_users,
               min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp,
               count(DISTINCT CAST(event_ts AS DATE)) AS total_files FROM logs"""),
    "lake_objects": (lake_objects, """
        SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, 1::BIGINT AS objects, true AS filled FROM events"""),
    "expired_objects": (expired_objects, """
        SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS objects, sum(length(props))::BIGINT AS bytes
        FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1"""),
    "daily_job": (daily_job, f"""WITH {LOGS_SQL}
        SELECT '2024-01-15' AS date, count(*) AS total_events, count(*) FILTER (action = 'prediction') AS total_predictions,
               count(DISTINCT user_id) AS unique_users FROM logs WHERE strftime(event_ts, '%Y-%m-%d') = '2024-01-15'"""),
    "fallback_gallery": (fallback_gallery, """
        SELECT label, count(*) AS vectors, min(vec_id) AS "first", max(vec_id) AS "last" FROM embeddings
        WHERE embedding IS NOT NULL GROUP BY 1"""),
    "batched_inference": (batched_inference, """
        WITH t AS (SELECT doc_id, octet_length(encode(text)) AS n, length(text) - length(replace(text, ' ', '')) AS s FROM documents)
        SELECT doc_id, CASE WHEN n % 11 > 0 AND n % 7 > 0 THEN n END AS bytes, CASE WHEN n % 11 > 0 AND n % 7 > 0 THEN s END AS spaces FROM t"""),
}
