"""Bulk recognition: detections and vectors in, predictions and access logs out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.functions import events as ev
from doorledger.functions import outcomes as oc
from doorledger.functions.objects import prediction_object_path
from doorledger.operators.similarity import best_match


def bulk_recognition(requests: DataFrame, gallery: DataFrame,
                     threshold: float | None = None) -> DataFrame:
    """One outcome per request, with the gallery loaded once for all of them.

    requests: prediction_id, ts, boxes array<array<double>>, probs array<double>, embedding,
    source_ip, processing_time_ms, error. gallery: match_id, embedding.
    """
    seen = requests.withColumn("face", oc.first_face("boxes", "probs")).drop("boxes", "probs")
    # only a request that got as far as a vector is matched
    able = F.col("face").isNotNull() & F.col("error").isNull()
    ready = (seen.withColumn("has_embedding", F.col("embedding").isNotNull())
             .withColumn("embedding", F.when(able, F.col("embedding"))))
    found = best_match(ready, gallery, threshold, query_id="prediction_id", carry=[
        "ts", "source_ip", "processing_time_ms", "error", "face", "has_embedding"])
    matched = able & F.col("has_embedding")
    out = found.select(
        F.col("query_id").alias("prediction_id"), "ts", "source_ip", "processing_time_ms",
        "error", "face", "has_embedding",
        F.when(matched, F.col("match_id").cast("string")).alias("matched_user"),
        F.when(matched, F.col("score")).alias("confidence")).withColumn(
        "status", oc.prediction_status(F.col("face").isNotNull(), "has_embedding",
                                       "matched_user", "error"))
    return out.select(
        "prediction_id", "ts", "source_ip", "processing_time_ms", "error", "face",
        "matched_user", "confidence", "status",
        oc.response_message("status", "matched_user").alias("message"))


def recognition_predictions(outcomes: DataFrame) -> DataFrame:
    """Rows of the predictions table: only requests that got as far as matching."""
    kept = outcomes.where(F.col("status").isin("success", "no_match"))
    return kept.select(
        F.col("prediction_id").alias("uuid"), F.col("matched_user").cast("bigint").alias("user_id"),
        prediction_object_path("ts", "prediction_id").alias("image_path"), "confidence",
        "processing_time_ms", "status", F.lit(None).cast("string").alias("error_message"),
        F.to_json(F.struct(F.col("face").alias("bounding_box"))).alias("meta_data"),
        F.col("ts").alias("created_at"))


def recognition_logs(outcomes: DataFrame) -> DataFrame:
    """An access-log message per request."""
    meta = F.struct("prediction_id", "matched_user", "confidence", "processing_time_ms",
                    ev.ip_key("source_ip").alias("source_ip"),
                    F.col("status").alias("prediction_status"), "error")
    return ev.build_access_log(outcomes.select(
        oc.log_user("matched_user").alias("user_id"), F.lit("prediction").alias("action"),
        meta.alias("metadata"), ev.iso_text("ts").alias("timestamp")))
