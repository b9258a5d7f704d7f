"""Row shapes shared by batch and streaming jobs."""

from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("prediction_id", T.StringType()),
    T.StructField("matched_user", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("processing_time_ms", T.DoubleType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("prediction_status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("check_in_type", T.StringType()),
])

ACCESS_LOG = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("metadata", METADATA),
    T.StructField("timestamp", T.StringType()),
])

ALERT = T.StructType([
    T.StructField("alert_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("window_seconds", T.IntegerType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

FEATURES = T.StructType([
    T.StructField("employee_id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("embedding_model", T.StringType()),
    T.StructField("embedding_version", T.LongType()),
    T.StructField("image_quality_score", T.FloatType()),
    T.StructField("num_faces_detected", T.LongType()),
    T.StructField("registration_confidence", T.FloatType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])

SUMMARY = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("total_predictions", T.LongType()),
    T.StructField("unique_users", T.LongType()),
])

FACE = T.StructType([
    T.StructField("confidence", T.DoubleType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("uuid", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("face_embedding", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

PREDICTIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("uuid", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("processing_time_ms", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("meta_data", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
