"""Parsing, time and predicates of access-log events, and the messages built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doorledger.schemas import ACCESS_LOG

ANONYMOUS = "anonymous"
UNKNOWN_IP = "unknown"

_PARSE = T.StructType(ACCESS_LOG.fields + [T.StructField("_corrupt_record", T.StringType())])


def parse_access_log(value: Column | str) -> Column:
    """JSON text to a typed event; malformed text gives a struct of nulls."""
    return F.from_json(value, _PARSE, {"mode": "PERMISSIVE",
                                       "columnNameOfCorruptRecord": "_corrupt_record"})


def iso_timestamp(text: Column | str) -> Column:
    """ISO-8601 text (optionally with ``Z`` or an offset) to a timestamp, null when unreadable.

    A time without a date is unreadable; it would otherwise be read as a time of today.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def event_millis(ts: Column | str) -> Column:
    return F.unix_millis(ts)


def iso_text(ts: Column | str) -> Column:
    """Timestamp to the offset-free ISO text the event producer writes."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def log_events(df: DataFrame, value: str = "value", bad_time: str = "drop") -> DataFrame:
    """Raw JSON values to flat events: keys, event time, status and a corruption flag.

    ``bad_time="drop"`` removes events without a readable timestamp;
    ``"keep"`` leaves ``event_ts`` null so they can be reported; ``"now"`` stamps
    them with processing time, as a live job does.
    """
    if bad_time not in ("drop", "keep", "now"):
        raise ValueError(f"Unknown bad_time policy: {bad_time}")
    rest = [c for c in df.columns if c != value]
    flat = flatten_log(df.select(*rest, parse_access_log(value).alias("_e"))
                       .select(*rest, "_e.*"))
    if bad_time == "drop":
        return flat.where(F.col("event_ts").isNotNull())
    if bad_time == "now":
        flat = flat.withColumn("event_ts", F.coalesce("event_ts", F.current_timestamp()))
        return flat.withColumn("event_ms", event_millis("event_ts"))
    return flat


def flatten_log(df: DataFrame) -> DataFrame:
    """Structured access logs (as read from the lake) to the flat event form."""
    known = set(ACCESS_LOG.fieldNames()) | {"_corrupt_record"}
    rest = [c for c in df.columns if c not in known]
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns
               else F.lit(False))
    ts = iso_timestamp("timestamp")
    return df.select(
        *rest, "user_id", "action", "timestamp",
        F.col("metadata.prediction_id").alias("prediction_id"),
        F.col("metadata.matched_user").alias("matched_user"),
        F.col("metadata.confidence").alias("confidence"),
        F.col("metadata.processing_time_ms").alias("processing_time_ms"),
        F.col("metadata.source_ip").alias("source_ip"),
        F.col("metadata.prediction_status").alias("prediction_status"),
        F.col("metadata.error").alias("error"),
        F.col("metadata.device_id").alias("device_id"),
        F.col("metadata.check_in_type").alias("check_in_type"),
        ts.alias("event_ts"), event_millis(ts).alias("event_ms"), corrupt.alias("_corrupt"))


def user_key(user: Column | str = "user_id") -> Column:
    return F.coalesce(user, F.lit(ANONYMOUS))


def ip_key(ip: Column | str = "source_ip") -> Column:
    return F.coalesce(ip, F.lit(UNKNOWN_IP))


def is_prediction() -> Column:
    return F.col("action") == "prediction"


def is_named_success() -> Column:
    """A successful event of a known user, whatever its action."""
    return (user_key() != ANONYMOUS) & (F.col("prediction_status") == "success")


def is_failed_match() -> Column:
    return is_prediction() & (F.col("prediction_status") == "no_match")


def date_parts(ts: Column | str) -> list[Column]:
    """Zero-padded lake partition columns."""
    return [F.date_format(ts, "yyyy").alias("Year"), F.date_format(ts, "MM").alias("Month"),
            F.date_format(ts, "dd").alias("Day")]


def default_day() -> Column:
    """Yesterday (UTC) as text: the day a scheduled summary works on."""
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")


def stable_uuid(*parts: Column | str) -> Column:
    """A UUID-shaped id derived from the parts, equal on every re-run."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# --- messages ---------------------------------------------------------------------------

def build_access_log(df: DataFrame, user: str = "user_id", action: str = "action",
                     metadata: str = "metadata", timestamp: str = "timestamp") -> DataFrame:
    """Topic-ready access log: keyed by user."""
    body = F.struct(F.col(user).alias("user_id"), F.col(action).alias("action"),
                    F.col(metadata).alias("metadata"), F.col(timestamp).alias("timestamp"))
    return df.select(F.col(user).alias("key"),
                     F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def build_event(df: DataFrame, event_type: str = "event_type", payload: str = "payload",
                timestamp: str = "timestamp") -> DataFrame:
    body = F.struct(F.col(event_type).alias("event_type"), F.col(payload).alias("payload"),
                    F.col(timestamp).alias("timestamp"))
    return df.select(F.lit(None).cast("string").alias("key"),
                     F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def build_alert(df: DataFrame, alert_type: str = "alert_type", severity: str = "severity",
                message: str = "message", metadata: str = "metadata",
                timestamp: str = "timestamp") -> DataFrame:
    empty = F.create_map().cast("map<string,string>")
    body = F.struct(F.col(alert_type).alias("alert_type"), F.col(severity).alias("severity"),
                    F.col(message).alias("message"),
                    F.coalesce(F.col(metadata).cast("map<string,string>"), empty)
                    .alias("metadata"),
                    F.col(timestamp).alias("timestamp"))
    return df.select(F.lit(None).cast("string").alias("key"),
                     F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def alert_json(alerts: DataFrame) -> DataFrame:
    """Detected alerts as JSON values; absent fields (no user on an IP alert) are left out."""
    fields = ["alert_type", "user_id", "source_ip", "count", "window_seconds", "severity",
              "message", "timestamp"]
    return alerts.select(F.to_json(F.struct(*fields)).alias("value"))


def webhook_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct(F.col(value).alias("content"))).alias("value"))
