"""Summary and count queries over access logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import LOGS_SQL, access_logs, table
from doorledger.functions import events as ev
from doorledger.operators import summary
from doorledger.session import scratch_dir
from doorledger.sources import lake

EDGES = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5)


def daily_summary(spark, sf_dir):
    return summary.summary_by_day(access_logs(spark, sf_dir))


def daily_summary_total(spark, sf_dir):
    """The job form: one row for one batch of logs, here the whole table."""
    return summary.daily_summary(access_logs(spark, sf_dir), "2024-01").drop("processed_at")


def daily_reports(spark, sf_dir):
    """Every day's summary written as a report partition, and the reports read back."""
    base = scratch_dir(spark, "reports")
    days = summary.summary_by_day(access_logs(spark, sf_dir))
    lake.write_daily_summary(days.withColumn("processed_at", F.lit("now")), base)
    return lake.read_daily_summaries(spark, base).drop("processed_at")


def status_counts(spark, sf_dir):
    return summary.status_counts(access_logs(spark, sf_dir))


def request_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    r = e.select(F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
                 F.concat(F.lit("/api/"), "event_type").alias("endpoint"),
                 F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"))
    return summary.request_counts(r)


def detection_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    flags = e.select(F.when(F.col("value") >= 20, "True").otherwise("False").alias("detected"))
    return summary.detection_counts(flags).select(F.col("detected").cast("string"), "n")


def latency_histogram(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type",
                                              (F.col("value") / 1000).alias("seconds"))
    h = summary.latency_histogram(e, ["event_type"], "seconds", EDGES)
    return h.select("event_type", F.col("le").cast("string").alias("le"), "n", "total",
                    F.round("sum", 6).alias("sum_seconds"))


def attendance_report(spark, sf_dir):
    a = summary.attendance_report(access_logs(spark, sf_dir))
    return a.select("date", "user_id", ev.iso_text("first_seen").alias("first_seen"),
                    ev.iso_text("last_seen").alias("last_seen"), "events")


def confidence_trend(spark, sf_dir):
    t = summary.confidence_trend(access_logs(spark, sf_dir))
    # ten digits: means of two-decimal values are often exact halves at six
    return t.select("user_id", "date", *[F.round(c, 10).alias(c) for c in (
        "avg_confidence", "min_confidence", "max_confidence", "change")])


def parsed_logs(spark, sf_dir):
    """Events written as JSON log lines, some broken on purpose, and parsed back."""
    return _parsed(spark, sf_dir)


def _raw_values(spark, sf_dir):
    logs = access_logs(spark, sf_dir)
    body = logs.select("ingest_seq", "user_id", "action", F.struct(
        "prediction_id", "matched_user", "confidence", "processing_time_ms", "source_ip",
        "prediction_status").alias("metadata"), "timestamp")
    text = F.to_json(F.struct("user_id", "action", "metadata", "timestamp"))
    broken = F.col("user_id") == "7"
    zoned = F.col("action") == "registration"
    return body.withColumn("timestamp", F.when(zoned, F.concat("timestamp", F.lit("Z")))
                           .otherwise(F.col("timestamp"))).select(
        "ingest_seq", F.when(broken, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))


def _parsed(spark, sf_dir):
    flat = ev.log_events(_raw_values(spark, sf_dir), bad_time="keep")
    return flat.select("ingest_seq", "user_id", "action", "source_ip", "prediction_status",
                       F.round("confidence", 6).alias("confidence"), "event_ms",
                       F.col("_corrupt").alias("corrupt"))


def lake_partitions(spark, sf_dir):
    logs = access_logs(spark, sf_dir)
    return logs.select(*ev.date_parts("event_ts")).groupBy("Year", "Month", "Day").agg(
        F.count(F.lit(1)).alias("n"))


def access_log_json(spark, sf_dir):
    logs = access_logs(spark, sf_dir).select(
        "user_id", "action", F.struct("prediction_id", "matched_user", "source_ip",
                                      "prediction_status").alias("metadata"), "timestamp")
    return ev.build_access_log(logs)


def event_json(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_type", F.from_json("props", "struct<k:bigint>").alias("payload"),
        ev.iso_text(F.col("ts").cast("timestamp")).alias("timestamp"))
    return ev.build_event(e).select("value")


def alert_json(spark, sf_dir):
    """Producer-form alerts: missing metadata becomes an empty object."""
    e = table(spark, sf_dir, "events")
    a = e.select(F.lit("system_error").alias("alert_type"),
                 F.when(F.col("event_type") == "error", "critical").otherwise("info")
                 .alias("severity"),
                 F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
                 F.when(F.col("event_type") == "error",
                        F.create_map(F.lit("user"), F.col("user_id").cast("string")))
                 .alias("metadata"),
                 ev.iso_text(F.col("ts").cast("timestamp")).alias("timestamp"))
    return ev.build_alert(a).select("value")




QUERIES = {
    "daily_summary": (daily_summary, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y-%m-%d') AS date, count(*) AS total_events,
               count(*) FILTER (action = 'prediction') AS total_predictions,
               count(DISTINCT user_id) AS unique_users
        FROM logs GROUP BY 1"""),
    "daily_reports": (daily_reports, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y-%m-%d') AS date, count(*) AS total_events,
               count(*) FILTER (action = 'prediction') AS total_predictions,
               count(DISTINCT user_id) AS unique_users
        FROM logs GROUP BY 1"""),
    "daily_summary_total": (daily_summary_total, f"""WITH {LOGS_SQL}
        SELECT '2024-01' AS date, count(*) AS total_events,
               count(*) FILTER (action = 'prediction') AS total_predictions,
               count(DISTINCT user_id) AS unique_users FROM logs"""),
    "status_counts": (status_counts, f"""WITH {LOGS_SQL}
        SELECT prediction_status AS status, count(*) AS n FROM logs GROUP BY 1"""),
    "request_counts": (request_counts, """
        SELECT CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
               '/api/' || event_type AS endpoint,
               CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, count(*) AS n
        FROM events GROUP BY 1, 2, 3"""),
    "detection_counts": (detection_counts, """
        SELECT CASE WHEN value >= 20 THEN 'true' ELSE 'false' END AS detected, count(*) AS n
        FROM events GROUP BY 1"""),
    "latency_histogram": (latency_histogram, f"""
        SELECT e.event_type, b.label AS le, count(*) FILTER (value / 1000 <= b.edge) AS n,
               count(*) AS total, round(sum(value / 1000), 6) AS sum_seconds
        FROM events e, (VALUES {", ".join(f"('{x}', {x}::DOUBLE)" for x in EDGES)},
                               ('Infinity', 'Infinity'::DOUBLE)) b(label, edge)
        GROUP BY 1, 2, b.edge"""),
    "attendance_report": (attendance_report, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y-%m-%d') AS date, user_id,
               strftime(min(event_ts), '%Y-%m-%dT%H:%M:%S.%f') AS first_seen,
               strftime(max(event_ts), '%Y-%m-%dT%H:%M:%S.%f') AS last_seen, count(*) AS events
        FROM logs WHERE prediction_status = 'success' AND user_id <> 'anonymous'
        GROUP BY 1, 2"""),
    "confidence_trend": (confidence_trend, f"""WITH {LOGS_SQL}, d AS (
        SELECT user_id, strftime(event_ts, '%Y-%m-%d') AS date, avg(confidence) AS a,
               min(confidence) AS lo, max(confidence) AS hi FROM logs GROUP BY 1, 2)
        SELECT user_id, date, round(a, 10) AS avg_confidence, round(lo, 10) AS min_confidence,
               round(hi, 10) AS max_confidence,
               round(a - lag(a) OVER (PARTITION BY user_id ORDER BY date), 10) AS change
        FROM d"""),
    "parsed_logs": (parsed_logs, f"""WITH {LOGS_SQL}
        SELECT ingest_seq, CASE WHEN user_id <> '7' THEN user_id END AS user_id,
               CASE WHEN user_id <> '7' THEN action END AS action,
               CASE WHEN user_id <> '7' THEN source_ip END AS source_ip,
               CASE WHEN user_id <> '7' THEN prediction_status END AS prediction_status,
               CASE WHEN user_id <> '7' THEN round(confidence, 6) END AS confidence,
               CASE WHEN user_id <> '7' THEN event_ms END AS event_ms,
               user_id = '7' AS corrupt FROM logs"""),
    "lake_partitions": (lake_partitions, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y') AS "Year", strftime(event_ts, '%m') AS "Month",
               strftime(event_ts, '%d') AS "Day", count(*) AS n FROM logs GROUP BY 1, 2, 3"""),
    "access_log_json": (access_log_json, f"""WITH {LOGS_SQL}
        SELECT user_id AS key, '{{"user_id":"' || user_id || '","action":"' || action
          || '","metadata":{{"prediction_id":"' || prediction_id || '","matched_user":'
          || coalesce('"' || matched_user || '"', 'null') || ',"source_ip":"' || source_ip
          || '","prediction_status":"' || prediction_status || '"}},"timestamp":"'
          || "timestamp" || '"}}' AS value FROM logs"""),
    "event_json": (event_json, """
        SELECT '{"event_type":"' || event_type || '","payload":{"k":'
          || json_extract_string(props, '$.k') || '},"timestamp":"'
          || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value FROM events"""),
    "alert_json": (alert_json, """
        SELECT '{"alert_type":"system_error","severity":"'
          || CASE WHEN event_type = 'error' THEN 'critical' ELSE 'info' END
          || '","message":"event ' || event_id || '","metadata":'
          || CASE WHEN event_type = 'error' THEN '{"user":"' || user_id || '"}' ELSE '{}' END
          || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
        FROM events"""),
}
