"""Detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import LOGS_SQL, access_logs
from doorledger.operators import detect

DAY, WEEK = 86_400, 604_800
RULES = [detect.spam_rule(5, DAY), detect.brute_force_rule(5, WEEK)]


def _trailing(key: str, where: str, window_seconds: int) -> str:
    """Counts over (t - W, t], later arrivals of the same millisecond taken out again."""
    return f"""
    SELECT *, count(*) OVER (PARTITION BY {key} ORDER BY event_ms
                             RANGE BETWEEN {window_seconds * 1000 - 1} PRECEDING AND CURRENT ROW)
            - (count(*) OVER (PARTITION BY {key}, event_ms)
               - row_number() OVER (PARTITION BY {key}, event_ms ORDER BY ingest_seq)) AS n
    FROM logs WHERE {where}"""


SPAM_SQL = f"""
  SELECT 'spam_detection' AS alert_type, user_id, source_ip, CAST(n AS BIGINT) AS "count",
         CAST({DAY} AS INTEGER) AS window_seconds,
         CASE WHEN n > 10 THEN 'critical' ELSE 'warning' END AS severity,
         'User ' || user_id || ' logged in successfully ' || n || ' times in {DAY}s' AS message,
         "timestamp"
  FROM ({_trailing("user_id", "user_id <> 'anonymous' AND prediction_status = 'success'", DAY)})
  WHERE n > 5"""

BRUTE_SQL = f"""
  SELECT 'brute_force_detection' AS alert_type, CAST(NULL AS VARCHAR) AS user_id, source_ip,
         CAST(n AS BIGINT) AS "count", CAST({WEEK} AS INTEGER) AS window_seconds,
         'critical' AS severity,
         'IP ' || source_ip || ' had ' || n || ' failed matches in {WEEK}s' AS message,
         "timestamp"
  FROM ({_trailing("source_ip", "action = 'prediction' AND prediction_status = 'no_match'", WEEK)})
  WHERE n > 5"""

FRAUD_SQL = f"WITH {LOGS_SQL} {SPAM_SQL} UNION ALL {BRUTE_SQL}"


def fraud_alerts(spark, sf_dir):
    return detect.fraud_alerts(access_logs(spark, sf_dir), RULES)


def spam_alerts(spark, sf_dir):
    return detect.spam_alerts(access_logs(spark, sf_dir), 5, DAY)


def brute_force_alerts(spark, sf_dir):
    return detect.brute_force_alerts(access_logs(spark, sf_dir), 5, WEEK)


def trailing_counts(spark, sf_dir):
    """Every event's own count, whatever its status, per source address."""
    logs = access_logs(spark, sf_dir).select("source_ip", "event_ms", "ingest_seq")
    return detect.trailing_count(logs, ["source_ip"], "event_ms", "ingest_seq", DAY * 1000,
                                 out="n").select("ingest_seq", "source_ip", "n")


def trailing_counts_hour(spark, sf_dir):
    """The same with a window short enough for the one-shuffle form."""
    logs = access_logs(spark, sf_dir).select("source_ip", "event_ms", "ingest_seq")
    return detect.trailing_count(logs, ["source_ip"], "event_ms", "ingest_seq", 3_600_000,
                                 out="n").select("ingest_seq", "source_ip", "n")


def default_rule_counts(spark, sf_dir):
    """What the rules count before their thresholds, with the widths of production (60 s and 300 s)."""
    logs = access_logs(spark, sf_dir)
    rows = detect.rule_rows(logs, [detect.spam_rule(), detect.brute_force_rule()])
    rows = rows.select("rule", "key", "event_ms", "ingest_seq", "window_ms")
    counted = detect.trailing_count(rows, ["rule", "key"], "event_ms", "ingest_seq", F.col("window_ms"), out="n", longest_ms=300_000)
    name = F.when(F.col("rule") == 0, "spam_detection").otherwise("brute_force_detection")
    return counted.select(name.alias("rule"), "ingest_seq", "n")


def missing_address_counts(spark, sf_dir):
    """Day-long counts where a third of the addresses is missing; null is a key of its own."""
    logs = access_logs(spark, sf_dir).select("source_ip", "event_ms", "ingest_seq")
    logs = logs.withColumn("source_ip", F.when(F.col("ingest_seq") % 3 > 0, F.col("source_ip")))
    return detect.trailing_count(logs, ["source_ip"], "event_ms", "ingest_seq", DAY * 1000, out="n").select("ingest_seq", "source_ip", "n")


QUERIES = {
    "fraud_alerts": (fraud_alerts, FRAUD_SQL),
    "spam_alerts": (spam_alerts, f"WITH {LOGS_SQL} {SPAM_SQL}"),
    "brute_force_alerts": (brute_force_alerts, f"WITH {LOGS_SQL} {BRUTE_SQL}"),
    "trailing_counts": (trailing_counts, f"""WITH {LOGS_SQL}
        SELECT ingest_seq, source_ip, n FROM ({_trailing("source_ip", "true", DAY)})"""),
    "default_rule_counts": (default_rule_counts, f"""WITH {LOGS_SQL}
        SELECT 'spam_detection' AS rule, ingest_seq, n
        FROM ({_trailing("user_id", "user_id <> 'anonymous' AND prediction_status = 'success'", 60)})
        UNION ALL SELECT 'brute_force_detection', ingest_seq, n
        FROM ({_trailing("source_ip", "action = 'prediction' AND prediction_status = 'no_match'", 300)})"""),
    "missing_address_counts": (missing_address_counts, f"""WITH {LOGS_SQL.replace("logs AS (", "every AS (", 1)},
        logs AS (SELECT ingest_seq, event_ms, CASE WHEN ingest_seq % 3 > 0 THEN source_ip END AS source_ip FROM every)
        SELECT ingest_seq, source_ip, n FROM ({_trailing("source_ip", "true", DAY)})"""),
    "trailing_counts_hour": (trailing_counts_hour, f"""WITH {LOGS_SQL}
        SELECT ingest_seq, source_ip, n FROM ({_trailing("source_ip", "true", 3600)})"""),
}
