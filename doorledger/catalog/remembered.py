"""Queries of jobs that remember their runs, and exact quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import LOGS_SQL, access_logs, table
from doorledger.catalog.tabular import _features, _latest_sql, _shown
from doorledger.operators.quantiles import quantiles
from doorledger.plans.remembered import materialize_run, refresh_summaries
from doorledger.session import scratch_dir
from doorledger.sources import lake


class _Died(Exception):
    pass


def _die():
    raise _Died


def remembered_materialization(spark, sf_dir):
    """Three runs, of which the second dies after its write; the third starts where the first ended."""
    base, off = scratch_dir(spark, "materialized"), _features(spark, sf_dir)
    materialize_run(off, base, "2024-01-10", ttl_days=5)
    try:
        materialize_run(off, base, "2024-01-15", ttl_days=5, written=_die)
    except _Died:
        pass
    return _shown(materialize_run(off, base, "2024-01-20 12:00:00", ttl_days=5), "employee_id", "score", "version")


def refreshed_summaries(spark, sf_dir):
    """A lake summarised, then again after late files came to some of its days."""
    base = scratch_dir(spark, "refreshed")
    logs = access_logs(spark, sf_dir)
    body = F.to_json(F.struct("user_id", "action", F.struct("prediction_id", "source_ip", "prediction_status").alias("metadata"), "timestamp"))
    rows = logs.select(body.alias("value"), (F.col("ingest_seq") % 3 == 0).alias("late"), F.date_format("event_ts", "yyyy").alias("Year"),
                       F.date_format("event_ts", "MM").alias("Month"), F.date_format("event_ts", "dd").alias("Day"))
    late = F.col("late") & F.col("Day").isin("04", "17")
    for part in (~late, late):
        (rows.where(part).drop("late").repartition("Year", "Month", "Day").write.mode("append").partitionBy("Year", "Month", "Day").text(f"{base}/lake"))
        refresh_summaries(spark, f"{base}/lake", f"{base}/state", f"{base}/reports")
    return lake.read_daily_summaries(spark, f"{base}/reports").drop("processed_at")


def latency_quantiles(spark, sf_dir):
    """Three quantiles per endpoint, one of which holds nine tenths of all rows."""
    e = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 > 0, "/predict").otherwise(F.concat(F.lit("/"), "event_type")).alias("endpoint"), "value")
    return quantiles(e, ["endpoint"], "value", [0.5, 0.95, 0.99]).select("endpoint", "q", F.round("value", 9).alias("value"))


QUERIES = {
    "remembered_materialization": (remembered_materialization, _latest_sql("ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20 12:00:00'")),
    "refreshed_summaries": (refreshed_summaries, f"""WITH {LOGS_SQL}
        SELECT strftime(event_ts, '%Y-%m-%d') AS date, count(*) AS total_events,
               count(*) FILTER (action = 'prediction') AS total_predictions, count(DISTINCT user_id) AS unique_users
        FROM logs GROUP BY 1"""),
    "latency_quantiles": (latency_quantiles, """
        WITH e AS (SELECT CASE WHEN event_id % 10 > 0 THEN '/predict' ELSE '/' || event_type END AS endpoint, value FROM events)
        , w AS (SELECT endpoint, quantile_cont(value, [0.5, 0.95, 0.99]) AS x FROM e GROUP BY 1)
        SELECT endpoint, unnest([0.5::DOUBLE, 0.95, 0.99]) AS q, unnest([round(v, 9) FOR v IN x]) AS value FROM w"""),
}
