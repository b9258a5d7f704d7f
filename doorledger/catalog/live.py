"""Streaming queries with event-time state: the tables arrive slice by slice, in order or shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doorledger.catalog.detection import FRAUD_SQL, RULES
from doorledger.catalog.tables import table, with_log_columns
from doorledger.functions import events as ev
from doorledger.operators.metrics import count_by_window
from doorledger.session import scratch_dir, settled
from doorledger.streaming import (alert_sink, batch_sink, condition_events, counter_rates, fraud_stream, read_batches,
                                  route_late)

_DAYS = 15
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"


def _arriving(spark, rows: DataFrame, arrival: Column) -> DataFrame:
    """The rows as a stream that gets those of fifteen days of arrival time in each micro-batch."""
    base = scratch_dir(spark, "slices")
    cut = settled(rows.withColumn("_slice", F.floor(F.unix_timestamp(arrival) / (_DAYS * 86_400))))
    for n in sorted(r[0] for r in cut.select("_slice").distinct().collect()):  # a few slices of a month
        cut.where(F.col("_slice") == n).drop("_slice").coalesce(1).write.mode("append").parquet(base)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(base)


def _events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def _shuffled(spark, sf_dir) -> DataFrame:
    """Events that arrive up to a day late."""
    late = F.make_dt_interval(secs=F.pmod(F.col("event_id") * 7919, F.lit(86_400)).cast("decimal(18,6)"))
    return _arriving(spark, _events(spark, sf_dir), F.col("ts") + late)


def _drained(spark, rows: DataFrame) -> DataFrame:
    base = scratch_dir(spark, "live")
    query = alert_sink(rows, {"format": "parquet", "path": f"{base}/out"}, f"{base}/checkpoint", {"availableNow": True})
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


def stream_timer_alerts(spark, sf_dir):
    """Detection whose state is cleaned by event-time timers."""
    events = _arriving(spark, _events(spark, sf_dir), F.col("ts"))
    return _drained(spark, fraud_stream(with_log_columns(events), RULES, timers=True))


class _Stopped(Exception):
    pass


def stream_restarted_alerts(spark, sf_dir):
    """The same job, ended after its second batch was written but not committed, and started again."""
    base = scratch_dir(spark, "restart")
    alerts = fraud_stream(with_log_columns(_arriving(spark, _events(spark, sf_dir), F.col("ts"))), RULES, timers=True)

    def stop(number: int) -> None:
        if number == 1:
            raise _Stopped("ended between write and commit")

    for written in (stop, None):
        query = batch_sink(alerts, {"alerts": (f"{base}/out", None)}, f"{base}/checkpoint", {"availableNow": True}, written)
        try:
            query.awaitTermination()
        except Exception as ended:  # only the stop that was asked for
            if "ended between write and commit" not in str(ended):
                raise
    return read_batches(spark, f"{base}/out", alerts.schema)


def _conditions(spark, sf_dir, holds: Column, absent: bool):
    samples = _arriving(spark, _events(spark, sf_dir), F.col("ts")).withWatermark("ts", "1 hour")
    found = _drained(spark, condition_events(samples, ["user_id"], holds, 86_400, 86_400, absent))
    return found.select("user_id", "event", ev.iso_text("started").alias("started"), ev.iso_text("at").alias("at"))


def stream_high_value(spark, sf_dir):
    """Users whose value stays above 20 for a day; a value counts for at most a day."""
    return _conditions(spark, sf_dir, F.col("value") > 20, False)


def stream_gone_users(spark, sf_dir):
    """Users of whom only errors, or nothing at all, came for a day."""
    return _conditions(spark, sf_dir, F.col("event_type") == "error", True)


def _conditions_sql(holds: str, absent: str) -> str:
    day = 86_400_000_000
    at = _ISO.format("make_timestamp({})")
    return f"""
      WITH w AS (SELECT (epoch_us(max(ts)) // 1000 - 3600000 + 1) * 1000 AS lim FROM events),
      s AS (SELECT user_id, epoch_us(ts) AS us, bool_or({holds}) AS ok FROM events, w WHERE epoch_us(ts) < lim GROUP BY 1, 2),
      n AS (SELECT *, lead(us) OVER (PARTITION BY user_id ORDER BY us) AS nx FROM s),
      iv AS (SELECT user_id, us AS a, ok AS h FROM n
             UNION ALL SELECT user_id, us + {day}, {absent} FROM n WHERE nx IS NULL OR nx > us + {day}),
      c AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY a) AS was FROM iv),
      e AS (SELECT user_id, a, h, lead(a) OVER (PARTITION BY user_id ORDER BY a) AS b FROM c WHERE was IS NULL OR was <> h),
      r AS (SELECT e.*, lim FROM e, w WHERE h AND (b IS NULL OR b > a + {day}))
      SELECT user_id, 'firing' AS event, {at.format("a")} AS started, {at.format(f"a + {day}")} AS "at" FROM r WHERE a + {day} < lim
      UNION ALL SELECT user_id, 'resolved', {at.format("a")}, {at.format("b")} FROM r WHERE b < lim"""


def stream_counter_rate(spark, sf_dir):
    """Hourly rates of counters that restart, from samples that arrive up to a day out of order."""
    e = _shuffled(spark, sf_dir)
    samples = e.select("event_type", "ts", F.pmod("event_id", F.lit(1000)).cast("double").alias("value")).withWatermark("ts", "1 day")
    r = _drained(spark, counter_rates(samples, ["event_type"], ["event_type"], "1 hour", 3600))
    return r.select("event_type", ev.iso_text("window_start").alias("window_start"), F.round("increase", 6).alias("increase"),
                    F.round("rate", 6).alias("rate"))


def stream_topic_throughput(spark, sf_dir):
    """Offsets of a topic with a partition per user: increases per partition, added up per topic and day."""
    samples = (_shuffled(spark, sf_dir).select("event_type", "user_id", "ts", F.col("event_id").cast("double").alias("value"))
               .withWatermark("ts", "1 day"))
    r = _drained(spark, counter_rates(samples, ["event_type", "user_id"], ["event_type"], "1 day", 86_400))
    return r.select("event_type", ev.iso_text("window_start").alias("window_start"), F.round("increase", 6).alias("increase"),
                    F.round("rate", 8).alias("rate"))


def stream_predictions_per_minute(spark, sf_dir):
    """Events per type and quarter of an hour, each window once it is closed."""
    samples = _shuffled(spark, sf_dir).withWatermark("ts", "1 day")
    r = _drained(spark, count_by_window(samples, ["event_type"], "15 minutes"))
    return r.select("event_type", ev.iso_text("window_start").alias("window_start"), "n")


def stream_late_rows(spark, sf_dir):
    """Where each event went when only six hours of lateness are waited for."""
    base = scratch_dir(spark, "routes")
    rows = _shuffled(spark, sf_dir).select("event_id", "ts").withWatermark("ts", "6 hours")
    route_late(rows, "ts", f"{base}/on_time", f"{base}/late", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    schema = rows.schema
    both = [read_batches(spark, f"{base}/{where}", schema).select("event_id", F.lit(where).alias("went")) for where in ("on_time", "late")]
    return both[0].union(both[1])


_CLOSED = "epoch_us(time_bucket(INTERVAL '{0}', ts) + INTERVAL '{0}') // 1000 <= (SELECT epoch_us(max(ts)) // 1000 - 86400000 FROM events)"


def _rates_sql(keys: str, value: str, width: str, seconds: int, digits: int) -> str:
    return f"""
      WITH d AS (
        SELECT event_type, ts, {value} AS v, lag({value}) OVER (PARTITION BY {keys} ORDER BY ts, {value}) AS p FROM events),
      i AS (SELECT event_type, ts, CASE WHEN v < p THEN v ELSE v - p END AS inc FROM d)
      SELECT event_type, {_ISO.format(f"time_bucket(INTERVAL '{width}', ts)")} AS window_start,
             round(coalesce(sum(inc), 0), 6) AS increase, round(coalesce(sum(inc), 0) / {seconds}, {digits}) AS rate
      FROM i WHERE {_CLOSED.format(width)} GROUP BY 1, 2"""


QUERIES = {
    "stream_timer_alerts": (stream_timer_alerts, FRAUD_SQL),
    "stream_restarted_alerts": (stream_restarted_alerts, FRAUD_SQL),
    "stream_high_value": (stream_high_value, _conditions_sql("value > 20", "false")),
    "stream_gone_users": (stream_gone_users, _conditions_sql("event_type = 'error'", "true")),
    "stream_counter_rate": (stream_counter_rate, _rates_sql("event_type", "CAST(event_id % 1000 AS DOUBLE)", "1 hour", 3600, 6)),
    "stream_topic_throughput": (stream_topic_throughput, _rates_sql("event_type, user_id", "CAST(event_id AS DOUBLE)", "1 day", 86_400, 8)),
    "stream_predictions_per_minute": (stream_predictions_per_minute, f"""
        SELECT event_type, {_ISO.format("time_bucket(INTERVAL '15 minutes', ts)")} AS window_start, count(*) AS n
        FROM events WHERE {_CLOSED.format("15 minutes")} GROUP BY 1, 2"""),
    "stream_late_rows": (stream_late_rows, f"""
        WITH a AS (SELECT event_id, ts, (epoch(ts)::BIGINT + event_id * 7919 % 86400) // {_DAYS * 86_400} AS slice FROM events),
        m AS (SELECT slice, max(ts) AS newest FROM a GROUP BY 1),
        w AS (SELECT a.slice, max(epoch_us(m.newest) // 1000 - 21600000) AS mark FROM (SELECT DISTINCT slice FROM a) a
              LEFT JOIN m ON m.slice < a.slice GROUP BY 1)
        SELECT event_id, CASE WHEN epoch_us(ts) // 1000 <= mark THEN 'late' ELSE 'on_time' END AS went FROM a JOIN w USING (slice)"""),
}
