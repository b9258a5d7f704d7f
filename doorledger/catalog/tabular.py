"""Feature-table and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import table
from doorledger.functions import events as ev
from doorledger.operators import features, metrics, summary

EDGES = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5)


def _features(spark, sf_dir):
    """Each event updates its user's feature ``score``."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(F.col("user_id").cast("string").alias("employee_id"),
                    F.col("value").alias("score"), F.col("event_id").alias("version"),
                    ts.alias("event_timestamp"), ts.alias("created_at"))


def _shown(df, *names):
    return df.select(*names, ev.iso_text("event_timestamp").alias("event_time"))


def latest_features(spark, sf_dir):
    return _shown(features.latest_features(_features(spark, sf_dir)), "employee_id", "score",
                  "version")


def materialize_window(spark, sf_dir):
    m = features.materialize(_features(spark, sf_dir), "2024-01-05", "2024-01-06")
    return _shown(m, "employee_id", "score", "version")


def incremental_materialize(spark, sf_dir):
    """Two runs; the second starts where the first ended."""
    off = _features(spark, sf_dir)
    one = features.materialize_incremental(off, None, None, "2024-01-10", ttl_days=5)
    two = features.materialize_incremental(off, one, "2024-01-10", "2024-01-10 06:00:00")
    return _shown(two, "employee_id", "score", "version")


def _wanted(spark, sf_dir):
    """Every customer asks; only some are known users."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("employee_id"))


def online_lookup(spark, sf_dir):
    online = features.latest_features(_features(spark, sf_dir))
    return features.online_lookup(_wanted(spark, sf_dir), online, ["score", "version"])


def online_features_ttl(spark, sf_dir):
    online = features.latest_features(_features(spark, sf_dir))
    return features.online_features(_wanted(spark, sf_dir), online, "2024-01-31",
                                    ["score", "version"], ttl_days=1.25)


def asof_features(spark, sf_dir):
    """Orders, moved into the month of the events, look up their customer's score."""
    o = table(spark, sf_dir, "orders")
    minutes = F.pmod(F.col("o_orderkey") * 7919, F.lit(43_200)).cast("int")
    spine = o.select("o_orderkey", F.pmod("o_custkey", F.lit(200)).cast("string")
                     .alias("employee_id"),
                     (F.lit("2024-01-01").cast("timestamp")
                      + F.make_dt_interval(mins=minutes)).alias("event_timestamp"))
    r = features.historical_features(spine, _features(spark, sf_dir), ["score", "version"],
                                     ttl_days=0.5)
    return r.select("o_orderkey", "employee_id", "score", "version",
                    ev.iso_text("feature_timestamp").alias("feature_time"))


def embeddings_for_matching(spark, sf_dir):
    """Vectors as users' stored JSON, projected to features and looked up."""
    e = table(spark, sf_dir, "embeddings")
    at = F.lit("2024-01-01").cast("timestamp")
    users = e.select(F.col("vec_id").alias("id"), F.when(
        F.col("label") != 3, F.to_json("embedding")).alias("face_embedding"),
        at.alias("created_at"), at.alias("updated_at"))
    online = features.latest_features(features.users_to_features(users))
    keys = e.select(F.col("vec_id").cast("string").alias("employee_id"))
    m = features.embeddings_for_matching(keys, online, "2024-06-01")
    return m.select("employee_id", F.size("embedding").alias("width"),
                    F.round(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0),
                                        lambda a, x: a + x), 5).alias("total"))


# --- metrics ----------------------------------------------------------------------------

def _counter(spark, sf_dir):
    """A counter per event type that restarts after every 1000 events overall."""
    e = table(spark, sf_dir, "events")
    return e.select("event_type", F.col("ts").cast("timestamp").alias("ts"),
                    F.pmod("event_id", F.lit(1000)).cast("double").alias("value"))


def _hour(df, *cols):
    return df.select(ev.iso_text("window_start").alias("window_start"), *cols)


def counter_rate(spark, sf_dir):
    r = metrics.counter_rate(_counter(spark, sf_dir), ["event_type"], ["event_type"], "1 hour",
                             3600)
    return _hour(r, "event_type", F.round("increase", 6).alias("increase"),
                 F.round("rate", 6).alias("rate"))


def instant_rate(spark, sf_dir):
    r = metrics.instant_rate(_counter(spark, sf_dir), ["event_type"])
    return r.select("event_type", F.round("rate", 6).alias("rate"))


def cpu_usage(spark, sf_dir):
    r = metrics.cpu_usage(_counter(spark, sf_dir), ["event_type"])
    return r.select(F.round("cpu_usage", 6).alias("cpu_usage"))


def gauge_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    g = metrics.gauge_latest(e, ["user_id", "event_type"])
    return g.select("user_id", "event_type", "value", ev.iso_text(F.col("ts").cast("timestamp"))
                    .alias("ts"))


def memory_usage(spark, sf_dir):
    """Views stand for the total, clicks for the available memory of a user's machine."""
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "metric")
    m = metrics.memory_usage(e, ["user_id"], "view", "click")
    return m.select("user_id", F.round("memory_usage", 6).alias("memory_usage"))


def _timed(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def predictions_per_minute(spark, sf_dir):
    return _hour(metrics.count_by_window(_timed(spark, sf_dir), [], "1 minute"), "n")


def status_rate(spark, sf_dir):
    n = metrics.count_by_window(_timed(spark, sf_dir), ["event_type"], "5 minutes")
    return _hour(n, "event_type", F.round(F.col("n") / 300, 6).alias("rate"))


def error_rate(spark, sf_dir):
    r = metrics.ratio_by_window(_timed(spark, sf_dir), [], "1 hour",
                                F.col("event_type") == "error")
    return _hour(r, F.round("percent", 6).alias("percent"),
                 metrics.threshold_band("percent", [(None, "green"), (10, "yellow"), (30, "red")])
                 .alias("band"))


def mean_latency(spark, sf_dir):
    t = _timed(spark, sf_dir).withColumn("seconds", F.col("value") / 1000)
    r = metrics.mean_latency_ms(t, ["event_type"], "1 day", "seconds")
    return _hour(r, "event_type", F.round("mean_ms", 10).alias("mean_ms"))


def latency_p95(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type",
                                              (F.col("value") / 1000).alias("seconds"))
    h = summary.latency_histogram(e, ["event_type"], "seconds", EDGES)
    q = metrics.histogram_quantile(h, ["event_type"], 0.95)
    ms = F.round(F.col("quantile") * 1000, 6)
    return q.select("event_type", ms.alias("p95_ms"), metrics.threshold_band(
        ms, [(None, "green"), (150, "yellow"), (200, "red")]).alias("band"))


def sustained_alert(spark, sf_dir):
    """Users whose value stayed above 20 for two hours or more."""
    r = metrics.sustained_alert(_timed(spark, sf_dir), ["user_id"], F.col("value") > 20, 7200)
    return r.select("user_id", "samples", *[ev.iso_text(c).alias(c)
                                            for c in ("start", "end", "fires_at")])


def topic_throughput(spark, sf_dir):
    """Event numbers as offsets of a topic (event type) with a partition per user."""
    e = table(spark, sf_dir, "events")
    offsets = e.select("event_type", "user_id", F.col("ts").cast("timestamp").alias("ts"),
                       F.col("event_id").cast("double").alias("value"))
    r = metrics.counter_rate(offsets, ["event_type", "user_id"], ["event_type"], "1 day", 86400)
    return _hour(r, "event_type", F.round("increase", 6).alias("increase"),
                 F.round("rate", 8).alias("rate"))


def detection_rate(spark, sf_dir):
    """Share of detections by flag in five-minute windows."""
    t = _timed(spark, sf_dir)
    def share(hit):
        return F.try_divide(F.count_if(hit), F.count(F.lit(1))) * 100
    both = (t.groupBy(F.window("ts", "5 minutes").alias("_w"))
            .agg(share(F.col("value") >= 20).alias("detected"), share(F.col("value") < 20).alias("no_face"))
            .select(F.col("_w.start").alias("window_start"), "detected", "no_face"))
    return _hour(both, *[F.round(c, 6).alias(c) for c in ("detected", "no_face")])


def standing_alert(spark, sf_dir):
    """Users whose value stayed above 80 for five minutes or more."""
    r = metrics.standing_alert(_timed(spark, sf_dir), ["user_id"], "HighCPUUsage")
    return r.select("user_id", "samples", *[ev.iso_text(c).alias(c) for c in ("start", "end")])


_F = """feats AS (SELECT CAST(user_id AS VARCHAR) AS employee_id, value AS score,
                         event_id AS version, ts FROM events)"""
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"


def _latest_sql(where):
    return f"""WITH {_F} SELECT employee_id, score, version, {_ISO.format("ts")} AS event_time
        FROM feats WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY ts DESC, version DESC) = 1"""


_COUNTER = """c AS (SELECT event_type, ts, CAST(event_id % 1000 AS DOUBLE) AS v FROM events),
d AS (SELECT *, lag(v) OVER w AS p, lag(ts) OVER w AS pt FROM c
      WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
i AS (SELECT *, CASE WHEN v < p THEN v ELSE v - p END AS inc FROM d),
r AS (SELECT event_type, inc / (epoch_us(ts) - epoch_us(pt)) * 1e6 AS rate FROM i
      QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1)"""


def _bucket(width):
    return _ISO.format(f"time_bucket(INTERVAL '{width}', ts)") + " AS window_start"


QUERIES = {
    "latest_features": (latest_features, _latest_sql("true")),
    "materialize_window": (materialize_window, _latest_sql(
        "ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06'")),
    "incremental_materialize": (incremental_materialize, _latest_sql(
        "ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-10 06:00:00'")),
    "online_lookup": (online_lookup, f"""WITH {_F}, l AS (
        SELECT * FROM feats
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY ts DESC) = 1)
        SELECT CAST(c_custkey AS VARCHAR) AS employee_id, score, version
        FROM customer LEFT JOIN l ON l.employee_id = CAST(c_custkey AS VARCHAR)"""),
    "online_features_ttl": (online_features_ttl, f"""WITH {_F}, l AS (
        SELECT * FROM feats
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY ts DESC) = 1)
        SELECT CAST(c_custkey AS VARCHAR) AS employee_id,
               CASE WHEN ts >= TIMESTAMP '2024-01-29 18:00:00' THEN score END AS score,
               CASE WHEN ts >= TIMESTAMP '2024-01-29 18:00:00' THEN version END AS version
        FROM customer LEFT JOIN l ON l.employee_id = CAST(c_custkey AS VARCHAR)"""),
    "asof_features": (asof_features, f"""WITH {_F}, s AS (
        SELECT o_orderkey, CAST(o_custkey % 200 AS VARCHAR) AS employee_id,
               TIMESTAMP '2024-01-01'
               + to_minutes(CAST(o_orderkey * 7919 % 43200 AS BIGINT)) AS at
        FROM orders)
        SELECT s.o_orderkey, s.employee_id,
               CASE WHEN f.ts >= s.at - INTERVAL 12 HOUR THEN score END AS score,
               CASE WHEN f.ts >= s.at - INTERVAL 12 HOUR THEN version END AS version,
               CASE WHEN f.ts >= s.at - INTERVAL 12 HOUR
                    THEN {_ISO.format("f.ts")} END AS feature_time
        FROM s ASOF LEFT JOIN feats f ON s.employee_id = f.employee_id AND s.at >= f.ts"""),
    "embeddings_for_matching": (embeddings_for_matching, """
        SELECT CAST(vec_id AS VARCHAR) AS employee_id, CAST(len(embedding) AS INTEGER) AS width,
               round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total
        FROM embeddings WHERE label <> 3"""),
    "counter_rate": (counter_rate, f"""WITH {_COUNTER}
        SELECT event_type, {_bucket("1 hour")}, round(coalesce(sum(inc), 0), 6) AS increase,
               round(coalesce(sum(inc), 0) / 3600, 6) AS rate FROM i GROUP BY 1, 2"""),
    "instant_rate": (instant_rate,
                     f"WITH {_COUNTER} SELECT event_type, round(rate, 6) AS rate FROM r"),
    "cpu_usage": (cpu_usage,
                  f"WITH {_COUNTER} SELECT round(100 - avg(rate) * 100, 6) AS cpu_usage FROM r"),
    "gauge_latest": (gauge_latest, f"""
        SELECT user_id, event_type, value, {_ISO.format("ts")} AS ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1"""),
    "memory_usage": (memory_usage, """
        SELECT user_id, round((t - a) / t * 100, 6) AS memory_usage FROM (
          SELECT user_id, arg_max(value, ts) FILTER (event_type = 'view') AS t,
                 arg_max(value, ts) FILTER (event_type = 'click') AS a
          FROM events GROUP BY 1)"""),
    "predictions_per_minute": (predictions_per_minute, f"""
        SELECT {_bucket("1 minute")}, count(*) AS n FROM events GROUP BY 1"""),
    "status_rate": (status_rate, f"""
        SELECT event_type, {_bucket("5 minutes")}, round(count(*) / 300, 6) AS rate
        FROM events GROUP BY 1, 2"""),
    "error_rate": (error_rate, f"""WITH p AS (
        SELECT {_bucket("1 hour")}, count(*) FILTER (event_type = 'error') * 100.0::DOUBLE
               / count(*) AS x FROM events GROUP BY 1)
        SELECT window_start, round(x, 6) AS percent,
               CASE WHEN x >= 30 THEN 'red' WHEN x >= 10 THEN 'yellow' ELSE 'green' END AS band
        FROM p"""),
    "mean_latency": (mean_latency, f"""
        SELECT event_type, {_bucket("1 day")}, round(avg(value), 10) AS mean_ms
        FROM events GROUP BY 1, 2"""),
    "latency_p95": (latency_p95, f"""WITH b AS (
        SELECT event_type, edge, count(*) FILTER (value / 1000 <= edge) AS n, count(*) AS total
        FROM events, (VALUES {", ".join(f"({x}::DOUBLE)" for x in EDGES)}) x(edge)
        GROUP BY 1, 2),
        p AS (SELECT *, coalesce(lag(edge) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS below,
                     max(edge) OVER (PARTITION BY event_type) AS top
              FROM b WINDOW w AS (PARTITION BY event_type ORDER BY edge)),
        h AS (SELECT event_type, min(top) AS top,
                     min_by((lo + (edge - lo) * (0.95 * total - below) / (n - below)), edge)
                       FILTER (n >= 0.95 * total) AS v FROM p GROUP BY 1),
        m AS (SELECT event_type, round(coalesce(v, top) * 1000, 6) AS x FROM h)
        SELECT event_type, x AS p95_ms,
               CASE WHEN x >= 200 THEN 'red' WHEN x >= 150 THEN 'yellow' ELSE 'green' END AS band
        FROM m"""),
    "sustained_alert": (sustained_alert, f"""WITH s AS (
        SELECT user_id, ts, value > 20 AS ok FROM events),
        g AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY user_id ORDER BY ts) AS run
              FROM s),
        r AS (SELECT user_id, run, min(ts) AS a, max(ts) AS b, count(*) AS samples
              FROM g WHERE ok GROUP BY 1, 2)
        SELECT user_id, samples, {_ISO.format("a")} AS start, {_ISO.format("b")} AS "end",
               {_ISO.format("a + INTERVAL 2 HOUR")} AS fires_at
        FROM r WHERE b - a >= INTERVAL 2 HOUR"""),
    "topic_throughput": (topic_throughput, f"""WITH d AS (
        SELECT event_type, ts, CAST(event_id - lag(event_id) OVER (
                 PARTITION BY event_type, user_id ORDER BY ts) AS DOUBLE) AS inc FROM events)
        SELECT event_type, {_bucket("1 day")}, round(coalesce(sum(inc), 0), 6) AS increase,
               round(coalesce(sum(inc), 0) / 86400, 8) AS rate FROM d GROUP BY 1, 2"""),
    "detection_rate": (detection_rate, f"""
        SELECT {_bucket("5 minutes")},
               round(count(*) FILTER (value >= 20) * 100.0::DOUBLE / count(*), 6) AS detected,
               round(count(*) FILTER (value < 20) * 100.0::DOUBLE / count(*), 6) AS no_face
        FROM events GROUP BY 1"""),
    "standing_alert": (standing_alert, f"""WITH s AS (
        SELECT user_id, ts, value > 80 AS ok FROM events),
        g AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY user_id ORDER BY ts) AS run
              FROM s),
        r AS (SELECT user_id, run, min(ts) AS a, max(ts) AS b, count(*) AS samples
              FROM g WHERE ok GROUP BY 1, 2)
        SELECT user_id, samples, {_ISO.format("a")} AS start, {_ISO.format("b")} AS "end"
        FROM r WHERE b - a >= INTERVAL 5 MINUTE"""),
}
