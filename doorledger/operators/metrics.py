"""Rates, quantiles, ratios and sustained conditions over metric samples.

Samples are rows with key columns that name a series, a time ``ts`` and a ``value``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doorledger.operators.ordered import HOUR_MS, last_so_far


def series_id(labels: Column | str) -> Column:
    """A label map as text, whatever the order of its entries."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def _ms(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def counter_increase(samples: DataFrame, keys: Sequence[str], ts: str = "ts",
                     value: str = "value", block_ms: int = HOUR_MS) -> DataFrame:
    """Add ``prev_ts``, ``prev_value`` and ``increase`` since the series' previous sample.

    A counter that went down has restarted from zero. The first sample has no increase.
    """
    rows = samples.withColumn("_us", _ms(ts)).withColumn(
        "_s", F.struct(F.col("_us").alias("u"), F.col(value).alias("v"), F.col(ts).alias("t")))
    rows = last_so_far(rows, keys, "_us", ["_us", "_s"], "_s", "_p", inclusive=False,
                       block_ms=block_ms * 1000)
    prev, now = F.col("_p.v"), F.col(value)
    return rows.select(
        *samples.columns, F.col("_p.t").alias("prev_ts"), prev.alias("prev_value"),
        F.when(now < prev, now).otherwise(now - prev).alias("increase"))


def counter_rate(samples: DataFrame, keys: Sequence[str], by: Sequence[str], window: str,
                 seconds: float, ts: str = "ts", value: str = "value") -> DataFrame:
    """Per ``by`` and tumbling window: total increase and increase per second."""
    inc = counter_increase(samples, keys, ts, value)
    return (inc.groupBy(*by, F.window(ts, window).alias("_w"))
            .agg(F.coalesce(F.sum("increase"), F.lit(0)).alias("increase"))
            .select(*by, F.col("_w.start").alias("window_start"), "increase",
                    (F.col("increase") / F.lit(float(seconds))).alias("rate")))


def instant_rate(samples: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                 at: str | None = None, look_back: float = 300.0) -> DataFrame:
    """Per series: rate between its last two samples.

    With ``at`` only samples of the ``look_back`` seconds up to that time count, and a series
    that has stopped before has no rate. Earlier history is then filtered out before any sort.
    """
    if at is not None:
        seconds = F.unix_micros(F.lit(at).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
        samples = samples.where(seconds.between(0, int(look_back * 1e6)))
    inc = counter_increase(samples, keys, ts, value)
    last = F.max(F.struct(F.col(ts).alias("t"), F.col("prev_ts").alias("p"),
                          F.col("increase").alias("i"))).alias("l")
    span = (F.unix_micros(F.col("l.t").cast("timestamp"))
            - F.unix_micros(F.col("l.p").cast("timestamp"))) / 1e6
    return (inc.groupBy(*keys).agg(last)
            .select(*keys, F.try_divide(F.col("l.i"), span).alias("rate")))


def cpu_usage(idle_samples: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Busy percentage from idle-time counters: 100 - 100 * mean idle rate."""
    return instant_rate(idle_samples, keys).groupBy(*by).agg(
        (100 - F.avg("rate") * 100).alias("cpu_usage"))


def gauge_latest(samples: DataFrame, keys: Sequence[str], ts: str = "ts",
                 value: str = "value") -> DataFrame:
    last = F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))).alias("l")
    return samples.groupBy(*keys).agg(last).select(*keys, F.col("l.t").alias(ts),
                                                   F.col("l.v").alias(value))


def memory_usage(samples: DataFrame, keys: Sequence[str], total: str, available: str) -> DataFrame:
    """Used percentage from the latest ``total`` and ``available`` gauges of each key."""
    def newest(metric: str) -> Column:
        mine = F.col("metric") == metric
        return F.max(F.when(mine, F.struct("ts", "value")))["value"]
    both = samples.groupBy(*keys).agg(newest(total).alias("_t"), newest(available).alias("_a"))
    return both.select(*keys, (F.try_divide(F.col("_t") - F.col("_a"), F.col("_t")) * 100)
                       .alias("memory_usage"))


def histogram_quantile(buckets: DataFrame, keys: Sequence[str], q: float,
                       le: str = "le", n: str = "n") -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket that holds the rank.

    A rank in the infinite bucket gives the highest finite edge; an empty histogram gives null.
    The window runs over one key's edges only.
    """
    w = Window.partitionBy(*keys).orderBy(le)
    whole = Window.partitionBy(*keys)
    rows = buckets.select(
        *keys, F.col(le).alias("_le"), F.col(n).cast("double").alias("_n"),
        F.coalesce(F.lag(le).over(w), F.least(F.col(le), F.lit(0.0))).alias("_lo"),
        F.coalesce(F.lag(F.col(n).cast("double")).over(w), F.lit(0.0)).alias("_below"),
        F.max(F.col(n).cast("double")).over(whole).alias("_total"),
        F.max(F.when(F.col(le) < float("inf"), F.col(le))).over(whole).alias("_top"))
    rank = F.col("_total") * q
    share = F.coalesce(F.try_divide(rank - F.col("_below"), F.col("_n") - F.col("_below")),
                       F.lit(0.0))
    inside = F.when(F.col("_le") == float("inf"), F.col("_top")).otherwise(
        F.col("_lo") + (F.col("_le") - F.col("_lo")) * share)
    first = F.min(F.when((F.col("_total") > 0) & (F.col("_n") >= rank),
                         F.struct("_le", inside.alias("v"))))
    return rows.groupBy(*keys).agg(first["v"].alias("quantile"))


def ratio_by_window(df: DataFrame, by: Sequence[str], window: str, part: Column, ts: str = "ts",
                    out: str = "percent") -> DataFrame:
    """Share of rows with ``part`` per window, in percent: error rate, detection rate."""
    share = F.try_divide(F.count_if(part), F.count(F.lit(1))) * 100
    return (df.groupBy(*by, F.window(ts, window).alias("_w")).agg(share.alias(out))
            .select(*by, F.col("_w.start").alias("window_start"), out))


def mean_latency_ms(df: DataFrame, by: Sequence[str], window: str, seconds: str,
                    ts: str = "ts") -> DataFrame:
    mean = F.try_divide(F.sum(seconds), F.count(seconds)) * 1000
    return (df.groupBy(*by, F.window(ts, window).alias("_w")).agg(mean.alias("mean_ms"))
            .select(*by, F.col("_w.start").alias("window_start"), "mean_ms"))


def count_by_window(df: DataFrame, by: Sequence[str], window: str, ts: str = "ts") -> DataFrame:
    """Rows per window, such as predictions per minute."""
    return (df.groupBy(*by, F.window(ts, window).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
            .select(*by, F.col("_w.start").alias("window_start"), "n"))


def threshold_band(value: Column | str, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the last step whose lower bound the value reaches; the first has no bound."""
    value = F.col(value) if isinstance(value, str) else value
    band = F.lit(None).cast("string")
    for bound, name in steps:
        band = (F.when(value.isNotNull(), F.lit(name)) if bound is None
                else F.when(value >= bound, F.lit(name)).otherwise(band))
    return band


def sustained_alert(samples: DataFrame, keys: Sequence[str], holds: Column, seconds: int,
                    ts: str = "ts", block_ms: int = HOUR_MS) -> DataFrame:
    """Runs of consecutive samples that satisfy ``holds`` for at least ``seconds``.

    A run is named by the last sample before it that does not, so it is found by one
    last-value pass and one partially aggregated group-by, however long it is.
    """
    ok = F.coalesce(holds, F.lit(False))
    rows = (samples.withColumn("_us", _ms(ts)).withColumn("_ok", ok)
            .select(*keys, ts, "_us", "_ok",
                    F.when(~F.col("_ok"), F.struct(F.col("_us").alias("u"))).alias("_no")))
    rows = last_so_far(rows, keys, "_us", ["_us", "_ok"], "_no", "_after",
                       block_ms=block_ms * 1000)
    runs = (rows.where("_ok").groupBy(*keys, F.col("_after.u").alias("_run"))
            .agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                 F.count(F.lit(1)).alias("samples"), F.min("_us").alias("_a"),
                 F.max("_us").alias("_b")))
    return (runs.where(F.col("_b") - F.col("_a") >= seconds * 1_000_000)
            .select(*keys, "start", "end", "samples",
                    (F.col("start") + F.make_dt_interval(secs=F.lit(float(seconds))))
                    .alias("fires_at")))


# fixed values: standing conditions, as (comparison, limit, seconds it must hold)
STANDING_CONDITIONS = {
    "HighErrorRate": (">", 0.05, 300),
    "HighLatency": (">", 1.0, 300),
    "APIDown": ("==", 0.0, 120),
    "LowFaceDetectionRate": ("<", 0.5, 600),
    "HighMemoryUsage": (">", 0.9, 300),
    "HighCPUUsage": (">", 80.0, 300),
    "DatabaseConnectionFailure": ("==", 0.0, 60),
    "KafkaHighLag": (">", 1000.0, 600),
    "FlinkJobDown": ("==", 0.0, 120),
}


def standing_alert(samples: DataFrame, keys: Sequence[str], condition: str, ts: str = "ts",
                   value: str = "value") -> DataFrame:
    """Runs in which a named standing condition held long enough."""
    comparison, limit, seconds = STANDING_CONDITIONS[condition]
    v = F.col(value)
    holds = {">": v > limit, "<": v < limit, "==": v == limit}[comparison]
    return sustained_alert(samples, keys, holds, seconds, ts)
