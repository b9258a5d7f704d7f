"""Exact quantiles of scalar values per key, in two rounds of counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: cells per factor e of a value's size
_FINE = 1024


def _cell(value: str) -> Column:
    """A number that never falls as the value rises."""
    v = F.col(value)
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * _FINE)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """(keys, q, value): each quantile, linear between the two values next to its rank.

    The first round counts cells of nearby values per key and finds those that hold a wanted rank, the second
    counts the values of these cells only. Both are reduced before their shuffle and nothing holds a key's values, so
    a key may have any number of rows. Null and NaN values do not count; a key without others gives no row.
    """
    if not qs or any(not 0 <= q <= 1 for q in qs):
        raise ValueError("quantiles lie between 0 and 1")
    rows = (df.select(F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])).alias("_k"),
                      F.struct(*keys).alias("_keys") if keys else F.lit(None).alias("_keys"), F.col(value).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_cell", _cell("_v")))
    cells = rows.groupBy("_k", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.any_value("_keys").alias("_keys"))
    key = Window.partitionBy("_k")
    below = F.coalesce(F.sum("_n").over(key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = cells.withColumn("_below", below).withColumn("_total", F.sum("_n").over(key))
    last = F.col("_total") - 1
    ranks = F.array_distinct(F.array(*[f(last * q).cast("bigint") for q in qs for f in (F.floor, F.ceil)]))
    mine = F.filter(ranks, lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_n")))
    wanted = counted.select("_k", "_cell", "_keys", "_below", "_total", mine.alias("_ranks")).where("size(_ranks) > 0")
    exact = (rows.select("_k", "_cell", "_v").join(wanted.select("_k", "_cell"), ["_k", "_cell"], "left_semi")
             .groupBy("_k", "_cell", "_v").agg(F.count(F.lit(1)).alias("_n")))
    inside = Window.partitionBy("_k", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = exact.withColumn("_upto", F.sum("_n").over(inside))
    met = upto.join(wanted, ["_k", "_cell"])
    top = F.col("_below") + F.col("_upto")
    hit = met.withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r < top) & (r >= top - F.col("_n")))))
    # at most two ranks per quantile and key
    found = hit.groupBy("_k").agg(F.any_value("_keys").alias("_keys"), F.any_value("_total").alias("_total"),
                                  F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    out = found.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    rank = (F.col("_total") - 1) * F.col("q")
    low, high = (F.element_at("_at", f(rank).cast("bigint")) for f in (F.floor, F.ceil))
    return out.select(*[F.col(f"_keys.{k}").alias(k) for k in keys], "q", (low + (high - low) * (rank - F.floor(rank))).alias(value))
