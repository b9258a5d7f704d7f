"""Joining rows with one row per key when a key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.session import settled

SALTS = 64
MOST_BROADCAST_KEYS = 1_000_000


def large_keys(rows: DataFrame, key: str, limit: int) -> DataFrame | None:
    """(key, _n) of the keys with more than ``limit`` rows, None when there are none.

    There are at most rows / limit of them.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    large = settled(counts)
    n = large.count()
    if n == 0:
        return None
    return F.broadcast(large) if n <= MOST_BROADCAST_KEYS else large


def attach(rows: DataFrame, small: DataFrame, key: str, large: DataFrame | None,
           spread_by: str) -> DataFrame:
    """``rows`` inner-joined with ``small``, which has at most one row per key.

    Rows of large keys are dealt over salts by ``spread_by`` and their row of ``small`` is
    repeated for each salt, so that no task receives such a key as a whole.
    """
    if large is None:
        return rows.join(small, key)
    names = large.select(key)
    cold = rows.join(names, key, "left_anti").join(small, key)
    dealt = rows.join(names, key, "left_semi").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    repeated = small.join(names, key, "left_semi").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return cold.unionByName(dealt.join(repeated, [key, "_salt"]).drop("_salt"))
