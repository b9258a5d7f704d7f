"""Ordered per-key work (running totals, last value so far) that splits hot keys over time.

A plain window over a key sorts the whole history of that key in one task. Here every key
is cut into time blocks. Rows are windowed inside (key, block); what earlier blocks
contribute is reduced to one row per (key, block) with map-side partial aggregation,
accumulated over that short table and joined back. The result is exact and one key
holding a third of the rows spreads over as many tasks as it has blocks.

A null key is a key like any other. Times must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
_BLK = "_blk"


def block_of(ms: Column | str, width: int) -> Column:
    """Start of the block that holds ``ms`` (right for negative values too)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms - F.pmod(ms, F.lit(width))


def fitting_block_ms(rows: DataFrame, keys: Sequence[str], ms: str,
                     most_rows: int = 5_000_000, widest: int = HOUR_MS) -> int:
    """Block width at which the densest (key, block) holds about ``most_rows`` rows.

    One narrow scan, reduced before its shuffle. For data that is denser than usual, such as a
    day in which one key sends a large share of everything; pass the result as ``block_ms``.
    """
    counts = rows.groupBy(*keys, block_of(ms, widest)).agg(F.count(F.lit(1)).alias("_n"))
    densest = counts.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]
    return max(1, min(widest, widest * most_rows // max(1, densest)))


def _with_parts(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Two columns per key, never null, that windows, aggregates and the join all use.

    Plain equality of these lets the join take over the partitioning and order of the window.
    """
    parts = {}
    for i, k in enumerate(keys):
        parts[f"_key{i}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        parts[f"_null{i}"] = F.col(k).isNull()
    return rows.withColumns(parts), list(parts)


def _join_blocks(rows: DataFrame, blocks: DataFrame, parts: Sequence[str]) -> DataFrame:
    return rows.join(blocks, [*parts, _BLK], "left")


def running_total(rows: DataFrame, keys: Sequence[str], ms: str, order: Sequence[str | Column],
                  delta: str, out: str, block_ms: int = HOUR_MS) -> DataFrame:
    """Add ``out``: the sum of ``delta`` over the key's rows up to and including this one.

    ``order`` orders rows that share a block and must start with ``ms``.
    """
    rows, parts = _with_parts(rows.withColumn(_BLK, block_of(ms, block_ms)), keys)
    totals = rows.groupBy(*parts, _BLK).agg(F.sum(delta).alias("_total"))
    before = Window.partitionBy(*parts).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.select(*parts, _BLK, F.sum("_total").over(before).alias("_before"))
    inside = (Window.partitionBy(*parts, _BLK).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    local = rows.withColumn("_local", F.sum(delta).over(inside))
    return (_join_blocks(local, blocks, parts)
            .withColumn(out, F.coalesce("_before", F.lit(0)) + F.col("_local"))
            .drop(_BLK, "_before", "_local", *parts))


def last_so_far(rows: DataFrame, keys: Sequence[str], ms: str, order: Sequence[str | Column],
                value: str, out: str, inclusive: bool = True, rank: Column | None = None,
                block_ms: int = HOUR_MS) -> DataFrame:
    """Add ``out``: the key's latest non-null ``value`` up to this row.

    ``value`` must be a struct whose leading fields follow ``order`` (its maximum in a block
    is the last one there), unless ``rank`` names another ordering for it.
    With ``inclusive=False`` the row's own value is not considered.
    """
    rows, parts = _with_parts(rows.withColumn(_BLK, block_of(ms, block_ms)), keys)
    last = (F.max(value) if rank is None else
            F.max_by(F.col(value), F.when(F.col(value).isNotNull(), rank)))
    per_block = rows.groupBy(*parts, _BLK).agg(last.alias("_last"))
    before = Window.partitionBy(*parts).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_block.select(*parts, _BLK,
                              F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = (Window.partitionBy(*parts, _BLK).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = rows.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    return (_join_blocks(local, blocks, parts)
            .withColumn(out, F.coalesce("_local", "_carry"))
            .drop(_BLK, "_local", "_carry", *parts))
