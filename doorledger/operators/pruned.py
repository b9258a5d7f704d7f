"""Exact best match that visits only those blocks of a large gallery that can hold it.

Gallery vectors, at unit length, go to the nearest of some centres drawn from them; a block is known by its centre and
radius. A query first looks into the block of its nearest centre, and what it finds there is a bound: by the
triangle inequality no vector of a block is nearer than its centre's distance less the radius, so blocks beyond the
bound are left out. The answers equal those of comparing everything; how much is saved depends on how the vectors
cluster, and is reported per query as ``visited``.

Only centres and radii go to all tasks, at most ``MOST_CENTRES`` of them and ``INDEX_BYTES``. Large blocks are cut into parts and
the queries of one block into shares, so that no group is larger than about ``rows`` queries and ``rows`` vectors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doorledger.functions.vectors import effective_threshold
from doorledger.operators import similarity as sim
from doorledger.session import settled

MOST_CENTRES, INDEX_BYTES = 4096, 32 << 20
#: more than the rounding of distances at unit length
_EDGE = 1e-6


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and which rows have one."""
    m = sim.as_matrix(column)
    square = (m * m).sum(axis=1)
    able = np.isfinite(square) & (square > 0)
    return m / np.sqrt(np.where(able, square, 1.0))[:, None], able


def _distances(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (unit @ centres.T)))


def _nearest(rows: DataFrame, index) -> DataFrame:
    """``rows`` with the block of the nearest centre and the distance to it; rows without a direction are left out."""
    schema = T.StructType([*rows.schema, T.StructField("block", T.IntegerType()), T.StructField("far", T.DoubleType())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            unit, able = _units(b.column(b.schema.get_field_index("embedding")))
            far = _distances(unit, index.value)
            block = far.argmin(axis=1)
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(block, pa.int32()), pa.array(far[np.arange(len(block)), block])],
                                             names=[*b.schema.names, "block", "far"])
            yield out.filter(pa.array(able))

    return rows.where(F.col("embedding").isNotNull()).mapInArrow(run, schema)


def _visit(asked: DataFrame, gallery: DataFrame, parts: DataFrame, rows: int) -> DataFrame:
    """Best of each asked (query, block): (query_id, match_id, match_order, score, visited), one row per part of the block."""
    shares = F.broadcast(asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("shares")))
    left = (asked.select("query_id", "embedding", "block").join(F.broadcast(parts.select("block", "parts")), "block").join(shares, "block")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("share", F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int")).drop("parts", "shares"))
    right = (gallery.join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
             .select("match_id", "match_order", "embedding", "block", "part", "share"))
    schema = T.StructType([*sim._result_schema(asked, gallery), T.StructField("visited", T.LongType())])

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return none(a, b)
        b = b.sort_by("match_order")
        ids, orders = b["match_id"].combine_chunks(), b["match_order"].combine_chunks()
        qids, qmat = a["query_id"].combine_chunks(), sim.as_matrix(a["embedding"])
        gmat = sim.gallery_of(sim.as_matrix(b["embedding"]), 1)
        found = pa.Table.from_batches([sim._answer(qids.slice(i, n), qmat[i:i + n], ids, orders, gmat, 1)
                                       for i, n in sim._slices(len(qmat), len(ids))])
        return found.append_column("visited", pa.array(np.full(found.num_rows, b.num_rows)))

    def none(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.Table.from_arrays([a["query_id"].slice(0, 0), b["match_id"].slice(0, 0), b["match_order"].slice(0, 0),
                                     pa.array([], pa.float64()), pa.array([], pa.int64())], names=[*sim._RESULT, "visited"])

    keys = ("block", "part", "share")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def _best(found: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("score")).alias("s"), "match_order", "match_id")).alias("b")
    return (found.groupBy("query_id").agg(best, F.sum("visited").alias("visited"))
            .select("query_id", "b.match_id", "b.match_order", (-F.col("b.s")).alias("score"), "visited"))


def pruned_best_match(queries: DataFrame, gallery: DataFrame, threshold: float | None = None, query_id: str = "query_id",
                      gallery_id: str = "match_id", gallery_order: str | None = None, carry: Sequence[str] = (),
                      centres: int | None = None, rows: int = 4096) -> DataFrame:
    """As ``similarity.best_match``, with ``visited``: how many gallery vectors the query was compared with."""
    spark = queries.sparkSession
    limit = effective_threshold(threshold)
    q, g = sim._prepare(queries, gallery, query_id, gallery_id, gallery_order, carry)
    size, width = sim._measure(g)
    q = sim._rowed(q)
    score, hit = F.lit(None).cast("double"), F.lit(False)
    best = None
    usable = g.where(F.exists("embedding", lambda x: x != 0))
    most = max(1, min(MOST_CENTRES, INDEX_BYTES // (8 * max(1, width)), centres or math.isqrt(size) + 1))
    drawn = usable.orderBy(F.xxhash64("match_order", "match_id")).limit(most).select("embedding").toArrow() if size else None
    if drawn is not None and drawn.num_rows:
        unit, able = _units(drawn["embedding"].combine_chunks())
        index = spark.sparkContext.broadcast(unit[able])
        placed = settled(_nearest(usable, index))
        blocks = settled(placed.groupBy("block").agg(F.max("far").alias("radius"), F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts")))
        placed = placed.join(F.broadcast(blocks.select("block", "parts")), "block").withColumn(
            "part", F.pmod(F.xxhash64("match_order", "match_id"), F.col("parts")).cast("int"))
        radius = np.full(len(index.value), -np.inf)  # a centre without vectors is never visited
        for r in blocks.select("block", "radius").collect():  # at most `most` rows
            radius[r.block] = r.radius
        kept = np.flatnonzero(np.isfinite(radius))
        held = spark.sparkContext.broadcast((kept, index.value[kept], radius[kept]))
        own = spark.sparkContext.broadcast(index.value[kept])
        home = settled(_nearest(sim._by_row(q), own).drop("far").withColumn(
            "block", F.element_at(F.array(*[F.lit(int(k)) for k in kept]), F.col("block") + 1)))
        first = settled(_best(_visit(home, placed, blocks, rows)))

        def others(batches):
            """The blocks besides its own that may hold something as near as what the query has found."""
            number, centre, reach = held.value
            for b in batches:
                if not b.num_rows:
                    continue
                col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
                unit, _ = _units(col["embedding"])
                bound = np.sqrt(np.maximum(0.0, 2 - 2 * col["score"].to_numpy()))
                near = _distances(unit, centre) - reach <= bound[:, None] + _EDGE
                near &= number[None, :] != col["block"].to_numpy()[:, None]
                row, at = np.nonzero(near)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([col["query_id"].take(take), col["embedding"].take(take), pa.array(number[at], pa.int32())],
                                                 names=["query_id", "embedding", "block"])

        asked = settled(home.join(first.select("query_id", "score"), "query_id").select("query_id", "embedding", "block", "score")
                        .mapInArrow(others, T.StructType([home.schema[c] for c in ("query_id", "embedding", "block")])))
        best = _best(first.unionByName(_visit(asked, placed, blocks, rows)))
        score = F.coalesce("score", F.lit(-1.0))
        hit = (F.col("score") > -1) & (F.col("score") >= limit)
    elif size:
        score = F.lit(-1.0)
    if best is None:
        return q.select("query_id", *carry, F.lit(None).cast(g.schema["match_id"].dataType).alias("match_id"), score.alias("score"),
                        F.lit(0).cast("long").alias("visited"))
    joined = q.drop("embedding").join(best.select(F.col("query_id").alias(sim._ROW), "match_id", "score", "visited"), sim._ROW, "left")
    return joined.select("query_id", *carry, F.when(hit, F.col("match_id")).alias("match_id"), score.alias("score"),
                         F.coalesce("visited", F.lit(0)).alias("visited"))
