"""Exact best-match and top-k search of query vectors against a gallery.

A gallery whose size has been checked is sent to the executors once and every Arrow batch
of queries is multiplied with it: no shuffle at all. A larger one is cut into blocks;
query blocks meet gallery blocks by an equi cogroup on the block pair, each pair gives only
its own top k per query, and these are reduced with map-side combination. Blocks grow with
the tables up to 32 MB, so that vectors are copied to few tasks. Both ways are exact. Scores are double precision; zero vectors and nulls match nothing; equal scores
go to the earlier gallery entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doorledger.functions.vectors import effective_threshold
from doorledger.session import settled

BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 32 << 20
#: Blocks a side that are enough to occupy the executors; more only where blocks would get larger than BLOCK_BYTES.
_SIDE = 8
_RESULT = ["query_id", "match_id", "match_order", "score"]


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Fixed-length vectors of an Arrow list column as a double matrix."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks)
    n = len(arr)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n and len(flat) % n:
        raise ValueError("vectors differ in length")
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


@dataclass(frozen=True)
class Gallery:
    """Usable gallery vectors in order, with what every query batch needs of them."""

    rows: np.ndarray     # places of the vectors in the original order
    vectors: np.ndarray  # double precision
    square: np.ndarray   # squared norms
    unit: np.ndarray     # single precision, unit length


def _squares(m: np.ndarray) -> np.ndarray:
    return (m * m).sum(axis=1)


def _unit(m: np.ndarray, square: np.ndarray) -> np.ndarray:
    return (m / np.sqrt(square)[:, None]).astype(np.float32)


def gallery_of(matrix: np.ndarray, k: int) -> Gallery:
    """Leaves out vectors without a length, and of equal vectors all but the first ``k``: the
    later ones can never be among a query's k best."""
    square = _squares(matrix)
    rows = np.flatnonzero(np.isfinite(square) & (square > 0))
    if len(rows) > k:
        _, group = np.unique(matrix[rows], axis=0, return_inverse=True)
        by_group = np.argsort(group.ravel(), kind="stable")
        ordered = group.ravel()[by_group]
        place = np.arange(len(ordered)) - np.searchsorted(ordered, ordered, side="left")
        rows = rows[np.sort(by_group[place < k])]
    return Gallery(rows, matrix[rows], square[rows], _unit(matrix[rows], square[rows]))


def _top(queries: np.ndarray, gallery: Gallery, k: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, gallery row, score) of each query's k best, gallery rows in order on ties.

    A single-precision product only selects candidates, with twice its error bound as margin.
    Their scores are then computed pair by pair in double precision, so that equal vectors get
    bit-equal scores wherever they sit in a block.
    """
    square = _squares(queries)
    able = np.flatnonzero(np.isfinite(square) & (square > 0))
    if len(able) == 0 or len(gallery.rows) == 0:
        return np.array([], int), np.array([], int), np.array([])
    sims = _unit(queries[able], square[able]) @ gallery.unit.T
    width = queries.shape[1]
    margin = np.float32(2 * (width + 16) * 6e-8)
    if k == 1:
        cut = sims.max(axis=1)
    elif sims.shape[1] > k:
        cut = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
    else:
        cut = sims.min(axis=1)
    rows, cols = np.divmod(np.flatnonzero(sims >= (cut - margin)[:, None]), sims.shape[1])
    rows = able[rows]
    score = np.empty(len(rows))
    step = max(1, BLOCK_BYTES // (16 * width))
    for at in range(0, len(rows), step):
        r, c = rows[at:at + step], cols[at:at + step]
        score[at:at + step] = ((queries[r] * gallery.vectors[c]).sum(axis=1)
                               / np.sqrt(square[r] * gallery.square[c]))
    order = np.lexsort((cols, -score, rows))
    rows, cols, score = rows[order], cols[order], score[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    best = place < k
    return rows[best], gallery.rows[cols[best]], score[best]


def _prepare(queries: DataFrame, gallery: DataFrame, query_id: str, gallery_id: str,
             order: str | None, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    q = queries.select(F.col(query_id).alias("query_id"), *carry,
                       F.col("embedding"))
    g = gallery.where(F.col("embedding").isNotNull()).select(
        F.col(gallery_id).alias("match_id"), F.col(order or gallery_id).alias("match_order"),
        F.col("embedding"))
    return q, g


def _result_schema(q: DataFrame, g: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("query_id", q.schema["query_id"].dataType),
                         T.StructField("match_id", g.schema["match_id"].dataType),
                         T.StructField("match_order", g.schema["match_order"].dataType),
                         T.StructField("score", T.DoubleType())])


def _slices(n: int, width: int) -> Iterator[tuple[int, int]]:
    """Query rows to multiply at a time, so that the product stays within a block."""
    step = max(1, BLOCK_BYTES // (8 * max(1, width)))
    return ((i, min(step, n - i)) for i in range(0, n, step))


def _share(g: DataFrame, k: int):
    """A gallery of checked size, sent to the executors once."""
    local = g.orderBy("match_order").toArrow()
    return g.sparkSession.sparkContext.broadcast(
        (gallery_of(as_matrix(local["embedding"]), k), local["match_id"].combine_chunks(),
         local["match_order"].combine_chunks()))


def _small(q: DataFrame, g: DataFrame, k: int) -> DataFrame:
    """Ranked top k with a shared gallery, batch by batch and without a shuffle."""
    packed = _share(g, k)
    schema = _result_schema(q, g).add("rank", T.IntegerType())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, ids, orders = packed.value
        if len(ids) == 0:
            return
        for batch in batches:
            for at, n in _slices(batch.num_rows, len(ids)):
                part = batch.slice(at, n)
                rows, cols, score = _top(as_matrix(part["embedding"]), matrix, k)
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
                yield pa.RecordBatch.from_arrays(
                    [*_named(part["query_id"], ids, orders, rows, cols), pa.array(score),
                     pa.array(rank.astype(np.int32))], names=[*_RESULT, "rank"])

    return q.where(F.col("embedding").isNotNull()).mapInArrow(search, schema)


def _small_best(q: DataFrame, g: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Best match of every query with a shared gallery: rows stay where they are, with their
    carried columns, so nothing is shuffled or joined back."""
    packed = _share(g, 1)
    kept = ["query_id", *carry]
    schema = T.StructType([*[q.schema[c] for c in kept],
                           T.StructField("match_id", g.schema["match_id"].dataType),
                           T.StructField("score", T.DoubleType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, ids, _ = packed.value
        for batch in batches:
            for at, n in _slices(batch.num_rows, len(ids)):
                part = batch.slice(at, n)
                usable = np.flatnonzero(part["embedding"].is_valid().to_numpy(
                    zero_copy_only=False))
                place = np.full(n, -1)
                score = np.full(n, np.nan)
                if len(usable) and len(ids):
                    vectors = as_matrix(part["embedding"].take(pa.array(usable)))
                    rows, cols, best = _top(vectors, matrix, 1)
                    place[usable[rows]], score[usable[rows]] = cols, best
                none = place < 0
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in kept],
                     ids.take(pa.array(place, mask=none)), pa.array(score, mask=none)],
                    names=[*kept, "match_id", "score"])

    return q.mapInArrow(search, schema)


def _answer(qids: pa.Array, qmat: np.ndarray, ids: pa.Array, orders: pa.Array,
            matrix: Gallery, k: int) -> pa.RecordBatch:
    rows, cols, score = _top(qmat, matrix, k)
    return pa.RecordBatch.from_arrays(
        [*_named(qids, ids, orders, rows, cols), pa.array(score)], names=_RESULT)


def _named(qids: pa.Array, ids: pa.Array, orders: pa.Array, rows: np.ndarray, cols: np.ndarray
           ) -> list[pa.Array]:
    """Ids of the found query and gallery rows."""
    at, to = pa.array(rows, pa.int64()), pa.array(cols, pa.int64())
    return [qids.take(at), ids.take(to), orders.take(to)]


def _blocked(q: DataFrame, g: DataFrame, k: int, q_blocks: int, g_blocks: int) -> DataFrame:
    """Gallery of any size: every (query block, gallery block) pair is one group."""
    def place(key: str, n: int):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = (q.where(F.col("embedding").isNotNull())
            .withColumn("qb", place("query_id", q_blocks)).withColumn("gb", every(g_blocks)))
    right = g.withColumn("gb", place("match_id", g_blocks)).withColumn("qb", every(q_blocks))

    schema = _result_schema(q, g)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by("match_order")
        if a.num_rows == 0 or b.num_rows == 0:
            return pa.Table.from_arrays([a["query_id"].slice(0, 0), b["match_id"].slice(0, 0),
                                         b["match_order"].slice(0, 0), pa.array([], pa.float64())],
                                        names=_RESULT)
        ids, orders = b["match_id"].combine_chunks(), b["match_order"].combine_chunks()
        qids, qmat = a["query_id"].combine_chunks(), as_matrix(a["embedding"])
        gmat = gallery_of(as_matrix(b["embedding"]), k)
        return pa.Table.from_batches(
            [_answer(qids.slice(i, n), qmat[i:i + n], ids, orders, gmat, k)
             for i, n in _slices(len(qmat), len(ids))])

    partial = (left.groupBy("qb", "gb").cogroup(right.groupBy("qb", "gb"))
               .applyInArrow(search, schema))
    if k == 1:
        # highest score, then lowest order: reduced before the shuffle
        best = F.min(F.struct((-F.col("score")).alias("s"), "match_order", "match_id"))
        return (partial.groupBy("query_id").agg(best.alias("b"))
                .select("query_id", "b.match_id", "b.match_order", (-F.col("b.s")).alias("score")))
    return partial


def _measure(g: DataFrame) -> tuple[int, int]:
    """Vectors in the gallery and their width."""
    return tuple(g.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0)))
                 .first())


def _fits(n: int, width: int, limit: int) -> bool:
    return n * (width * 8 + 64) <= limit


_ROW = "_row"


def _rowed(q: DataFrame) -> DataFrame:
    """The queries, stored once with a number per row."""
    return settled(q.withColumn(_ROW, F.monotonically_increasing_id()))


def _by_row(q: DataFrame) -> DataFrame:
    return q.select(F.col(_ROW).alias("query_id"), "embedding")


def _large(q: DataFrame, g: DataFrame, k: int, n: int, width: int, block_bytes: int) -> DataFrame:
    return _blocked(q, g, k, _blocks(q.count(), width, block_bytes), _blocks(n, width, block_bytes))


def _blocks(n: int, width: int, block_bytes: int) -> int:
    """Blocks of a side. Every vector is sent once per block of the other side, so large tables take larger blocks."""
    def of(size: int) -> int:
        return max(1, math.ceil(n / max(1, size // (8 * max(1, width)))))
    return min(of(block_bytes), max(_SIDE, of(max(block_bytes, BLOCK_BYTES))))


def best_match(queries: DataFrame, gallery: DataFrame, threshold: float | None = None,
               query_id: str = "query_id", gallery_id: str = "match_id",
               gallery_order: str | None = None, carry: Sequence[str] = (),
               broadcast_bytes: int = BROADCAST_BYTES, block_bytes: int = BLOCK_BYTES
               ) -> DataFrame:
    """Per query: ``match_id`` if its best cosine reaches the threshold, and that ``score``,
    with the ``carry`` columns of the queries.

    An empty gallery gives (null, null). A query with no usable score, or whose best is
    exactly -1, gives (null, -1). None and 0 mean the default threshold. Query ids may repeat
    or be null; every query row has its own answer. ``block_bytes`` is the least size of the blocks of a gallery too large
    to share.
    """
    limit = effective_threshold(threshold)
    q, g = _prepare(queries, gallery, query_id, gallery_id, gallery_order, carry)
    size, width = _measure(g)
    if _fits(size, width, broadcast_bytes):
        best = _small_best(q, g, carry)
    else:
        q = _rowed(q)
        found = _large(_by_row(q), g, 1, size, width, block_bytes)
        best = q.drop("embedding").join(
            found.select(F.col("query_id").alias(_ROW), "match_id", "score"), _ROW, "left")
    score = F.coalesce("score", F.lit(-1.0)) if size else F.lit(None).cast("double")
    hit = (F.col("score") > -1) & (F.col("score") >= limit)
    return best.select("query_id", *carry, F.when(hit, F.col("match_id")).alias("match_id"),
                       score.alias("score"))


def top_k_matches(queries: DataFrame, gallery: DataFrame, k: int, query_id: str = "query_id",
                  gallery_id: str = "match_id", gallery_order: str | None = None,
                  broadcast_bytes: int = BROADCAST_BYTES,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k highest cosines per query, ranked from 1."""
    q, g = _prepare(queries, gallery, query_id, gallery_id, gallery_order)
    size, width = _measure(g)
    if _fits(size, width, broadcast_bytes):
        return _small(q, g, k).select("query_id", "rank", "match_id", "score")
    q = _rowed(q)
    found = _large(_by_row(q), g, k, size, width, block_bytes)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "match_order")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return (ranked.withColumnRenamed("query_id", _ROW).join(q.select(_ROW, "query_id"), _ROW)
            .select("query_id", "rank", "match_id", "score"))


def gallery_with_fallback(online: DataFrame, offline: DataFrame) -> DataFrame:
    """The online vectors if there are any at all, otherwise the whole offline set."""
    usable = online.where(F.col("embedding").isNotNull())
    return offline.where(F.col("embedding").isNotNull()) if usable.isEmpty() else usable
