"""One vector per request: same-person check and element-wise median.

Requests normally hold a handful of images, but one may hold a large share of all rows.
Small requests are handled together, batch-wise; a request above ``group_limit`` images is
spread over tasks, and every step on it is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doorledger.functions import vectors as v
from doorledger.operators.similarity import as_matrix
from doorledger.operators.skew import attach, large_keys

# fixed value of the onboarding rules
MAX_DISTANCE = 0.4
GROUP_LIMIT = 20_000
_EDGE = 1e-9


def _sizes(images: DataFrame, key: str) -> DataFrame:
    return images.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


# --- median -----------------------------------------------------------------------------

def pool_embeddings(images: DataFrame, key: str = "request_id", pos: str = "pos",
                    group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(key, embedding array<float>, images): element-wise median of each request's vectors.

    ``pos`` tells a request's images apart when they are spread over tasks; without such a
    column their vectors do.
    """
    apart = F.col(pos) if pos in images.columns else F.xxhash64("embedding")
    images = images.where(F.col("embedding").isNotNull()).select(
        key, F.col("embedding").cast("array<float>").alias("embedding"), apart.alias("_pos"))
    large = large_keys(images, key, group_limit)
    if large is None:
        return _pool_small(images, key)
    small = images.join(large.select(key), key, "left_anti")
    return _pool_small(small, key).unionByName(_pool_large(images, large, key))


def _pool_small(images: DataFrame, key: str) -> DataFrame:
    """Requests lie whole and sorted in one partition; equal-sized ones are pooled at once."""
    schema = T.StructType([images.schema[key], images.schema["embedding"],
                           T.StructField("images", T.LongType())])

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if tail is None else pa.concat_tables([tail, part])
            starts = _starts(part[key])
            # the last request may go on in the next batch
            cut = int(starts[-1]) if len(starts) else 0
            if cut:
                yield _pool_table(part.slice(0, cut), key, starts[:-1])
            tail = part.slice(cut)
        if tail is not None and tail.num_rows:
            yield _pool_table(tail, key, np.array([0]))

    return (images.select(key, "embedding").repartition(key).sortWithinPartitions(key)
            .mapInArrow(pool, schema))


def _starts(col: pa.ChunkedArray) -> np.ndarray:
    ids = col.combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks)
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else \
        np.array([], dtype=int)


def _pool_table(part: pa.Table, key: str, starts: np.ndarray) -> pa.RecordBatch:
    matrix = as_matrix(part["embedding"])
    sizes = np.diff(np.append(starts, part.num_rows))
    out = np.empty((len(starts), matrix.shape[1]))
    for n in np.unique(sizes):
        which = np.flatnonzero(sizes == n)
        rows = starts[which][:, None] + np.arange(n)
        out[which] = np.median(matrix[rows], axis=1)
    return _vector_batch(part[key].take(pa.array(starts)).combine_chunks(), key, out, sizes)


def _vector_batch(ids: pa.Array, key: str, matrix: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(0, matrix.size + 1, max(1, matrix.shape[1]), dtype=np.int32)
    flat = pa.array(matrix.astype(np.float32).ravel())
    return pa.RecordBatch.from_arrays(
        [ids, pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(sizes.astype(np.int64))],
        names=[key, "embedding", "images"])


def _to_code(m: np.ndarray) -> np.ndarray:
    """Float32 values as unsigned integers in the same order."""
    bits = np.ascontiguousarray(m, dtype=np.float32).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint32)


def _from_code(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.uint32)
    bits = np.where(code >> 31, code ^ np.uint32(1 << 31), ~code).astype(np.uint32)
    return bits.view(np.float32).astype(np.float64)


_CELL = "_pos int, _hi int, _lo int, _cnt bigint"


def _histogram(images: DataFrame, key: str, wanted: bool) -> DataFrame:
    """Counts per (key, position, upper half[, lower half]) of the value codes.

    Each Arrow batch is counted in NumPy before anything is emitted. With ``wanted`` only
    values in the two upper halves named per position by ``_w1``/``_w2`` are counted.
    """
    schema = f"`{key}` {images.schema[key].dataType.simpleString()}, {_CELL}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.Table.from_batches([batch]).sort_by(key)
            starts = _starts(part[key])
            codes = _to_code(as_matrix(part["embedding"]))
            for i, at in enumerate(starts):
                end = starts[i + 1] if i + 1 < len(starts) else part.num_rows
                block = codes[at:end]
                pos = np.broadcast_to(np.arange(block.shape[1]), block.shape)
                hi, lo = (block >> 16).astype(np.int64), (block & 0xFFFF).astype(np.int64)
                if wanted:
                    w1 = np.array(part["_w1"][int(at)].as_py())
                    w2 = np.array(part["_w2"][int(at)].as_py())
                    keep = (hi == w1) | (hi == w2)
                    cell = (pos[keep].astype(np.int64) << 32) | (hi[keep] << 16) | lo[keep]
                else:
                    cell = (pos.astype(np.int64) << 32 | hi << 16).ravel()
                cells, n = np.unique(cell, return_counts=True)
                ids = part[key].slice(int(at), 1).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.zeros(len(cells), dtype=np.int64))),
                     pa.array((cells >> 32).astype(np.int32)),
                     pa.array(((cells >> 16) & 0xFFFF).astype(np.int32)),
                     pa.array((cells & 0xFFFF).astype(np.int32)), pa.array(n)],
                    names=[key, "_pos", "_hi", "_lo", "_cnt"])

    columns = [key, "embedding", *(("_w1", "_w2") if wanted else ())]
    return (images.select(*columns).mapInArrow(count, schema)
            .groupBy(key, "_pos", "_hi", "_lo").agg(F.sum("_cnt").alias("_cnt")))


def _pool_large(images: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """Exact median of large requests by two rounds of counting (upper, then lower 16 bits).

    The middle ranks' upper halves are found from at most 65536 counts per position; the
    second round counts only values inside them.
    """
    mine = images.join(large.select(key), key, "left_semi")
    ranks = large.select(key, "_n", F.expr("(_n - 1) div 2").alias("_r1"),
                         F.expr("_n div 2").alias("_r2"))

    upto = (Window.partitionBy(key, "_pos").orderBy("_hi")
            .rowsBetween(Window.unboundedPreceding, -1))
    upper = (_histogram(mine, key, False)
             .withColumn("_below", F.coalesce(F.sum("_cnt").over(upto), F.lit(0)))
             .join(ranks, key))
    top = F.col("_below") + F.col("_cnt")

    def holds(rank: str):
        return (F.col("_below") <= F.col(rank)) & (F.col(rank) < top)

    pick = upper.groupBy(key, "_pos").agg(*[
        e for i in (1, 2) for e in (
            F.max(F.when(holds(f"_r{i}"), F.col("_hi"))).alias(f"_h{i}"),
            F.max(F.when(holds(f"_r{i}"), F.col(f"_r{i}") - F.col("_below"))).alias(f"_k{i}"))])
    # one short row per request, joined to its images
    wanted = pick.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_h1", "_h2"))).alias("_p")).select(
        key, F.col("_p._h1").alias("_w1"), F.col("_p._h2").alias("_w2"))
    lower = _histogram(attach(mine, wanted, key, large, "_pos"), key, True)
    upto = (Window.partitionBy(key, "_pos", "_hi").orderBy("_lo")
            .rowsBetween(Window.unboundedPreceding, -1))
    lower = (lower.withColumn("_below", F.coalesce(F.sum("_cnt").over(upto), F.lit(0)))
             .join(pick, [key, "_pos"]))
    code = F.shiftleft(F.col("_hi").cast("bigint"), 16) + F.col("_lo")

    def value(i: int):
        inside = ((F.col("_hi") == F.col(f"_h{i}")) & (F.col("_below") <= F.col(f"_k{i}"))
                  & (F.col(f"_k{i}") < F.col("_below") + F.col("_cnt")))
        return F.max(F.when(inside, code)).alias(f"_c{i}")

    middle = lower.groupBy(key, "_pos").agg(value(1), value(2))
    packed = middle.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_c1", "_c2"))).alias("_p")).join(ranks, key)
    schema = T.StructType([images.schema[key], images.schema["embedding"],
                           T.StructField("images", T.LongType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low, high = _from_code(as_matrix(b["a"])), _from_code(as_matrix(b["b"]))
            yield _vector_batch(b[key], key, (low + high) / 2, b["_n"].to_numpy())

    return packed.select(key, F.col("_p._c1").alias("a"), F.col("_p._c2").alias("b"),
                         "_n").mapInArrow(decode, schema)


# --- same person ------------------------------------------------------------------------

def same_person(images: DataFrame, key: str = "request_id", pos: str = "pos",
                max_distance: float = MAX_DISTANCE, block_rows: int = 2048,
                group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Per request: is every pair of its images within ``max_distance``, and if not, the
    first offending pair (i, j) in upload order with its cosine distance.

    First every image is compared with the request's first one. That alone settles a
    request with an image too far from it (its first offending pair starts there), and one
    whose images are all within half the allowed angle. Only requests in between compare
    further pairs, block by block inside tasks; pairs are never emitted, and images too close
    to the first to offend with any other take no part.
    """
    rows = images.where(F.col("embedding").isNotNull()).select(
        key, F.col(pos).cast("bigint").alias("_pos"), "embedding")
    usable = rows.where(v.norm("embedding") > 0)
    first = usable.groupBy(key).agg(
        F.min_by(F.struct(F.col("_pos").alias("p"), "embedding"), "_pos").alias("_first"))
    large = large_keys(rows, key, group_limit)
    near = (attach(usable, first, key, large, "_pos")
            .withColumn("_d", v.cosine_distance("_first.embedding", "embedding")))
    far = (F.col("_d") > max_distance) & (F.col("_pos") > F.col("_first.p"))
    verdict = near.groupBy(key).agg(
        F.max("_d").alias("_reach"),
        F.min(F.when(far, F.struct(F.col("_first.p").alias("i"), F.col("_pos").alias("j"),
                                   F.col("_d").alias("d")))).alias("_bad"))
    limit = float(np.arccos(np.clip(1 - max_distance, -1, 1)))

    def angle(d):
        return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 1 - d)))

    open_ = (verdict.where(F.col("_bad").isNull() & (2 * angle(F.col("_reach")) > limit - _EDGE))
             .select(key, angle(F.col("_reach")).alias("_a")))
    rest = (attach(near, open_, key, large, "_pos")
            .where(angle(F.col("_d")) + F.col("_a") > limit - _EDGE)
            .select(key, "_pos", "embedding"))
    pairs = _first_far_pair(rest, key, max_distance, block_rows, large)
    sizes = _sizes(rows, key)
    return (sizes.join(verdict.select(key, "_bad"), key, "left").join(pairs, key, "left")
            .withColumn("_b", F.coalesce("_bad", "_pair"))
            .select(key, F.col("_n").alias("images"), F.col("_b").isNull().alias("same_person"),
                    F.col("_b.i").alias("first_i"), F.col("_b.j").alias("first_j"),
                    F.col("_b.d").alias("distance")))


def _first_far_pair(rest: DataFrame, key: str, max_distance: float,
                    block_rows: int, large: DataFrame | None) -> DataFrame:
    """First offending pair per request. The request's rows are dealt into blocks of about
    ``block_rows``; each pair of blocks is one group, which returns at most one pair."""
    blocks = rest.groupBy(key).agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_nb"))
    dealt = (attach(rest, blocks, key, large, "_pos")
             .withColumn("_blk", F.pmod(F.xxhash64("_pos"), F.col("_nb")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))))
    cells = dealt.select(key, "_pos", "embedding", "_blk",
                         F.least("_blk", "_other").alias("_c1"),
                         F.greatest("_blk", "_other").alias("_c2"))
    schema = T.StructType([rest.schema[key], T.StructField("i", T.LongType()),
                           T.StructField("j", T.LongType()), T.StructField("d", T.DoubleType())])

    def compare(t: pa.Table) -> pa.Table:
        blk, c1, c2, p = (t[c].to_numpy() for c in ("_blk", "_c1", "_c2", "_pos"))
        m = as_matrix(t["embedding"])
        m = m / np.linalg.norm(m, axis=1)[:, None]
        left, right = np.flatnonzero(blk == c1), np.flatnonzero(blk == c2)
        # single precision finds candidates, with twice its error bound as margin
        small = m.astype(np.float32)
        margin = 2 * (m.shape[1] + 16) * 6e-8
        far = small[left] @ small[right].T < np.float32(1 - max_distance + margin)
        if c1[0] == c2[0]:
            np.fill_diagonal(far, False)
        a, b = np.nonzero(far)
        # in order of (i, j), so that the first candidate that holds is the first pair
        i, j = np.minimum(p[left][a], p[right][b]), np.maximum(p[left][a], p[right][b])
        order = np.lexsort((j, i))
        for at in range(0, len(order), block_rows):
            some = order[at:at + block_rows]
            d = 1.0 - (m[left[a[some]]] * m[right[b[some]]]).sum(axis=1)
            hit = np.flatnonzero(d > max_distance)[:1]
            if len(hit):
                break
        one = some[hit] if len(order) else order
        d = d[hit] if len(order) else np.array([])
        return pa.table([t[key].slice(0, len(one)), pa.array(i[one], pa.int64()),
                         pa.array(j[one], pa.int64()), pa.array(d, pa.float64())],
                        names=[key, "i", "j", "d"])

    hits = cells.groupBy(key, "_c1", "_c2").applyInArrow(compare, schema)
    return hits.groupBy(key).agg(F.min(F.struct("i", "j", "d")).alias("_pair"))
