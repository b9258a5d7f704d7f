"""Best-fit packing of tokenised documents into sequences by linear grouping.

Documents become pieces of at most ``capacity`` tokens. Only the histogram of piece lengths, never more
than ``capacity`` rows, comes to the driver, where the packing is planned: lengths over a quarter of the capacity
are sorted and cut into groups of equal cardinality, each rounded up to its longest; over these
few sizes the configuration program is solved by column generation; actual lengths are then put into the groups' slots.
What rounding the solution down leaves is grouped and solved again until no whole sequence comes of it. The last few large
ones and all small ones are placed best-fit, longest first, into what stays free. The plan says for each length and
rank in which sequence and where a piece goes, and tasks look that up; the pieces' ranks are
counted per task and added up over tasks.

Null and empty texts are one piece holding the end token. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doorledger.llm.bpe import encoder_of
from doorledger.llm.common import map_rows, stored

CAPACITY, END_ID = 4096, 1
GROUPS, LARGE = 16, 4

_PIECES = ("id long, piece int, start long, length long, ids_crc32 long, part long, nth long")


def _pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces with their number ``nth`` among the pieces of equal length of task ``part``."""
    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        encoder, end, width = encoder_of(path), end_id.to_bytes(4, "little"), 4 * capacity
        for b in batches:
            out = [[] for _ in range(7)]
            for doc_id, blocks in zip(b["_id"].to_pylist(), encoder.texts(b["_text"]), strict=True):
                ids = b"".join([*blocks, end])
                for k in range(0, len(ids), width):
                    piece = ids[k:k + width]
                    n = len(piece) // 4
                    for column, value in zip(out, (doc_id, k // width, k // 4, n, zlib.crc32(piece), part, seen[n]), strict=True):
                        column.append(value)
                    seen[n] += 1
            yield dict(zip(("id", "piece", "start", "length", "ids_crc32", "part", "nth"), out, strict=True))

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return map_rows(rows, run, _PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns of ``sizes`` and how often each is used: the configuration program's linear optimum.

    Column generation with an unbounded knapsack as pricing; any stop leaves a feasible solution.
    """
    s, n = np.array(sizes), len(sizes)
    basis = np.diag(capacity // s).astype(float)
    x = np.array(demand, float) / np.diag(basis)
    for _ in range(40 * n):
        price = np.linalg.solve(basis.T, np.ones(n))
        value, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for i in np.flatnonzero(price > 1e-12).tolist():
            size = int(s[i])
            for _ in range(capacity // size):  # one more copy each time
                gain = value[:-size] + price[i]
                better = np.flatnonzero(gain > value[size:] + 1e-12)
                if not len(better):
                    break
                value[better + size], take[better + size] = gain[better], i
        if value.max() <= 1 + 1e-7:
            break
        pattern, c = np.zeros(n), int(value.argmax())
        while take[c] >= 0:
            pattern[take[c]] += 1
            c -= int(s[take[c]])
        step = np.linalg.solve(basis, pattern)
        ratio = np.where(step > 1e-9, x / np.maximum(step, 1e-9), np.inf)
        out = int(ratio.argmin())
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        basis[:, out] = pattern
    return [(basis[:, i], float(x[i])) for i in range(n)]


class _Bins:
    """Runs of sequences with equal contents, by free space."""

    def __init__(self, capacity: int):
        self.capacity, self.free = capacity, [[] for _ in range(capacity + 1)]
        self.some = np.zeros(capacity + 1, bool)

    def add(self, count: int, free: int, items: tuple) -> None:
        if count:
            self.free[free].append((count, items))
            self.some[free] = True

    def fit(self, length: int, count: int) -> None:
        """Best fit of ``count`` equal lengths; a sequence takes as many as it can hold."""
        while count:
            tight = int(self.some[length:].argmax()) + length
            if not self.some[tight]:
                per = self.capacity // length
                full, rest = divmod(count, per)
                self.add(full, self.capacity - per * length, ((length, per),))
                if rest:
                    self.add(1, self.capacity - rest * length, ((length, rest),))
                return
            n, items = self.free[tight].pop()
            self.some[tight] = bool(self.free[tight])
            per = tight // length
            used = min(n, count // per)
            self.add(used, tight - per * length, (*items, (length, per)))
            count -= used * per
            if used < n:
                if count:
                    self.add(1, tight - count * length, (*items, (length, count)))
                    used += 1
                    count = 0
                self.add(n - used, tight, items)

    def runs(self) -> list[tuple[int, tuple]]:
        return [run for per_free in self.free for run in per_free]


def _grouped(lengths: np.ndarray, counts: np.ndarray, capacity: int, groups: int) -> _Bins:
    """The linear grouping plan of lengths sorted in descending order.

    What rounding the program's solution down leaves is grouped and solved again, as long as a whole sequence comes of it.
    """
    bins = _Bins(capacity)
    large = lengths > capacity // LARGE
    left = [[length, n] for length, n in zip(lengths[large].tolist(), counts[large].tolist(), strict=True)]
    while left:
        queues = _queues(left, groups)
        sizes = [q[0][0] for q in queues]
        whole = False
        for pattern, times in configurations(sizes, [sum(c for _, c in q) for q in queues], capacity):
            m = min([int(times + 1e-9), *(sum(c for _, c in q) // int(a) for q, a in zip(queues, pattern, strict=True) if a)])
            runs = [(m, ())] if m and pattern.any() else []
            for q, a in zip(queues, pattern, strict=True):
                for _ in range(int(a)):  # one slot of each of the m sequences
                    runs = _slot(runs, q)
            for n, items in runs:
                whole = True
                bins.add(n, capacity - sum(items), tuple((x, 1) for x in items))
        left = [x for q in queues for x in q]
        if not whole:
            break
    rest = defaultdict(int)
    for length, n in [*left, *zip(lengths[~large].tolist(), counts[~large].tolist(), strict=True)]:
        rest[length] += n
    for length in sorted(rest, reverse=True):
        bins.fit(length, rest[length])
    return bins


def _queues(left: list[list[int]], groups: int) -> list[list[list[int]]]:
    """(length, number) in descending order, cut into groups of equal cardinality."""
    total = sum(n for _, n in left)
    queues: list[list[list[int]]] = []
    per, room = -(-total // groups), 0
    for length, n in left:
        while n:
            if not room:
                queues.append([])
                room = per
            took = min(n, room)
            queues[-1].append([length, took])
            n, room = n - took, room - took
    return queues


def _slot(runs: list[tuple[int, tuple]], queue: list[list[int]]) -> list[tuple[int, tuple]]:
    out = []
    for n, items in runs:
        while n:
            took = min(n, queue[0][1])
            out.append((took, (*items, queue[0][0])))
            n -= took
            queue[0][1] -= took
            if not queue[0][1]:
                queue.pop(0)
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, tuple]]:
    """Runs (sequences, ((length, copies), ...)) that hold exactly the lengths of the histogram."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram, reverse=True))
    counts = np.array([histogram[int(x)] for x in lengths])
    return _grouped(lengths, counts, capacity, groups).runs()


def _lookup(runs: list[tuple[int, tuple]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, sequences, offset) in order of rank."""
    table, rank, sequence = defaultdict(list), defaultdict(int), 0
    for n, items in runs:
        offset = 0
        for length, copies in items:
            for _ in range(copies):
                table[length].append((rank[length], sequence, n, offset))
                rank[length] += n
                offset += length
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in table.items()}


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(_pieces(docs, path, capacity, end_id, id_col, text_col))
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = dict(base.groupBy("length").agg(F.sum("n")).collect())  # at most `capacity` rows
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_lookup(plan(histogram, capacity)))  # bounded by the lengths

    def place(batches):
        for b in batches:
            length, rank = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, cuts):
                rows = table.value[int(length[own[0]])]
                r = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1]
                sequence[own], offset[own] = r[:, 1] + rank[own] - r[:, 0], r[:, 3]
            yield {**{c: b[c] for c in ("id", "piece", "start", "length", "ids_crc32")},
                   "sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    ranked = (pieces.join(base.select("part", "length", "base").hint("merge"), ["part", "length"])  # grows with the tasks
              .select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")))
    return map_rows(ranked, place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
