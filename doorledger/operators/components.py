"""Connected components over pairs of texts, such as names and addresses that registrations share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.session import settled

#: pairs that a task contracts at a time
_AT_ONCE = 1 << 20
_EDGES = "src string, dst string"


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components: every task replaces its own by one from each node to its smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[str, str] = {}
        seen = 0

        def root(x: str) -> str:
            path = []
            while up[x] != x:
                path.append(x)
                x = up[x]
            for p in path:
                up[p] = x
            return x

        def flush() -> pa.RecordBatch:
            rows = [(x, root(x)) for x in up]
            rows = [r for r in rows if r[0] != r[1]]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["src", "dst"])

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a, c = root(up.setdefault(x, x) and x), root(up.setdefault(y, y) and y)
                if a != c:
                    up[max(a, c)] = min(a, c)
            seen += b.num_rows
            if seen >= _AT_ONCE:
                yield flush()
                up.clear()
                seen = 0
        if up:
            yield flush()

    return edges.select("src", "dst").mapInArrow(run, _EDGES)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges`` (src, dst: non-empty text).

    Tasks contract their own edges first, so that a long chain that one task holds is a star before the first
    shuffle; then every node points to the smallest of its neighbours, and so do these, until nothing changes.
    Each such step is reduced before its shuffle and settled in the shared folder. Their number follows the logarithm
    of the longest path over tasks, and does not depend on the input where one task holds it all.
    """
    def pointed(e: DataFrame) -> DataFrame:
        """Each node and its neighbours to the smallest of all of them."""
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        moved = both.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        own = low.select("src", F.col("low").alias("dst"))
        return moved.unionByName(own).where("src <> dst").distinct()

    now, sign = settled(_contracted(edges).distinct()), None
    while True:
        flat = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if flat == sign:
            break
        sign = flat
        now = settled(_contracted(pointed(now)).distinct())
    # every edge now leads from a node to its component's smallest
    nodes = now.groupBy("src").agg(F.min("dst").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.select(F.col("src").alias("node"), "component").unionByName(roots)
