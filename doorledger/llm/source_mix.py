"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern; a pattern can supply its words up
to ``REPEATS`` times, every further time at a higher cost per word (convex), and each source draws up to its quota
from the patterns that hold it. The cheapest largest flow says how many words each pattern gives: so many whole copies and a
rest, and the rest is drawn by a seeded hash. For that the documents of a pattern are counted by size class (powers of two) and
hash bucket; each class gives its share of the rest, from the largest class to the smallest, and what whole
buckets leave open passes on to the next smaller class, so that the end is met to about one small bucket.

Only the table of patterns comes to the driver, which is checked to be at most ``MAX_PATTERNS`` rows; counts are
reduced before each shuffle, and a pattern's group is at most classes x ``BUCKETS`` rows.

Null and empty texts have size 0 and give nothing. A null source is a source of its own, after all others; a document of
no source is not drawn. Repeated rows fall into one bucket and are drawn together. One very long document is drawn whole
or not. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import stored

REPEATS, WEIGHTS, SEED = 3, (1, 2, 3), 17
BUCKETS, MAX_PATTERNS = 4096, 1 << 18
#: patterns whose thresholds (at most 64 classes each) are sent to all tasks
_SMALL = 4096


def targets(sizes: dict, weights: tuple = WEIGHTS, most: int = REPEATS, total: float | None = None) -> dict:
    """Words wanted of each source: all words shared by weight, no source above ``most`` times its own.

    ``total`` says how many words there are where sources overlap, so that their sizes count some twice.
    """
    order = sorted(sizes, key=lambda s: (s is None, s.encode("utf-8", "surrogatepass") if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, list(order), float(sum(sizes.values()) if total is None else total)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not full:
            out.update({s: unit * weight[s] for s in open_})
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


class _Flow:
    """Min-cost max-flow by primal-dual phases: shortest distances, then a blocking flow over the tight arcs."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head, self.room, self.cost = [], [], []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.head))
            self.head.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.head) - 2

    def _distances(self, source: int, height: list[int]) -> list[float]:
        far = [float("inf")] * len(self.out)
        far[source], heap = 0, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in self.out[a]:
                b = self.head[e]
                t = d + self.cost[e] + height[a] - height[b]
                if self.room[e] and t < far[b]:
                    far[b] = t
                    heapq.heappush(heap, (t, b))
        return far

    def _levels(self, source: int, height: list[int]) -> list[int]:
        level = [-1] * len(self.out)
        level[source], todo = 0, deque([source])
        while todo:
            a = todo.popleft()
            for e in self.out[a]:
                b = self.head[e]
                if self.room[e] and level[b] < 0 and self.cost[e] + height[a] - height[b] == 0:
                    level[b] = level[a] + 1
                    todo.append(b)
        return level

    def run(self, source: int, sink: int) -> None:
        height = [0] * len(self.out)
        while True:
            far = self._distances(source, height)
            if far[sink] == float("inf"):
                return
            height = [h + int(min(f, far[sink])) for h, f in zip(height, far, strict=True)]
            while (level := self._levels(source, height))[sink] >= 0:
                nxt = [0] * len(self.out)
                path: list[int] = []
                a = source
                while True:
                    if a == sink:
                        least = min(self.room[e] for e in path)
                        for e in path:
                            self.room[e] -= least
                            self.room[e ^ 1] += least
                        path, a = [], source
                        continue
                    while nxt[a] < len(self.out[a]):
                        e = self.out[a][nxt[a]]
                        b = self.head[e]
                        if self.room[e] and level[b] == level[a] + 1 and self.cost[e] + height[a] - height[b] == 0:
                            break
                        nxt[a] += 1
                    else:
                        if a == source:
                            break
                        e = path.pop()
                        a = self.head[e ^ 1]
                        nxt[a] += 1
                        continue
                    path.append(e)
                    a = b


def routed(patterns: dict[tuple, int], quotas: dict, most: int = REPEATS) -> dict[tuple, dict]:
    """Words that each pattern (a tuple of sources, with its number of words) gives to each of its sources.

    The largest flow within the quotas; of these the one that repeats least: the words of a pattern cost 0 at first,
    1 the second time, 4 the third, and so on. Patterns that share no source are separate problems.
    """
    with_source = defaultdict(list)
    for p in patterns:
        for s in p:
            with_source[s].append(p)
    out: dict[tuple, dict] = {}
    for start in patterns:
        if start in out:
            continue
        group, sources, todo = [], set(), [start]
        out[start] = {}
        while todo:
            p = todo.pop()
            group.append(p)
            for s in p:
                if s not in sources:
                    sources.add(s)
                    for q in with_source[s]:
                        if q not in out:
                            out[q] = {}
                            todo.append(q)
        if len(group) == 1 and len(sources) <= 1:
            out[start] = {s: min(most * patterns[start], round(quotas[s])) for s in sources}
            continue
        flow = _Flow(2 + len(group) + len(sources))
        place = {s: 2 + len(group) + i for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}
        for s, at in place.items():
            flow.arc(at, 1, round(quotas[s]), 0)
        routes = {}
        for i, p in enumerate(sorted(group, key=lambda p: [(s is None, s or "") for s in p])):
            for r in range(most):
                flow.arc(0, 2 + i, patterns[p], r * r)
            for s in p:
                routes[p, s] = flow.arc(2 + i, place[s], most * patterns[p], 0)
        flow.run(0, 1)
        for (p, s), e in routes.items():
            out[p][s] = flow.room[e ^ 1]
    return out


def _thresholds(rows: pd.DataFrame) -> pd.DataFrame:
    """Per size class of one pattern: the hash bucket below which documents are drawn once more."""
    rest, left = float(rows["rest"].iloc[0]), 0.0
    total = float(rows["words"].sum())
    share = rest / total if total else 0.0
    classes, upto, following = [], [], []
    for c, own in sorted(rows.groupby("class"), key=lambda x: -x[0]):
        own = own.sort_values("bucket")
        cum = own["words"].cumsum()
        left += share * float(own["words"].sum())
        n = int(cum.searchsorted(left + 1e-6, side="right"))
        left -= float(cum.iloc[n - 1]) if n else 0.0
        classes.append(c)
        upto.append(int(own["bucket"].iloc[n - 1]) + 1 if n else 0)
        following.append((float(own["words"].iloc[n]), int(own["bucket"].iloc[n]) + 1) if n < len(own) else None)
    best = min(((abs(left - f[0]), i) for i, f in enumerate(following) if f), default=(left, -1))
    if best[0] < left:  # one more bucket comes nearer
        upto[best[1]] = following[best[1]][1]
    return pd.DataFrame({"key": rows["key"].iloc[0], "class": classes, "upto": upto})


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", weights: tuple = WEIGHTS,
          most: int = REPEATS, seed: int = SEED) -> DataFrame:
    """Per row: id, size, sources, source_sizes and targets (in order of sources), taken.

    ``sources`` is an array of source names. A document's ``taken`` is its size times the copies that the mix takes.
    """
    spark = docs.sparkSession
    size = word_count(F.col("_text"))
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text"), sources.alias("_s"))
    held = F.array_sort(F.array_distinct(F.coalesce("_s", F.array().cast("array<string>"))))
    rows = stored(named.select("id", size.alias("size"), held.alias("sources"),
                               F.pmod(F.xxhash64(F.lit(seed), "id", F.xxhash64("_text")), F.lit(BUCKETS)).cast("int").alias("bucket"))
                  .withColumn("key", F.to_json("sources")).withColumn("class", F.length(F.bin("size"))))
    hist = stored(rows.groupBy("key", "class", "bucket").agg(F.sum("size").alias("words"), F.first("sources").alias("sources")))
    found = hist.groupBy("key").agg(F.sum("words").alias("words"), F.first("sources").alias("sources")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r.sources): int(r.words) for r in found}
    sizes: dict = defaultdict(int)
    for p, words in patterns.items():
        for s in p:
            sizes[s] += words
    wanted = targets(sizes, weights, most, sum(words for p, words in patterns.items() if p))
    flows = routed(patterns, wanted, most)
    plan = []
    for r in found:
        p = tuple(r.sources)
        copies, rest = divmod(sum(flows[p].values()), max(int(r.words), 1))
        plan.append((r.key, int(copies), int(rest), [sizes[s] for s in p], [wanted[s] for s in p]))
    plan_df = spark.createDataFrame(plan, "key string, copies long, rest long, source_sizes array<long>, targets array<double>")
    drawn = stored(hist.join(plan_df, "key").where("words > 0").select("key", "class", "bucket", "words", "rest")
                   .groupBy("key").applyInPandas(_thresholds, "key string, class int, upto int"))
    small = F.broadcast if len(plan) <= _SMALL else (lambda df: df)
    return (rows.join(small(plan_df.drop("rest")), "key").join(small(drawn), ["key", "class"], "left")
            .select("id", "size", "sources", "source_sizes", "targets",
                    (F.col("size") * (F.col("copies") + F.when(F.col("bucket") < F.col("upto"), 1).otherwise(0))).alias("taken")))
