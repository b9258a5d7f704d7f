"""MinHash near-dedup: improved consistent weighted sampling of TF-IDF shingles, banded and verified.

A text is its weighted set of shingles of five words (runs of ASCII letters, digits and all
characters from U+0080 on, lower case; shorter texts are one shingle). A shingle weighs its count
times the mean inverse document frequency of its words, whose frequencies are counted over all
rows in ``DF_BUCKETS`` hashed counters, a table of fixed size. ``BANDS`` x ``ROWS`` consistent samples are
banded; rows that share a band are compared by their exact weighted Jaccard similarity, and
links of ``SIMILARITY`` or more join rows into groups.

Rows of equal shingles are one class from the start. Each band bucket first compares all members with one
of them; where that leaves a bucket in several groups, the rows that agree in enough samples with a row
of another group are compared block by block inside tasks, which emit no more than one
edge per row and group. So no link between candidates is lost, and
a bucket of mutual copies costs one comparison per member.

Null, empty and wordless texts are similar to nothing, each is a group of its own. Rows may repeat ids; of a group the
smallest id (then the first row) stays, null ids come last. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import RID, connected_components, decided, groups, map_rows, numbered, shuffle_parts, stored

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 3
DF_BUCKETS = 1 << 18
#: a pair of similarity 0.8 agrees in fewer than this many of 42 samples once in 10^6 times
AGREE = 20
#: rows of a bucket that are compared as one block
BLOCK = 1024
_CHUNK = 1 << 18

_K = BANDS * ROWS
_WORD = np.zeros(256, bool)
_WORD[np.r_[48:58, 65:91, 97:123, 128:256]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, _CHUNK + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, b in enumerate((_BASE, inverse)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of concatenated texts; ``starts`` has one entry more."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _WORD[data]
    fresh = np.zeros(n + 1, bool)
    fresh[starts] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | fresh[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | fresh[1:n]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
    return hashes, np.searchsorted(starts, s, "right") - 1


def pieces(texts: pa.Array):
    """(first row, data, starts) of runs of about a quarter of a megabyte of lower-case texts."""
    low = pc.utf8_lower(texts.fill_null("")).cast(pa.large_binary())
    offsets = np.frombuffer(low.buffers()[1], np.int64)[low.offset:low.offset + len(low) + 1]
    data = np.frombuffer(low.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(low):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _CHUNK, "right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def shingles(data: np.ndarray, starts: np.ndarray, idf: np.ndarray):
    """Distinct shingles of each text: text number, hash and weight, sorted by text and hash."""
    words, of = word_hashes(data, starts)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    own = idf[(words >> np.uint64(46)).astype(np.int64)]
    counts = np.bincount(of, minlength=len(starts) - 1)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    at = np.arange(n)
    width = np.minimum(counts[of], WORDS)
    full = at + width <= first[of] + counts[of]
    full &= (counts[of] >= WORDS) | (at == first[of])
    at, width = at[full], width[full]
    h, w = np.zeros(len(at), np.uint64), np.zeros(len(at))
    for k in range(WORDS):
        have = k < width
        i = np.where(have, at + k, 0)
        h = mix(h + np.where(have, words[i], np.uint64(0)) + np.uint64(k + 1))
        w += np.where(have, own[i], 0.0)
    w /= width
    doc = of[at]
    order = np.lexsort((h, doc))
    doc, h, w = doc[order], h[order], w[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
    heads = np.flatnonzero(new)
    tf = np.diff(np.concatenate([heads, [len(h)]]))
    return doc[heads], h[heads], w[heads] * tf


def _sampler() -> tuple[np.ndarray, np.ndarray]:
    """Random numbers of the sampling scheme: (r, 1/r, beta, ln c) for 2^16 hash values, and
    a multiplier per sample that assigns hashes to them."""
    rng = np.random.default_rng(20240229)
    r, c = rng.gamma(2, 1, 1 << 16), rng.gamma(2, 1, 1 << 16)
    table = np.stack([r, 1 / r, rng.random(1 << 16), np.log(c)]).astype(np.float32)  # 1 MB, stays in cache
    return table, rng.integers(0, 1 << 63, _K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_table, _multipliers = _sampler()


def samples(doc: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers that have shingles, and their consistent weighted samples, one row each."""
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    lengths = np.diff(np.concatenate([heads, [len(doc)]]))
    segment = np.repeat(np.arange(len(heads)), lengths)
    log_w = np.log(w).astype(np.float32)
    out = np.empty((len(heads), _K), np.uint64)
    for k in range(_K):
        at = ((h * _multipliers[k]) >> np.uint64(48)).astype(np.int64)
        r, inverse, beta, log_c = (column[at] for column in _table)
        t = np.floor(log_w * inverse + beta)
        a = log_c - r * (t - beta + 1)
        low = np.minimum.reduceat(a, heads)
        at = np.flatnonzero(a == low[segment])
        at = at[np.concatenate([[True], segment[at][1:] != segment[at][:-1]])]
        out[:, k] = mix(h[at] + t[at].astype(np.int64).astype(np.uint64) * _BASE)
    return doc[heads], out


def _document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """Inverse document frequencies of hashed words, over all rows; 2^18 numbers."""
    def count(batches):
        total, rows = np.zeros(DF_BUCKETS, np.int64), 0
        for b in batches:
            rows += len(b["_text"])
            for _, data, starts in pieces(b["_text"]):
                words, of = word_hashes(data, starts)
                key = np.unique((of.astype(np.uint64) << np.uint64(18)) | (words >> np.uint64(46)))
                total += np.bincount((key & np.uint64(DF_BUCKETS - 1)).astype(np.int64), minlength=DF_BUCKETS)
        used = np.flatnonzero(total)
        yield {"bucket": pa.array(np.append(used, -1), pa.int64()), "n": pa.array(np.append(total[used], rows), pa.int64())}

    got = (map_rows(docs.select(F.col(text_col).cast("string").alias("_text")), count, "bucket long, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # at most 2^18 + 1 rows
    df = np.zeros(DF_BUCKETS)
    known = got[got.bucket >= 0]
    df[known.bucket.to_numpy(np.int64)] = known.n.to_numpy(float)
    rows = int(got.n[got.bucket < 0].sum())
    return (1 + np.log((rows + 1) / (df + 1))).astype(np.float32)


def _sketched(docs: DataFrame, idf) -> DataFrame:
    """Per row with words: _rid, two content keys, band keys and samples (32 bits each)."""
    def run(batches):
        for b in batches:
            rids = b[RID].to_numpy(zero_copy_only=False)
            for row, data, starts in pieces(b["_text"]):
                doc, h, w = shingles(data, starts, idf.value)
                if not len(doc):
                    continue
                which, s = samples(doc, h, w)
                heads = np.searchsorted(doc, which)
                tf = mix(h) * mix(np.round(w * 1024).astype(np.uint64))
                c1, c2 = np.add.reduceat(tf, heads), np.bitwise_xor.reduceat(mix(tf + _BASE), heads)
                keys = np.empty((len(which), BANDS), np.uint64)
                for band in range(BANDS):
                    key = np.full(len(which), band + 1, np.uint64)
                    for k in range(band * ROWS, (band + 1) * ROWS):
                        key = mix(key * _BASE + s[:, k])
                    keys[:, band] = key
                yield {RID: rids[row + which], "c1": c1.view(np.int64), "c2": c2.view(np.int64),
                       "bands": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32),
                                                         pa.array(keys.view(np.int64).ravel())),
                       "sketch": [x.tobytes() for x in s.astype(np.uint32)]}

    return map_rows(docs.select(RID, "_text"), run, f"{RID} long, c1 long, c2 long, bands array<long>, sketch binary")


def _stars(batches):
    """Sorted (key, rid) rows to (leader, member) of each bucket; the leader has the lowest rid."""
    key = leader = None
    for b in batches:
        keys, rids = b["key"].to_pylist(), b[RID].to_pylist()
        left, right = [], []
        for k, r in zip(keys, rids, strict=True):
            if k != key:
                key, leader = k, r
            elif r != leader:
                left.append(leader)
                right.append(r)
        if left:
            yield {"a": left, "b": right}


def _candidate_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(_rid, _text) of the rows in pairs: one shuffle of all texts, later steps move these only."""
    wanted = pairs.select(F.col("a").alias(RID)).union(pairs.select(F.col("b").alias(RID))).distinct()
    return docs.select(RID, "_text").join(wanted.hint("merge"), RID)


def _linked(texts: DataFrame, pairs: DataFrame, idf) -> DataFrame:
    """Of (a, b) row pairs, those of enough weighted Jaccard similarity.

    Texts meet by ``a``; where many rows pair with one, they are dealt over several copies of it.
    """
    salted = pairs.withColumn("_s", F.floor(F.pmod(F.xxhash64("b"), F.lit(1 << 20)) / 64))
    per = pairs.groupBy("a").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / 1000)).alias("_n"))
    need = salted.join(per, "a").select(F.col("b").alias(RID), "a", F.pmod("_s", "_n").alias("_s"))
    heads = need.select(F.col("a").alias(RID), "a", "_s").distinct()
    rows = texts.join(need.union(heads).hint("merge"), RID)

    def verify(batches):
        group, base = None, None
        for b in batches:
            groups_ = list(zip(b["a"].to_pylist(), b["_s"].to_pylist(), strict=True))
            rids, left, right = b[RID].to_pylist(), [], []
            for row, data, starts in pieces(b["_text"]):
                doc, h, w = shingles(data, starts, idf.value)
                cuts = np.searchsorted(doc, np.arange(len(starts)))
                for i in range(len(starts) - 1):
                    own_h, own_w = h[cuts[i]:cuts[i + 1]], w[cuts[i]:cuts[i + 1]]
                    if groups_[row + i] != group:  # the head comes first
                        group, base = groups_[row + i], (own_h.copy(), own_w.copy())
                        continue
                    both = shared_weight(*base, own_h, own_w)
                    if both >= SIMILARITY * (base[1].sum() + own_w.sum() - both) - 1e-9:
                        left.append(group[0])
                        right.append(rids[row + i])
            if left:
                yield {"src": left, "dst": right}

    return map_rows(rows.repartition(shuffle_parts(texts), "a", "_s")
                    .withColumn("_member", F.col("a") != F.col(RID))
                    .sortWithinPartitions("a", "_s", "_member", RID).select("a", "_s", RID, "_text"),
                    verify, "src long, dst long")


def shared_weight(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """Sum of the lower weights of the shingles that two sorted sets share."""
    if not len(h1) or not len(h2):
        return 0.0
    at = np.minimum(np.searchsorted(h1, h2), len(h1) - 1)
    same = h1[at] == h2
    return float(np.minimum(w1[at[same]], w2[same]).sum())


def _across(buckets: DataFrame, reps: DataFrame, groups_: DataFrame) -> DataFrame:
    """Rows of buckets that lie in several groups, with each block pair (cell) in which some row
    of another group agrees with them in enough samples: (key, _x, _y, _b, _rid, group)."""
    rows = buckets.join(groups_, RID, "left").withColumn("group", F.coalesce("group", RID))
    mixed = (rows.groupBy("key").agg(F.min("group").alias("_lo"), F.max("group").alias("_hi"), F.count("*").alias("_m"))
             .where("_lo <> _hi").select("key", F.ceil(F.col("_m") / BLOCK).alias("_nb")))
    dealt = (rows.join(mixed, "key").join(reps.select(RID, "sketch").hint("merge"), RID)
             .withColumn("_b", F.pmod(F.xxhash64(RID), F.col("_nb")))
             .withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
             .select("key", F.least("_b", "_j").alias("_x"), F.greatest("_b", "_j").alias("_y"), "_b", RID, "group", "sketch"))

    def run(batches):
        for g in _cells(batches):
            s = np.frombuffer(b"".join(g["sketch"]), np.uint32).reshape(-1, _K)
            grp, near = np.array(g["group"]), np.zeros(len(s), bool)
            left, right = _sides(g)
            for i in left:
                hit = right[((s[right] == s[i]).sum(1) >= AGREE) & (grp[right] != grp[i])]
                near[i] |= len(hit) > 0
                near[hit] = True
            on = np.flatnonzero(near)
            if len(on):
                yield {c: [g[c][i] for i in on] for c in ("key", "_x", "_y", "_b", RID, "group")}

    return map_rows(dealt.repartition(shuffle_parts(buckets), "key", "_x", "_y").sortWithinPartitions("key", "_x", "_y"),
                    run, f"key long, _x long, _y long, _b long, {RID} long, group long")


def _cells(batches):
    def named(bs):
        for b in bs:
            cell = zip(*(b[c].to_pylist() for c in ("key", "_x", "_y")), strict=True)
            yield {"cell": pa.array([str(c) for c in cell]), **b}

    return groups(named(batches), "cell")


def _sides(g: dict) -> tuple[np.ndarray, np.ndarray]:
    block = np.array(g["_b"])
    return np.flatnonzero(block == g["_x"][0]), np.flatnonzero(block == g["_y"][0])


def _cell_links(texts: DataFrame, active: DataFrame, idf) -> DataFrame:
    """Links across groups inside cells: one edge per row that joins another group, not all pairs."""
    rows = texts.join(active.hint("merge"), RID)

    def vectors(batches):
        for b in batches:
            of, elements, weights = [], [], []
            for row, data, starts in pieces(b["_text"]):
                doc, h, w = shingles(data, starts, idf.value)
                of.append(doc + row)
                elements.append(h)
                weights.append(w)
            of, h, w = (np.concatenate(x) for x in (of, elements, weights))
            cuts = np.searchsorted(of, np.arange(len(b["_text"]) + 1))
            parts = [(h[x:y].tobytes(), w[x:y].tobytes()) for x, y in zip(cuts, cuts[1:], strict=False)]
            yield {**{c: b[c] for c in ("key", "_x", "_y", "_b", RID, "group")},
                   "h": pa.array([p[0] for p in parts], pa.binary()), "w": pa.array([p[1] for p in parts], pa.binary())}

    def run(batches):
        for g in _cells(vectors(batches)):
            left, right = _sides(g)
            vec = [(np.frombuffer(h, np.uint64), np.frombuffer(w, np.float64)) for h, w in zip(g["h"], g["w"], strict=True)]
            rid, grp = np.array(g[RID]), np.array(g["group"])
            near = similar(vec, left, right) & (grp[left][:, None] != grp[right][None, :])
            edges, joined = [], {}
            for j in np.flatnonzero(near.any(1)):
                for k in _one_per_group(near[j], grp[right]):
                    x, y = _root(joined, grp[left[j]]), _root(joined, grp[right[k]])
                    if x != y:
                        joined[x] = y
                        edges.append((rid[left[j]], rid[right[k]]))
            if edges:
                yield {"src": [e[0] for e in edges], "dst": [e[1] for e in edges]}

    return map_rows(rows.repartition(shuffle_parts(texts), "key", "_x", "_y").sortWithinPartitions("key", "_x", "_y"),
                    run, "src long, dst long")


def _root(joined: dict, x: int) -> int:
    while x in joined:
        x = joined[x]
    return x


def _one_per_group(near: np.ndarray, grp: np.ndarray) -> np.ndarray:
    hit = np.flatnonzero(near)
    return hit[np.unique(grp[hit], return_index=True)[1]]


def similar(vec: list, left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Whether each pair of left and right weighted sets reaches SIMILARITY; columns in batches.

    The lower of two weights of a shingle is summed level by level: over the distinct weights
    of a shingle in ascending order, both sets share the rise up to a level if both reach it.
    """
    total = np.array([w.sum() for _, w in vec])
    of = np.repeat(np.arange(len(vec)), [len(h) for h, _ in vec])
    h, w = np.concatenate([h for h, _ in vec]), np.concatenate([w for _, w in vec])
    _, column, count = np.unique(h, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    of, column, w = of[keep], column[keep], w[keep]
    order = np.lexsort((w, column))
    of, column, w = of[order], column[order], w[order]
    shared = np.zeros((len(left), len(right)))
    level = np.concatenate([[True], (column[1:] != column[:-1]) | (w[1:] != w[:-1])]) if len(w) else np.zeros(0, bool)
    starts = np.flatnonzero(level)
    same = np.concatenate([[False], column[starts][1:] == column[starts][:-1]]) if len(starts) else starts
    rise = w[starts] - np.where(same, np.concatenate([[0], w[starts][:-1]]), 0) if len(starts) else w
    ends = np.searchsorted(column, column[starts], "right")  # all that weigh as much or more
    for first in range(0, len(starts), columns):
        m = np.zeros((len(vec), min(columns, len(starts) - first)))
        for k in range(m.shape[1]):
            m[of[starts[first + k]:ends[first + k]], k] = 1
        shared += (m[left] * rise[first:first + columns]) @ m[right].T
    return shared >= SIMILARITY * (total[left][:, None] + total[right][None, :] - shared) - 1e-9


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of a table: _rid, id, component_id (smallest id of its group), kept."""
    return _grouped(numbered(_named(docs, id_col, text_col)))


def _named(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    return docs.select(*others, F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))


def _grouped(docs: DataFrame) -> DataFrame:
    """``near_groups`` of a stored table of _rid, _id, _text."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(_document_frequencies(docs, "_text"))  # 1 MB
    sketched = stored(_sketched(docs, idf))
    classes = sketched.groupBy("c1", "c2").agg(F.min(RID).alias("rep"))
    member = stored(sketched.select(RID, "c1", "c2").join(classes, ["c1", "c2"]).select(RID, "rep"))
    reps = sketched.join(member.where(F.col(RID) == F.col("rep")).select(RID), RID, "left_semi")
    buckets = stored(reps.select(RID, F.explode("bands").alias("key")))
    star = map_rows(buckets.repartition(shuffle_parts(docs), "key").sortWithinPartitions("key", RID),
                    _stars, "a long, b long").distinct()
    star = stored(star)
    texts = stored(_candidate_texts(docs, star))
    links = [stored(_linked(texts, star, idf))]
    first = connected_components(links[0])
    first = stored(first.select(F.col("node").alias(RID), F.col("component").alias("group")))
    active = stored(_across(buckets, reps, first))
    if not active.isEmpty():
        links.append(stored(_cell_links(texts, active, idf)))
    exact = member.where(F.col(RID) != F.col("rep")).select(F.col("rep").alias("src"), F.col(RID).alias("dst"))
    found = connected_components(reduce(DataFrame.union, [*links, exact]))
    ids = docs.select(RID, F.col("_id").alias("id"))
    rows = ids.join(found.select(F.col("node").alias(RID), "component"), RID, "left")
    rows = rows.withColumn("component", F.coalesce("component", RID))
    best = rows.where("id is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    rows = rows.join(best, "component", "left")
    first_row = (rows.where("id <=> component_id").groupBy("component").agg(F.min(RID).alias("_keep")))
    return rows.join(first_row, "component").select(
        RID, "id", "component_id", (F.col(RID) == F.col("_keep")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies of a table, with all its columns."""
    rows = numbered(docs)
    gone = decided(lambda: _grouped(_named(rows, id_col, text_col, RID)).where("not kept").select(RID))
    return rows.join(gone, RID, "left_anti").drop(RID)
