"""Ranked lexical search with bag deduplication.

Only terms that some item asks for can score, so a document is reduced to its counts of the items'
vocabulary and to ``m``, what its length contributes. Documents with equal counts and equal ``m`` score alike for
every item: they form a class, found by a hash of both and verified on the whole bytes. Each class is scored
once, against all items through postings of the vocabulary; a task keeps the best ``k`` classes per item (ties: smallest
member first), which is exact, since the members of a class that comes after ``k`` others come after ``k``
documents. The winners are expanded to their members by ascending id, at most ``k`` each.

Items are taken in blocks of about ``BLOCK`` postings, by hash, whose vocabulary goes to all tasks; documents are read once a
block. Document frequencies, the number of documents and their length are counted over all rows.

Null and empty texts hold no term: such a document ranks nowhere and such an item returns nothing. Texts are read
in slices, so a very long one needs no more memory than its distinct terms of the vocabulary. Repeated documents are
documents of their own, repeated items are ranked each for itself, null ids come last in a tie. Empty tables
give no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doorledger.llm.common import map_rows, numbered, stored

#: (item, term) pairs of a block of items
BLOCK = 1 << 20
_SLICE = 4 << 20
#: products of a class's terms and their postings that are added up at a time
_AT_ONCE = 1 << 21
_LAST = np.iinfo(np.int64).max

#: bytes of terms, A-Z lower-cased; all others separate
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_runs(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of a few megabytes; no term is cut."""
    text, start = text or b"", 0
    while start < len(text):
        part = text[start:start + _SLICE].translate(_FOLD)
        end = start + _SLICE
        while end < len(text) and part[-1:] != b" ":  # go back to a separator, or on to one
            cut = part.rfind(b" ")
            if cut >= 0:
                part, end = part[:cut + 1], end - (len(part) - cut - 1)
            else:
                more = text[end:end + _SLICE].translate(_FOLD)
                stop = more.find(b" ")
                part += more if stop < 0 else more[:stop + 1]
                end += len(more) if stop < 0 else stop + 1
        yield part.split()
        start = end


def counts(text: bytes | None, vocabulary: dict[bytes, int] | None = None) -> tuple[int, Counter]:
    """Number of terms, and how often each one (of the vocabulary, then by its number) occurs."""
    n, found = 0, Counter()
    for terms in term_runs(text):
        n += len(terms)
        if vocabulary is None:
            found.update(terms)
        else:
            part = Counter(terms)
            for t in part.keys() & vocabulary.keys():
                found[vocabulary[t]] += part[t]
    return n, found


def pack(found: Counter) -> bytes:
    """Counts by term number as bytes; equal counts give equal bytes."""
    if not found:
        return b""
    ids = np.array(sorted(found), "<u4")
    tf = np.array([found[i] for i in ids.tolist()], "<i8")
    kind = "<u2" if tf.max() < 1 << 16 else "<i8"
    return bytes([2 if kind == "<u2" else 8]) + ids.tobytes() + tf.astype(kind).tobytes()


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = raw[0]
    n = (len(raw) - 1) // (4 + wide)
    return np.frombuffer(raw, "<u4", n, 1), np.frombuffer(raw, "<u2" if wide == 2 else "<i8", n, 1 + 4 * n)


class Postings:
    """For each term, by number, the items (0, 1, ...) that hold it and how often."""

    def __init__(self, item: np.ndarray, term: np.ndarray, n: np.ndarray, terms: int, items: int):
        order = np.argsort(term, kind="stable")
        self.item, self.n, self.items = item[order].astype(np.int64), n[order].astype(np.int64), items
        self.first = np.searchsorted(term[order], np.arange(terms + 1))

    def scores(self, vectors: list[bytes], m: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the first vector, scores by vector and item) for a few vectors at a time."""
        parts = [unpack(v) for v in vectors]
        ids = np.concatenate([p[0] for p in parts])
        tf = np.concatenate([p[1].astype(np.int64) for p in parts])
        size = np.array([len(p[0]) for p in parts])
        gain = weight[ids] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, size)))
        length = self.first[ids + 1] - self.first[ids]
        begin = np.concatenate([[0], np.cumsum(size)])
        work = np.maximum(np.concatenate([[0], np.cumsum(length)])[begin], np.arange(len(vectors) + 1) * self.items)
        start = 0
        while start < len(vectors):
            stop = max(start + 1, int(np.searchsorted(work, work[start] + _AT_ONCE, "right")) - 1)
            s, e = begin[start], begin[stop]
            reps = length[s:e]
            at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(self.first[ids[s:e]], reps)
            row = np.repeat(np.arange(stop - start), size[start:stop])
            out = np.zeros((stop - start) * self.items, np.int64)
            np.add.at(out, np.repeat(row * self.items, reps) + self.item[at], np.repeat(gain[s:e], reps) * self.n[at])
            yield start, out.reshape(-1, self.items)
            start = stop


class Best:
    """The best ``k`` classes of each item: highest score, then smallest member."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, first, class

    def add(self, scores: np.ndarray, first: np.ndarray, cid: np.ndarray) -> None:
        at, item = np.nonzero(scores >= self.least)
        new = (item, scores[at, item], first[at], cid[at])
        item, score, first, cid = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((cid, first, -score, item))
        begin = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - begin[item[order]]
        keep = order[rank < self.k]
        self.rows = [x[keep] for x in (item, score, first, cid)]
        full = order[rank == self.k - 1]
        self.least[item[full]] = score[full]


def _vectors(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        known = vocabulary.value
        for b in batches:
            found = [counts(t.as_py(), known) for t in b["_text"]]
            yield {"id": b["_id"], "n": [n for n, _ in found], "vec": [pack(c) for _, c in found]}

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return map_rows(rows, run, "id long, n long, vec binary")


def _statistics(vectors: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and per term of the vocabulary the documents that hold it."""
    def run(batches):
        df, docs, length = np.zeros(terms, np.int64), 0, 0
        for b in batches:
            docs, length = docs + int((b["n"].to_numpy() > 0).sum()), length + int(b["n"].to_numpy().sum())
            held = [unpack(v)[0] for v in b["vec"].to_pylist() if v]
            if held:
                df += np.bincount(np.concatenate(held), minlength=terms)
        at = np.flatnonzero(df)
        yield {"term": np.append(at, [-1, -2]), "n": np.append(df[at], [docs, length])}

    total = dict(map_rows(vectors.select("n", "vec"), run, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.array([total.get(i, 0) for i in range(terms)], np.int64)
    return total.get(-1, 0), total.get(-2, 0), df


def _ranked_block(docs: DataFrame, postings: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, rank, id, score) for the items of one block, given as (item, term, n)."""
    spark = docs.sparkSession
    names = sorted({p[0] for p in postings})
    terms = sorted({bytes(p[1]) for p in postings})
    number = {t: i for i, t in enumerate(terms)}
    place = {x: i for i, x in enumerate(names)}
    index = Postings(np.array([place[p[0]] for p in postings]), np.array([number[bytes(p[1])] for p in postings]),
                     np.array([p[2] for p in postings]), len(terms), len(names))
    vectors = stored(_vectors(docs, spark.sparkContext.broadcast(number), id_col, text_col))
    n_docs, length, df = _statistics(vectors, len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}L) div {max(length, 1)}L")
    bags = (vectors.where("length(vec) > 0").select("id", m.alias("m"), "vec")
            .withColumn("key", F.xxhash64("m", "vec")))
    classes = stored(bags.groupBy("key", "m", "vec").agg(F.min("id").alias("first"))
                     .withColumn("cid", F.monotonically_increasing_id()))
    shared = spark.sparkContext.broadcast((index, weight))

    def score(batches):
        index, weight = shared.value
        best = Best(index.items, k)
        for b in batches:
            m, cid = (b[c].to_numpy(zero_copy_only=False) for c in ("m", "cid"))
            first = b["first"].fill_null(_LAST).to_numpy(zero_copy_only=False)
            for start, scores in index.scores(b["vec"].to_pylist(), m, weight):
                stop = start + len(scores)
                best.add(scores, first[start:stop], cid[start:stop])
        yield dict(zip(("item", "score", "first", "cid"), best.rows, strict=True))

    per_item = Window.partitionBy("item").orderBy(F.desc("score"), "first", "cid")
    won = stored(map_rows(classes.select("m", "vec", "first", "cid"), score, "item long, score long, first long, cid long")
                 .withColumn("r", F.row_number().over(per_item)).where(F.col("r") <= k).select("item", "score", "cid"))
    chosen = classes.join(won.select("cid").distinct(), "cid", "left_semi").select("key", "m", "vec", "cid")
    by_id = Window.partitionBy("cid").orderBy(F.col("id").asc_nulls_last())
    members = (bags.join(chosen, ["key", "m", "vec"]).select("cid", "id")
               .withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k).drop("r"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    label = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "item long, row long")
    return (won.join(members, "cid").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(label, "item").select("row", "rank", "id", "score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(item, rank, id, score): per row of ``items`` its ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    rows = numbered(items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("binary").alias("_text")))

    def run(batches):
        for b in batches:
            for rid, text in zip(b["__rid"].to_pylist(), b["_text"], strict=True):
                _, found = counts(text.as_py())
                yield {"row": pa.array([rid] * len(found), pa.int64()), "term": pa.array(list(found), pa.binary()),
                       "n": pa.array(list(found.values()), pa.int64())}

    postings = stored(map_rows(rows.select("__rid", "_text"), run, "row long, term binary, n long"))
    blocks = max(1, -(-postings.count() // block))
    out = None
    for i in range(blocks):  # a block is about `block` postings, collected as an index for all tasks
        held = postings.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).collect()
        if held:
            part = _ranked_block(docs, held, k, id_col, text_col)
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "row long, rank int, id long, score long")
    return out.join(rows.select(F.col("__rid").alias("row"), "item"), "row").select("item", "rank", "id", "score")
