"""Embedding near-dedup: an exact metric range join of vectors with equal labels.

Cosine ``MINIMUM`` or more is a distance of at most ``RADIUS`` between unit vectors. Pivots, drawn by id hash, part each
label's vectors into cells by the nearest pivot. By the triangle inequality a vector can lie within the radius of
a cell's own vectors only if its distance to that cell's pivot exceeds its distance to its nearest pivot by no more
than two radii: to those cells it is copied, and each cell then finds all partners of its own vectors by itself.
The number of pivots follows the largest label (``CELL`` vectors a cell, at most ``MAX_PIVOTS``, all of which go
to the tasks); cells that are still larger are dealt in blocks. Equal vectors are joined as one with a count.
Cosines are computed in double precision; only counts and spanning edges leave a cell, never all pairs.

Vectors that are null, zero, or hold null or non-finite numbers, and rows without label, link with nothing;
nor do vectors of different lengths. Rows may repeat ids. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import RID, connected_components, counted, map_rows, shuffle_parts, stored

MINIMUM = 0.93
RADIUS = math.sqrt(2 - 2 * MINIMUM) + 1e-9
CELL, MAX_PIVOTS = 4096, 1024


def _usable(rows: DataFrame) -> DataFrame:
    """_rid, id, label and the vector as double-precision bytes, null where it cannot link."""
    def run(batches):
        for b in batches:
            vectors = []
            for label, v in zip(b["_label"].to_pylist(), b["_vec"].to_pylist(), strict=True):
                vectors.append(None)
                if label is not None and v and None not in v:
                    x = np.array(v, float)
                    if np.isfinite(x).all() and x.any() and np.isfinite(x @ x):
                        vectors[-1] = x.tobytes()
            yield {RID: b[RID], "id": b["id"], "label": b["_label"], "vec": pa.array(vectors, pa.binary())}

    return map_rows(rows, run, f"{RID} long, id long, label long, vec binary")


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), float).reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(classes: DataFrame, pivots) -> DataFrame:
    """Each vector in its own cell, and copied to the cells whose vectors can be near."""
    def run(batches):
        for b in batches:
            label, rid, n, raw = (b[c].to_pylist() for c in ("label", "rep", "n", "vec"))
            out = [[] for _ in range(7)]
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(raw):
                by_size.setdefault(len(v), []).append(i)
            for size, rows in by_size.items():
                u, p = _unit([raw[i] for i in rows]), pivots.value
                p = np.pad(p, ((0, 0), (0, max(0, size // 8 - p.shape[1]))))[:, :size // 8]  # any point can be a pivot
                far = np.sqrt(np.maximum((u ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None] - 2 * u @ p.T, 0))
                own = far.argmin(1)
                near = far <= far.min(1)[:, None] + 2 * RADIUS
                for k, i in enumerate(rows):
                    for c in np.flatnonzero(near[k]).tolist():
                        for column, value in zip(out, (label[i], size, c, c != own[k], rid[i], n[i], raw[i]), strict=True):
                            column.append(value)
            yield dict(zip(("label", "size", "cell", "guest", RID, "n", "vec"), out, strict=True))

    return map_rows(classes, run, f"label long, size int, cell int, guest boolean, {RID} long, n long, vec binary")


def _links(cells: DataFrame) -> DataFrame:
    """Per vector its links (``n``), and edges (``src``, ``dst``) that span what is linked."""
    sizes = cells.where("not guest").groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / CELL).alias("_nb"))
    dealt = (cells.join(sizes, ["label", "size", "cell"])
             .withColumn("_own", F.when(F.col("guest"), -1).otherwise(F.pmod(F.xxhash64(RID), F.col("_nb"))))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
             .withColumn("guest", F.col("_own") != F.col("block"))
             .select("label", "size", "cell", "block", "guest", RID, "n", "vec"))

    def run(batches):
        now, own, rest = None, [], []

        def compare(others, counts):
            """Links of the cell's own vectors to ``others``."""
            u, ids = home
            v = _unit([r[2] for r in others])
            hit_i, hit_j = np.nonzero(u @ v.T >= MINIMUM)
            rid = np.array([r[0] for r in others])
            apart = ids[hit_i] != rid[hit_j]
            hit_i, hit_j = hit_i[apart], hit_j[apart]
            np.add.at(counts, hit_i, np.array([r[1] for r in others])[hit_j])
            mark_i, mark_j = ids.copy(), rid.copy()
            while True:  # lowest number reachable inside this comparison
                before = mark_i.sum() + mark_j.sum()
                np.minimum.at(mark_j, hit_j, mark_i[hit_i])
                np.minimum.at(mark_i, hit_i, mark_j[hit_j])
                if mark_i.sum() + mark_j.sum() == before:
                    break
            src, dst = np.concatenate([ids, rid]), np.concatenate([mark_i, mark_j])
            return src[src != dst], dst[src != dst]

        def finish():
            nonlocal home
            edges = []
            if own:
                if home is None:
                    open_cell()
                if rest:
                    edges.append(compare(rest, counts))
                k = len(own)
                yield {"src": [r[0] for r in own], "dst": [None] * k, "n": counts.tolist()}
            for s, d in edges:
                if len(s):
                    yield {"src": s, "dst": d, "n": [None] * len(s)}
            own.clear()
            rest.clear()
            home = None

        def open_cell():
            nonlocal home, counts
            home = (_unit([r[2] for r in own]), np.array([r[0] for r in own]))
            counts = np.zeros(len(own), np.int64)
            rest.extend(own)

        home = counts = None
        for b in batches:
            for *key, guest, rid, n, vec in zip(*(b[c].to_pylist() for c in ("label", "size", "cell", "block", "guest", RID, "n", "vec")), strict=True):
                if key != now:
                    yield from finish()
                    now = key
                if not guest:
                    own.append((rid, n, vec))
                elif own:  # guests of a cell without vectors of its own meet nobody
                    if home is None:
                        open_cell()
                    rest.append((rid, n, vec))
                    if len(rest) >= CELL:
                        s, d = compare(rest, counts)
                        rest.clear()
                        if len(s):
                            yield {"src": s, "dst": d, "n": [None] * len(s)}
        yield from finish()

    parts = dealt.repartition(shuffle_parts(cells), "label", "size", "cell", "block")
    return map_rows(parts.sortWithinPartitions("label", "size", "cell", "block", "guest", RID), run, "src long, dst long, n long")


def vector_groups(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row of a stored table: id, n_links, component_id, kept."""
    spark = rows.sparkSession
    ids = counted(rows).select(RID, F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("_label"), F.col(vec_col).alias("_vec"))
    ids = stored(_usable(ids))  # numbered in this pass only; all that follows reads these rows
    usable = ids.where("vec is not null").select(RID, "label", "vec")
    classes = stored(usable.groupBy("label", "vec").agg(F.min(RID).alias("rep"), F.count("*").alias("n")))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    count = min(MAX_PIVOTS, max(1, -(-largest // CELL)))
    drawn = classes.orderBy(F.xxhash64("rep"), "rep").limit(count).select("vec").collect()  # MAX_PIVOTS at most
    width = max((len(r[0]) for r in drawn), default=8)
    pivots = spark.sparkContext.broadcast(np.array([np.pad(_unit([bytes(r[0])])[0], (0, (width - len(r[0])) // 8)) for r in drawn] or [np.zeros(1)]))
    found = stored(_links(_cells(classes.select("label", "rep", "n", "vec"), pivots)))
    members = usable.join(classes, ["label", "vec"]).select(RID, "rep", F.col("n").alias("_copies"))
    links = found.where("dst is null").groupBy("src").agg(F.sum("n").alias("_others"))
    members = stored(members.join(links, members["rep"] == links["src"]).select(RID, "rep", (F.col("_others") + F.col("_copies") - 1).alias("n_links")))
    copies = members.where(F.col(RID) != F.col("rep")).select(F.col(RID).alias("src"), F.col("rep").alias("dst"))
    component = connected_components(found.where("dst is not null").select("src", "dst").union(copies))
    out = (ids.select(RID, "id").join(members.select(RID, "n_links"), RID, "left")
           .join(component.select(F.col("node").alias(RID), "component"), RID, "left")
           .withColumn("component", F.coalesce("component", RID)))
    lowest = out.groupBy("component").agg(F.min("id").alias("component_id"))
    return out.join(lowest, "component").select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
                                                F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
