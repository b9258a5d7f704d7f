"""Embedding queries. A label plays the part of a person; its pooled vector is its template."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import table
from doorledger.functions import vectors as v
from doorledger.operators import pooling, pruned, similarity


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def _templates(spark, sf_dir):
    return pooling.pool_embeddings(_emb(spark, sf_dir), "label", "vec_id")


def _with_template(spark, sf_dir):
    t = _templates(spark, sf_dir).select("label", F.col("embedding").alias("template"))
    return _emb(spark, sf_dir).join(t, "label")


def _measure(metric):
    def run(spark, sf_dir):
        return _with_template(spark, sf_dir).select("vec_id", F.round(
            v.similarity("embedding", "template", metric), 6).alias(metric))
    return run


def verify_pairs(spark, sf_dir):
    r = v.verify_pair("embedding", "template", 0.2)
    return (_with_template(spark, sf_dir).withColumn("r", r)
            .select("vec_id", F.col("r.is_same").cast("int").alias("is_same"),
                    F.round("r.similarity", 6).alias("similarity")))


def pooled_embeddings(spark, sf_dir):
    return _templates(spark, sf_dir).select("label", "images", F.posexplode("embedding").alias(
        "pos", "x")).select("label", "images", "pos", F.round(F.col("x").cast("double"), 6)
                            .alias("value"))


def best_match(spark, sf_dir):
    """Every vector against the templates of all labels."""
    g = _templates(spark, sf_dir).withColumnRenamed("label", "match_id")
    r = similarity.best_match(_emb(spark, sf_dir), g, 0.25, query_id="vec_id")
    return r.select("query_id", "match_id", F.round("score", 6).alias("score"))


def top_k_matches(spark, sf_dir):
    """Every vector against all vectors; the first is the vector itself."""
    e = _emb(spark, sf_dir)
    r = similarity.top_k_matches(e, e, 5, query_id="vec_id", gallery_id="vec_id")
    return r.select("query_id", "rank", "match_id", F.round("score", 6).alias("score"))


def best_match_blocked(spark, sf_dir):
    """The form for galleries too big to broadcast, forced on the same tables."""
    e = _emb(spark, sf_dir)
    r = similarity.best_match(e, e, 0.35, query_id="vec_id", gallery_id="vec_id",
                              broadcast_bytes=0, block_bytes=200 * 64 * 8)
    return r.select("query_id", "match_id", F.round("score", 6).alias("score"))


def best_match_pruned(spark, sf_dir):
    """The same answers from the blocks of the gallery that can hold them."""
    e = _emb(spark, sf_dir)
    r = pruned.pruned_best_match(e, e, 0.35, query_id="vec_id", gallery_id="vec_id")
    return r.select("query_id", "match_id", F.round("score", 6).alias("score"))


def _same_person(limit):
    def run(spark, sf_dir):
        r = pooling.same_person(_emb(spark, sf_dir), "label", "vec_id", limit)
        return r.select("label", "images", F.col("same_person").cast("int").alias("same_person"),
                        "first_i", "first_j", F.round("distance", 6).alias("distance"))
    return run


_TEMPLATES_SQL = """
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
cells AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM emb),
med AS (SELECT label, pos, CAST(CAST(median(x) AS FLOAT) AS DOUBLE) AS m, count(*) AS n
        FROM cells GROUP BY 1, 2),
templates AS (SELECT label, list(m ORDER BY pos) AS t FROM med GROUP BY 1)
"""
_PAIR = f"WITH {_TEMPLATES_SQL} SELECT vec_id, %s FROM emb JOIN templates USING (label)"
_L2 = ("sqrt(list_sum(list_transform(list_zip({a}, {b}), "
       "lambda p: (p[1] {na} - p[2] {nb}) * (p[1] {na} - p[2] {nb}))))")


def _same_sql(limit):
    return f"""WITH {_TEMPLATES_SQL},
        pairs AS (SELECT a.label, a.vec_id AS i, b.vec_id AS j,
                         1 - list_cosine_similarity(a.e, b.e) AS d
                  FROM emb a JOIN emb b ON a.label = b.label AND a.vec_id < b.vec_id),
        bad AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY i, j) AS n
                FROM pairs WHERE d > {limit})
        SELECT s.label, s.images, CASE WHEN i IS NULL THEN 1 ELSE 0 END AS same_person,
               i AS first_i, j AS first_j, round(d, 6) AS distance
        FROM (SELECT label, count(*) AS images FROM emb GROUP BY 1) s
        LEFT JOIN bad ON s.label = bad.label AND n = 1"""


QUERIES = {
    "cosine_pairs": (_measure("cosine"),
                     _PAIR % "round(list_cosine_similarity(e, t), 6) AS cosine"),
    "euclidean_pairs": (_measure("euclidean"), _PAIR % (
        "round(" + _L2.format(a="e", b="t", na="", nb="") + ", 6) AS euclidean")),
    "euclidean_l2_pairs": (_measure("euclidean_l2"), _PAIR % (
        "round(sqrt(greatest(0, 2 - 2 * list_cosine_similarity(e, t))), 6) AS euclidean_l2")),
    "verify_pairs": (verify_pairs, _PAIR % (
        "CASE WHEN list_cosine_similarity(e, t) >= 0.2 THEN 1 ELSE 0 END AS is_same, "
        "round(list_cosine_similarity(e, t), 6) AS similarity")),
    "pooled_embeddings": (pooled_embeddings, f"""WITH {_TEMPLATES_SQL}
        SELECT label, n AS images, CAST(pos - 1 AS INTEGER) AS pos, round(m, 6) AS value
        FROM med"""),
    "best_match": (best_match, f"""WITH {_TEMPLATES_SQL}, s AS (
        SELECT vec_id, templates.label, list_cosine_similarity(e, t) AS c,
               row_number() OVER (PARTITION BY vec_id
                 ORDER BY list_cosine_similarity(e, t) DESC, templates.label) AS n
        FROM emb, templates)
        SELECT vec_id AS query_id, CASE WHEN c >= 0.25 THEN label END AS match_id,
               round(c, 6) AS score FROM s WHERE n = 1"""),
    "top_k_matches": (top_k_matches, f"""WITH {_TEMPLATES_SQL}, s AS (
        SELECT a.vec_id AS q, b.vec_id AS m, list_cosine_similarity(a.e, b.e) AS c,
               row_number() OVER (PARTITION BY a.vec_id
                 ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.vec_id) AS n
        FROM emb a, emb b)
        SELECT q AS query_id, CAST(n AS INTEGER) AS rank, m AS match_id, round(c, 6) AS score
        FROM s WHERE n <= 5"""),
    "best_match_blocked": (best_match_blocked, f"""WITH {_TEMPLATES_SQL}, s AS (
        SELECT a.vec_id AS q, b.vec_id AS m, list_cosine_similarity(a.e, b.e) AS c,
               row_number() OVER (PARTITION BY a.vec_id
                 ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.vec_id) AS n
        FROM emb a, emb b)
        SELECT q AS query_id, CASE WHEN c >= 0.35 THEN m END AS match_id, round(c, 6) AS score
        FROM s WHERE n = 1"""),
    "best_match_pruned": (best_match_pruned, f"""WITH {_TEMPLATES_SQL}, s AS (
        SELECT a.vec_id AS q, b.vec_id AS m, list_cosine_similarity(a.e, b.e) AS c,
               row_number() OVER (PARTITION BY a.vec_id
                 ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.vec_id) AS n
        FROM emb a, emb b)
        SELECT q AS query_id, CASE WHEN c >= 0.35 THEN m END AS match_id, round(c, 6) AS score
        FROM s WHERE n = 1"""),
    "same_person_check": (_same_person(0.4), _same_sql(0.4)),
    "same_person_wide": (_same_person(1.2), _same_sql(1.2)),
}
