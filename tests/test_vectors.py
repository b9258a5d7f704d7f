"""Measures, best match, pooling and the same-person check."""

import random

import numpy as np
import pytest
from doorledger.functions import vectors as v
from doorledger.operators import pooling, similarity

SCHEMA = "id string, embedding array<float>"


def _pair(spark, a, b):
    return spark.createDataFrame([(a, b)], "a array<float>, b array<float>")


def test_cosine_properties(spark):
    rnd = np.random.default_rng(0)
    a, b = rnd.normal(size=512).tolist(), rnd.normal(size=512).tolist()
    r = _pair(spark, a, b).select(v.cosine_similarity("a", "a").alias("same"),
                                  v.cosine_similarity("a", "b").alias("ab"),
                                  v.cosine_similarity("b", "a").alias("ba"),
                                  v.cosine_distance("a", "a").alias("d")).first()
    assert r.same == pytest.approx(1) and r.ab == pytest.approx(r.ba) and -1 <= r.ab <= 1
    assert r.d == pytest.approx(0)
    x, y = [0.0] * 512, [0.0] * 512
    x[0], y[1] = 1.0, 1.0
    r = _pair(spark, x, y).select(v.cosine_similarity("a", "b").alias("c"),
                                  v.euclidean("a", "b").alias("e"),
                                  v.euclidean_l2("a", "b").alias("l")).first()
    assert (r.c, r.e, r.l) == (0.0, pytest.approx(2 ** .5), pytest.approx(2 ** .5))


def test_zero_vector_and_unknown_metric(spark):
    r = _pair(spark, [0.0, 0.0], [1.0, 0.0]).select(v.cosine_similarity("a", "b").alias("c")).first()
    assert r.c is None
    with pytest.raises(ValueError, match="Unknown metric: manhattan"):
        v.similarity("a", "b", "manhattan")


def test_verify_pair(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [(r.r.is_same, r.r.similarity) for r in df.select(v.verify_pair("a", "b").alias("r"))
           .collect()]
    assert got == [(True, 1.0), (False, 0.0), (False, 0.0)]


FORMS = [{}, {"broadcast_bytes": 0, "block_bytes": 64}]


def _match(spark, queries, gallery, threshold=None, **form):
    q = spark.createDataFrame(queries, SCHEMA)
    g = spark.createDataFrame(gallery, SCHEMA)
    r = similarity.best_match(q, g, threshold, query_id="id", gallery_id="id", **form)
    return {x.query_id: (x.match_id, x.score) for x in r.collect()}


@pytest.mark.parametrize("form", FORMS)
def test_best_match_edges(spark, form):
    gallery = [("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("z", [0.0, 0.0]), ("n", None)]
    queries = [("same", [3.0, 0.0]), ("side", [0.0, 1.0]), ("back", [-1.0, 0.0]),
               ("zero", [0.0, 0.0]), ("none", None), ("edge", [3.0, 4.0])]
    got = _match(spark, queries, gallery, **form)
    assert got["same"] == ("a", 1.0)          # tie: first in order
    assert got["side"] == (None, 0.0)         # below the threshold keeps its score
    assert got["back"] == (None, -1.0)
    assert got["zero"] == (None, -1.0) and got["none"] == (None, -1.0)
    assert got["edge"][0] == "a"              # 0.6 reaches the default threshold
    assert _match(spark, queries, gallery, 0.0, **form)["side"] == (None, 0.0)  # 0 = default
    assert _match(spark, queries, gallery, 0.9999, **form)["edge"][0] is None


@pytest.mark.parametrize("form", FORMS)
def test_empty_gallery(spark, form):
    got = _match(spark, [("q", [1.0, 0.0])], [], **form)
    assert got == {"q": (None, None)}


def test_blocked_equals_broadcast_and_brute_force(spark):
    rnd = np.random.default_rng(1)
    q = [(f"q{i}", x.tolist()) for i, x in enumerate(rnd.normal(size=(57, 8)).astype("f4"))]
    base = rnd.normal(size=(20, 8)).astype("f4")
    # every gallery vector twice, so that ties are everywhere
    g = [(f"g{i:02d}", base[i % 20].tolist()) for i in range(40)]
    qd, gd = spark.createDataFrame(q, SCHEMA), spark.createDataFrame(g, SCHEMA)
    want = {}
    for name, x in q:
        x = np.array(x, dtype="f8")
        s = [(-(x @ y) / np.sqrt((x @ x) * (y @ y)), n) for n, y in
             ((n, np.array(y, dtype="f8")) for n, y in g)]
        want[name] = [n for _, n in sorted((round(a, 12), n) for a, n in s)[:5]]
    for form in ({}, {"broadcast_bytes": 0, "block_bytes": 8 * 8 * 7}):
        top = similarity.top_k_matches(qd, gd, 5, "id", "id", **form).collect()
        got = {}
        for r in sorted(top, key=lambda r: r.rank):
            got.setdefault(r.query_id, []).append(r.match_id)
        assert got == want
        best = similarity.best_match(qd, gd, 1e-9, "id", "id", **form).collect()
        assert {r.query_id: r.match_id for r in best if r.match_id} == {
            k: n[0] for k, n in want.items() if any(r.query_id == k and r.match_id for r in best)}


def test_gallery_fallback_is_all_or_nothing(spark):
    off = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], SCHEMA)
    on = spark.createDataFrame([("a", [9.0]), ("b", None)], SCHEMA)
    assert [r.id for r in similarity.gallery_with_fallback(on, off).collect()] == ["a"]
    none = on.where("id = 'b'")
    assert similarity.gallery_with_fallback(none, off).count() == 2


def _images(spark, groups):
    rows = [(k, i, x.tolist()) for k, m in groups.items() for i, x in enumerate(m)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "request_id string, pos int, embedding array<float>")


@pytest.mark.parametrize("limit", [20_000, 3])
def test_pooling_equals_median(spark, limit):
    rnd = np.random.default_rng(2)
    groups = {f"r{n}": rnd.normal(size=(n, 6)).astype("f4") for n in (1, 2, 3, 4, 9, 50)}
    groups["same"] = np.repeat(np.array([[1, -1, 0, 2, -0.0, 3]], dtype="f4"), 6, axis=0)
    got = {r.request_id: r for r in pooling.pool_embeddings(
        _images(spark, groups), group_limit=limit).collect()}
    assert set(got) == set(groups)
    for k, m in groups.items():
        want = np.median(m.astype("f8"), axis=0).astype("f4")
        assert np.array_equal(np.array(got[k].embedding, dtype="f4"), want), k
        assert got[k].images == len(m)


def _brute(m, limit):
    for i in range(len(m)):
        for j in range(i + 1, len(m)):
            a, b = m[i].astype("f8"), m[j].astype("f8")
            n = np.sqrt((a @ a) * (b @ b))
            if n > 0 and 1 - a @ b / n > limit:
                return i, j
    return None


@pytest.mark.parametrize("block_rows, limit", [(4096, 20_000), (4, 5)])
def test_same_person_equals_all_pairs(spark, block_rows, limit):
    rnd = np.random.default_rng(4)
    groups = {}
    for k in range(40):
        spread = rnd.choice([0.05, 0.4, 0.6, 0.8, 1.2])
        groups[f"r{k}"] = (rnd.normal(size=6) + spread * rnd.normal(
            size=(rnd.integers(1, 14), 6))).astype("f4")
    groups["zero"] = np.array([[0, 0], [1, 0], [0, 1]], dtype="f4")
    groups["one"] = np.array([[1, 0]], dtype="f4")
    got = {r.request_id: r for r in pooling.same_person(
        _images(spark, groups), block_rows=block_rows, group_limit=limit).collect()}
    pivots = 0
    for k, m in groups.items():
        want = _brute(m, 0.4)
        assert got[k].same_person == (want is None), k
        if want:
            assert (got[k].first_i, got[k].first_j) == want, k
            pivots += want[0] > 0
    assert pivots > 2  # some were only found beyond the first image


def test_distance_limit_is_strict(spark):
    c = 0.6  # cosine of a 3-4-5 pair, distance exactly 0.4
    m = np.array([[5, 0], [3, 4]], dtype="f4")
    r = pooling.same_person(_images(spark, {"r": m}), max_distance=1 - c).first()
    assert r.same_person
    r = pooling.same_person(_images(spark, {"r": m}), max_distance=0.3999).first()
    assert not r.same_person


def test_repeated_and_null_query_ids_have_their_own_match(spark):
    from doorledger.operators.similarity import best_match
    g = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "match_id bigint, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.1]), (1, [0.1, 1.0]), (None, [1.0, 0.2])], "query_id bigint, embedding array<float>")
    for limit in (1 << 26, 0):
        found = best_match(q, g, 0.5, broadcast_bytes=limit).collect()
        assert sorted((r.query_id or -1, r.match_id) for r in found) == [(-1, 7), (1, 7), (1, 8)]


def test_large_tables_take_larger_blocks():
    """Every vector is sent once per block of the other side: 51,282 of width 64 went to 257 blocks."""
    least = 200 * 64 * 8
    assert [similarity._blocks(n, 64, least) for n in (0, 1, 200, 201, 1_000, 51_282)] == [1, 1, 1, 2, 5, 8]
    for n in (102_564, 615_384, 10_000_000):
        blocks = similarity._blocks(n, 64, least)
        assert blocks <= max(8, n / 65_536 + 1) and n / blocks * 64 * 8 <= similarity.BLOCK_BYTES
    assert similarity._blocks(1_000_000, 64, 64 << 20) == 8  # blocks asked to be larger stay so
