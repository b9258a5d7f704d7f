"""Pruned search against comparing everything."""

import numpy as np
import pytest

from doorledger.operators.pruned import pruned_best_match

DDL = "id long, embedding array<double>"


def clustered(rng, n, width=16, clusters=12):
    centre = rng.normal(size=(clusters, width))
    return centre[rng.integers(0, clusters, n)] * rng.uniform(0.5, 2, (n, 1)) + rng.normal(scale=0.05, size=(n, width))


@pytest.mark.parametrize("rows", [4096, 20])
def test_pruned_search_equals_brute_force(spark, rows):
    rng = np.random.default_rng(rows)
    drawn = clustered(rng, 800)
    g = drawn[:600].copy()
    g[50] = g[7]  # a tie goes to the first
    q = np.concatenate([drawn[600:], g[[7, 50]] * 3, rng.normal(size=(60, 16))])
    gallery = [(i, v.tolist()) for i, v in enumerate(g)] + [(900, [0.0] * 16), (901, None)]
    asked = [(i, v.tolist()) for i, v in enumerate(q)] + [(500, [0.0] * 16), (501, None), (3, q[4].tolist())]
    out = pruned_best_match(spark.createDataFrame(asked, DDL).repartition(3), spark.createDataFrame(gallery, DDL).repartition(3), 0.2,
                            query_id="id", gallery_id="id", rows=rows).collect()
    assert len(out) == len(asked)
    cos = (q / np.linalg.norm(q, axis=1)[:, None]) @ (g / np.linalg.norm(g, axis=1)[:, None]).T
    by_id = {}
    for r in out:
        by_id.setdefault(r.query_id, []).append(r)
    for i in range(len(q)):
        best = cos[i].max()
        mine = [r for r in by_id[i] if abs(r.score - best) < 1e-12]
        assert mine and (best < 0.2 or mine[0].match_id == int(np.flatnonzero(cos[i] > best - 1e-13)[0]))
    assert [(r.match_id, r.score, r.visited) for i in (500, 501) for r in by_id[i]] == [(None, -1.0, 0)] * 2
    near = [r.visited for i in range(200) for r in by_id[i]]
    assert np.mean(near) < 0.2 * len(g)  # clustered vectors are mostly left unvisited


def test_pruned_search_of_nothing(spark):
    some = spark.createDataFrame([(1, [1.0, 0.0])], DDL)
    none = some.where("false")
    assert [(r.match_id, r.score) for r in pruned_best_match(some, none, query_id="id", gallery_id="id").collect()] == [(None, None)]
    zero = spark.createDataFrame([(1, [0.0, 0.0])], DDL)
    assert [(r.match_id, r.score) for r in pruned_best_match(some, zero, query_id="id", gallery_id="id").collect()] == [(None, -1.0)]
    assert pruned_best_match(none, some, query_id="id", gallery_id="id").count() == 0
