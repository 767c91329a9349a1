"""Hard negatives beside all products, and what the tree spares."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.llm import negatives


def plain(rows, asked, positives=5, n=10, low=30, high=90):
    """rows: id, label and integer vector."""
    found = []
    for a, label, v in rows:
        if not asked(a):
            continue
        scores = [(b, other, sum(int(x) * int(y) for x, y in zip(v, w))) for b, other, w in rows if b != a]
        near = sorted((-s, b) for b, other, s in scores if other == label)[:positives]
        for minus, b in near:
            p = -minus
            fit = sorted((-s, c) for c, other, s in scores if other != label and low * p <= 100 * s <= high * p)[:n]
            found += [(a, b, rank, c, p, -s) for rank, (s, c) in enumerate(fit, 1)]
    return sorted(found)


def made(seed, count, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    return [(int(i), int(rng.integers(4)), [float(x) for x in centres[rng.integers(8)] + spread * rng.normal(size=dims)])
            for i in rng.permutation(count)]


@pytest.mark.parametrize("count, dims, spread, tile", [(300, 4, 0.2, 16), (500, 16, 1.0, 64), (200, 3, 0.0, 32), (60, 2, 0.5, 4096)])
def test_equals_all_products(spark, count, dims, spread, tile):
    rows = made(count, count, dims, spread)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.mined(frame, F.col("vec_id") % 9 == 0, tile=tile).collect()
    whole = [(i, label, np.floor(256 * np.array(v)).astype(int)) for i, label, v in rows]
    assert sorted(map(tuple, found)) == plain(whole, lambda i: i % 9 == 0)


def test_several_blocks_of_queries_and_boxes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "QUERIES", 16)
    monkeypatch.setattr(negatives, "BOXES", 3)
    rows = made(7, 400, 5, 0.4)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.mined(frame, F.col("vec_id") % 5 == 0, tile=32).collect()
    whole = [(i, label, np.floor(256 * np.array(v)).astype(int)) for i, label, v in rows]
    assert sorted(map(tuple, found)) == plain(whole, lambda i: i % 5 == 0)


def test_the_queue_prunes_where_vectors_cluster():
    rows = made(3, 4096, 8, 0.01)
    tree = negatives.Tree(*(np.array(x) for x in zip(*[(i, label) for i, label, _ in rows])),
                          np.floor(256 * np.array([v for _, _, v in rows])))
    own = np.arange(64)
    free = [[{"key": 0, "low": None, "high": None, "kth": None, "kth_id": None}]] * 64
    found = list(tree.search(tree.ids[own], tree.labels[own], tree.points[own], free, True, 5))
    assert len(found) == 64 and tree.compared < 0.5 * 64 * 4096
    for q, (name, _, ids, scores) in enumerate(found):
        all_scores = tree.points @ tree.points[q]
        fit = np.flatnonzero((tree.labels == tree.labels[q]) & (tree.ids != name))
        best = fit[np.lexsort((tree.ids[fit], -all_scores[fit]))[:5]]
        assert ids.tolist() == tree.ids[best].tolist() and scores.tolist() == all_scores[best].tolist()


def test_products_beyond_floats_stay_exact(spark):
    rows = [(i, i % 2, [1.5e9 + i, -1.0e9 - 3 * i, float(i)]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.mined(frame, F.lit(True), scale=1.0, high=100).collect()
    whole = [(i, label, [int(x) for x in v]) for i, label, v in rows]
    assert found and sorted(map(tuple, found)) == plain(whole, lambda i: True, high=100)


def test_handling_of_odd_tables(spark):
    schema = "vec_id long, label int, embedding array<float>, id int, tile string, block int, v int, key int"
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [1.0, float(i % 5)], 1, "t", 2, 3, 4) for i in range(1, 41)]
    odd = [(None, 1, [1.0, 1.0]), (50, None, [1.0, 1.0]), (51, 1, None), (52, 1, [1.0, None]), (53, 1, [nan, 1.0]),
           (54, 1, [inf, 1.0]), (55, 1, [1.0]), (56, 1, [])]
    frame = spark.createDataFrame(good + good[:7] + [(*o, None, None, None, None, None) for o in odd], schema)
    found = negatives.mined(frame, F.col("vec_id") % 3 == 0).collect()
    whole = [(i, label, [int(256 * x) for x in v]) for i, label, v, *_ in good]
    assert sorted(map(tuple, found)) == plain(whole, lambda i: i % 3 == 0)
    assert negatives.mined(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    assert negatives.mined(frame, F.lit(None).cast("boolean")).collect() == []
    alone = spark.createDataFrame(good[:1], schema)
    assert negatives.mined(alone, F.lit(True)).collect() == []
    counts = collections.Counter((r.anchor_id, r.positive_id) for r in found)
    assert max(counts.values()) <= 10
