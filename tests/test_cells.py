"""Nearest vectors by cells beside a comparison of everything."""

import numpy as np
import pytest
from sectorlens.operators import cells

CORPUS, ASKED = "vec_id long, embedding array<double>", "query_id long, embedding array<double>"


def plain(pool, asked, n):
    def unit(m):
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    scores = np.round(unit(asked) @ unit(pool).T, 6) + 0.0
    return {(q, rank + 1, int(i), float(scores[q, i])) for q in range(len(asked))
            for rank, i in enumerate(np.lexsort((np.arange(len(pool)), -scores[q]))[:n])}


def tables(spark, pool, asked):
    return (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pool)], CORPUS),
            spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], ASKED))


def rows(found):
    return {(r.query_id, r["rank"], r.vec_id, r.score + 0.0) for r in found.rows.collect()}


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(cells, "PART_ROWS", 30)
    monkeypatch.setattr(cells, "SHARE_ROWS", 5)


def test_clusters_are_skipped_and_nothing_is_lost(spark, small_blocks):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    # A third of the rows lies in one cluster; many are equal to others or zero.
    own = np.where(rng.random(900) < 1 / 3, 0, rng.integers(0, 20, 900))
    pool = centres[own] + 0.1 * rng.normal(size=(900, 16))
    pool[100:200] = pool[:100]
    pool[500:520] = 0
    asked = np.concatenate([pool[::50], -pool[:3], np.zeros((1, 16))])
    found = cells.nearest(*tables(spark, pool, asked), n=10)
    assert rows(found) == plain(pool, asked, 10)
    met = [r.compared for r in found.work.where("query_id < 18 and query_id <> 10").collect()]
    assert np.mean(met) < 0.5 * len(pool)


@pytest.mark.parametrize("pool", [np.zeros((0, 3)), np.zeros((3, 3)), np.array([[1., 0, 0], [0, 0, 0], [-1, 0, 0]])])
def test_few_vectors(spark, pool):
    asked = np.array([[1., 1, 0], [0, 0, 0]])
    assert rows(cells.nearest(*tables(spark, pool, asked), n=5)) == plain(pool, asked, 5)


def test_no_questions_and_rows_without_a_vector(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], CORPUS)
    assert cells.nearest(corpus, spark.createDataFrame([], ASKED)).rows.count() == 0
    asked = corpus.withColumnRenamed("vec_id", "query_id")
    got = {(r.query_id, r.vec_id) for r in cells.nearest(corpus, asked, 2).rows.collect()}
    assert got == {(1, 1), (1, 3), (3, 1), (3, 3)}
