"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, operator by operator."""

import pytest
from pyspark.sql import functions as F

from sectorlens.llm import (jaccard, licenses, neighbours, packing, pieces, quality, secrets, suffixes,
                            toxicity, urls)

SCHEMA = ("doc_id long, text string, source string, score double, component_id string, n int, "
          "start string, length string, row string, key string, tokens string, rule string")


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, 0.5, "x", 1, "a", "b", "c", "d", "e", "f") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    return table(spark, [(1, "one two three four"), (1, "one two three four"), (None, "one two three four"),
                         (None, "alone here"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "é" * 5000)])


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def test_packing(docs, empty):
    rows = packing.packed(docs).collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6}
    assert [(r.length, r.ids) for r in rows if r.doc_id == 2] == [(1, [packing.END])]
    assert sum(r.doc_tokens for r in rows if r.doc_id == 1 and r.start == 0) == 2 * 5
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert packing.packed(empty).collect() == []


def test_pieces(docs, empty):
    rows = pieces.encoded(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.n_tokens == 0 and r.decoded == "" for r in rows if r.doc_id in (2, 3))
    assert pieces.encoded(empty).collect() == []


def test_quality(docs, empty):
    rows = quality.cascade(quality.measured(docs), list(quality.DEFAULT_RULES)).collect()
    assert len(rows) == docs.count() and "component_id" in rows[0].asDict()
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert all(r.n_words == r.n_repeat_words == r.n_dup_lines == 0 and r.rejected_by is None for r in blank)
    assert [r.n_repeat_words for r in rows if r.doc_id == 5] == [30_000]
    measured = quality.measured(empty)
    assert quality.cascade(measured, quality.ordered(measured)).collect() == []


def test_licenses(docs, empty):
    rows = licenses.scanned(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.n_base == 0 and r.labels == "" and r.score == 0 and r.first_word is None for r in rows)
    assert licenses.scanned(empty).collect() == []


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (5, 0), (None, 1), (99, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.train(docs, known)
        rows = toxicity.scored(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(empty, toxicity.train(empty, labels)).collect() == []


def test_jaccard(docs, empty):
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.joined(docs).collect())
    assert rows == [(0, 1, None), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4),
                    (5, 700, 5), (6, 1, 6)]
    assert jaccard.joined(empty).collect() == []


def test_suffixes(docs, empty):
    found = suffixes.matches(docs)
    # The long text repeats its 700 words over and over; the others are too short.
    rows = found.collect()
    assert rows and {r.doc_id for r in rows} == {5} and all(r.source_start < r.start for r in rows)
    after = suffixes.cut(docs, found)
    assert after.columns == docs.columns and after.count() == docs.count()
    assert [len(r.text.split()) for r in after.where("doc_id = 5").collect()] == [700]
    assert suffixes.matches(empty).collect() == []
    assert suffixes.cut(empty, found).collect() == []


def test_secrets(docs, empty):
    label = F.lit(None).cast("int")
    rows = secrets.scanned(docs, label).collect()
    assert all(r.score == 0 for r in rows)
    assert secrets.scanned(empty, label).collect() == []
    same = secrets.masked(docs, secrets.scanned(docs, F.lit(1)).where("score > 2"))
    assert same.columns == docs.columns and same.exceptAll(docs).count() == 0


def test_urls(spark):
    schema = "page_id long, url string, canonical string, hit string, block int"
    rows = [(1, None), (2, "no scheme"), (None, "http://A.org/x"), (3, "http://bad.net/p/"), (3, "http://bad.net/p/"),
            (4, "http://www.bad.net/p.html?q"), (5, "://"), (6, "http://" + "h" * 50_000 + ".net/")]
    pages = spark.createDataFrame([(i, u, "c", "h", 1) for i, u in rows], schema)
    listing = spark.createDataFrame([("bad.net/p",), (None,), ("bad.net/p",)], "canonical string")
    for size in (urls.BROADCAST_BLOCKS, 0):
        got = urls.listed(pages.select("page_id", urls.canonical(F.col("url")).alias("canonical")),
                          ["page_id"], "canonical", listing, size)
        assert sorted(r.page_id for r in got.collect()) == [3, 3, 4]
    judged = {(r.page_id, r.host[:9], r.path, r.rule, r.verdict)
              for r in urls.judged(pages, (("allow", "org/"),), listing).collect()}
    assert judged >= {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "a.org", "/x", "org/", "allow"),
                      (3, "bad.net", "/p/", None, "block"), (4, "www.bad.n", "/p.html", None, "block")}
    assert urls.judged(pages.limit(0), (("allow", "org/"),), listing.limit(0)).collect() == []


def test_neighbours(spark):
    nan, schema = float("nan"), "vec_id long, embedding array<float>, rank int, score string"
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [nan, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0])]
    vectors = spark.createDataFrame([(i, v, 0, "s") for i, v in rows], schema)
    got = neighbours.nearest(vectors, F.col("vec_id") < 100).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in got) == [
        (1, 1, 2, 0.0), (1, 2, 3, 1.414214), (2, 1, 1, 0.0), (2, 2, 3, 1.414214), (3, 1, 1, 1.414214),
        (3, 2, 2, 1.414214)]
    assert neighbours.nearest(vectors.limit(0), F.col("vec_id") < 9).collect() == []
