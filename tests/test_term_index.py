"""The index that grows by segments."""

import re

import pytest
from pyspark.sql import functions as F

from sectorlens.operators import retrieval
from sectorlens.sources.term_index import TermIndex

DOCS = [(i, " ".join(["alpha"] * (i % 3 + 1) + [f"word{i % 7}", f"rare{i}", "beta"])) for i in range(30)]


@pytest.fixture
def index(spark, tmp_path):
    return TermIndex.create(spark, str(tmp_path / "index"), buckets=8)


def docs(spark, chosen):
    return spark.createDataFrame([d for d in DOCS if chosen(d[0])], "doc_id long, text string")


def rows(df):
    return sorted((r.doc_id, r.term, r.tf, round(r.weight, 9)) for r in df.collect())


def test_segments_equal_one_build(spark, index):
    assert index.live() is None and index.segments() == []
    index.add(docs(spark, lambda i: i < 10))
    index.add(docs(spark, lambda i: 10 <= i < 25))
    index.delete(docs(spark, lambda i: i % 4 == 0))
    index.delete(spark.createDataFrame([(999,)], "doc_id long"))
    index.add(docs(spark, lambda i: i % 8 == 0 and i < 25))
    index.refresh()
    here = docs(spark, lambda i: i < 25 and (i % 4 or i % 8 == 0))
    terms, postings = retrieval.build_index(here, "doc_id")
    assert rows(index.postings()) == rows(postings)
    got = {r.term: (r.df, round(r.idf, 9)) for r in index.vocabulary().collect()}
    assert got == {r.term: (r.df, round(r.idf, 9)) for r in terms.collect()}
    before = rows(index.postings())
    index.compact()
    assert len(index.segments()) == 1
    index.refresh()
    assert rows(index.postings()) == before
    index.add(docs(spark, lambda i: i >= 25))
    index.refresh()
    _, both = retrieval.build_index(here.unionAll(docs(spark, lambda i: i >= 25)), "doc_id")
    assert rows(index.postings()) == rows(both)


def test_a_look_up_reads_only_the_buckets_of_its_terms(spark, index):
    index.add(docs(spark, lambda i: i < 20))
    index.add(docs(spark, lambda i: i >= 20))
    index.refresh()
    wanted = spark.createDataFrame([("alpha",), ("absent",)], "term string")
    found = index.postings(wanted)
    buckets = {r[0] for r in wanted.select(index._bucket(F.col("term"))).collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[[^\]]*bucket[^\]]*\]", plan)
    assert len(filters) >= 4 and all(str(b) in f for b in buckets for f in filters)
    assert {r.term for r in found.collect()} == {"alpha"} and found.count() == 30


def test_deleting_everything_leaves_an_empty_index(spark, index):
    index.add(docs(spark, lambda i: True))
    index.delete(docs(spark, lambda i: True))
    index.refresh()
    assert index.postings().count() == 0 and index.vocabulary().count() == 0
