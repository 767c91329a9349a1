"""Retrieval by blocks: the same results as scoring everything, and blocks that are skipped."""

import random

import pytest
from pyspark.sql import functions as F

from sectorlens.operators import impact_index, retrieval
from sectorlens.registry import retrieval_queries


def corpus(spark, docs=600, topics=12):
    """Documents of topics with words of their own and a few that all share."""
    pick, rows = random.Random(3), []
    for i in range(docs):
        topic = pick.randrange(topics)
        words = [f"topic{topic}word{pick.randrange(30)}" for _ in range(20)] + [f"common{pick.randrange(8)}" for _ in range(6)]
        rows.append((i, " ".join(words)))
    asked = [(100 + t, f"topic{t}word1 topic{t}word2 topic{t}word3 common1") for t in range(topics)] + [(1, "unknown"), (2, "common1")]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
            spark.createDataFrame(asked, "query_id long, query string"))


@pytest.mark.parametrize("n", [1, 10, 250])
def test_equals_scoring_every_document(spark, monkeypatch, n):
    monkeypatch.setattr(impact_index, "QUESTIONS", 3)
    docs, asked = corpus(spark)
    index = retrieval.build_index(docs, "doc_id")
    scores = retrieval.score(asked, *index, "query_id", "doc_id")
    want = retrieval.top_documents(scores, "query_id", "doc_id", n)
    impacts = impact_index.build(index[1], "doc_id", 16)
    got = retrieval.retrieve(asked, docs, "query_id", "doc_id", n, index=index, impacts=impacts)
    assert sorted(map(tuple, got.select("query_id", "doc_id", "score", "rank").collect())) == sorted(
        map(tuple, want.select("query_id", "doc_id", "score", "rank").collect()))


def test_blocks_below_the_threshold_are_skipped(spark):
    docs, asked = corpus(spark)
    terms, postings = retrieval.build_index(docs, "doc_id")
    impacts = impact_index.build(postings, "doc_id", 16)
    weighed = retrieval.weigh_questions(asked.where("query_id >= 100"), terms, "query_id").persist()
    bounded = impact_index.promising(impact_index.bounds(weighed, impacts, "query_id"), "query_id", 3).persist()
    first = impact_index._ranked(impact_index._block_best(bounded.where("early"), weighed, impacts, "query_id", 10, 6),
                                 impacts, "query_id", 10, 6)
    left = impact_index.surviving(bounded, first, "query_id", 10, 6).count()
    later = bounded.where("NOT early").count()
    # Nearly every block holds the common word, but only those of a question's topic can win.
    assert later > 12 * 25 and left < 0.2 * later


def test_every_bound_holds(spark):
    docs, asked = corpus(spark, 200)
    terms, postings = retrieval.build_index(docs, "doc_id")
    impacts = impact_index.build(postings, "doc_id", 16)
    weighed = retrieval.weigh_questions(asked, terms, "query_id")
    best = retrieval.score(asked, terms, postings, "query_id", "doc_id", decimals=12).join(impacts.members, "doc_id") \
        .groupBy("query_id", "block").agg(F.max("score").alias("best"))
    both = best.join(impact_index.bounds(weighed, impacts, "query_id"), ["query_id", "block"], "full")
    assert both.where("best IS NULL OR bound IS NULL OR best > bound + 1e-9").count() == 0 and both.count() > 0


def test_no_row_per_question_and_document_is_shuffled(spark):
    plan = retrieval_queries.tfidf_topk(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[query_id" not in plan.split("FlatMapCoGroupsInArrow")[0]
    assert "FlatMapCoGroupsInArrow" in plan
