"""Retrieval without an index: only what the questions ask for is laid out, and few documents are handed on."""

from pyspark.sql import functions as F

from sectorlens.operators import impact_index, retrieval


def corpus(spark, docs=400):
    rows = [(i, f"common word{i % 7} word{i % 31} rare{i} rare{i}" + " common" * (i % 3)) for i in range(docs)]
    asked = [(1, "common word3"), (2, "word5 word6 rare17"), (3, "unknown")]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame(asked, "query_id long, query string"))


def test_lengths_count_rare_terms_too(spark):
    docs, _ = corpus(spark, 60)
    frequencies = retrieval.term_frequencies(docs, "doc_id").persist()
    terms, postings = retrieval.build_index(docs, "doc_id")
    wanted = spark.createDataFrame([("common", 0), ("rare17", 1)], "term string, code long")
    # Five terms at most are sent to all tasks for their frequency; rare17 for being asked.
    got = retrieval.wanted_documents(frequencies, terms, wanted, "doc_id", 5).select(
        "doc_id", F.explode("listed").alias("p")).select("doc_id", "p.term", F.round("p.weight", 9).alias("w"))
    want = postings.join(wanted, "term").select("doc_id", F.col("code").alias("term"), F.round("weight", 9).alias("w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and retrieval.frequent_from(terms, 5) > 1


def test_documents_below_the_threshold_are_not_handed_on(spark):
    docs, asked = corpus(spark)
    terms, postings = retrieval.build_index(docs, "doc_id")
    index = impact_index.build(postings, "doc_id", 16)
    weighed = retrieval.weigh_questions(asked, terms, "query_id", small=True).persist()
    pairs = impact_index.bounds(weighed, index, "query_id")
    every = impact_index._block_best(pairs, weighed, index, "query_id", 16, 6)
    few = impact_index._block_best(pairs.withColumn("least", F.lit(0.4)), weighed, index, "query_id", 16, 6)
    assert few.count() == every.where("score >= 0.4").count() < every.count()


def test_padding_does_not_search_again(spark):
    docs, asked = corpus(spark, 60)
    top = retrieval.retrieve(asked, docs, "query_id", "doc_id", 20, pad_zero=True)
    assert "FlatMapCoGroupsInArrow" not in top._jdf.queryExecution().executedPlan().toString()
    assert top.groupBy("query_id").count().where("count <> 20").count() == 0
