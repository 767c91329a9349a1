"""Queries of the retrieval index and on vectors, and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cells, retrieval, vectors
from ..session import ensure_checkpoint_dir
from ..sources.readers import spread
from ..sources.term_index import TermIndex
from . import sql
from .roles import table


# More than the documents that share a term with most questions, so that some are padded.
PADDED = 900


def corpus(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def questions(spark, folder):
    """benchmark as questions; those without the word "and" are asked online."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"),
        F.when(F.contains("text", F.lit(" and ")), "Local").otherwise("Online").alias("source"))


def tfidf_terms(spark, folder):
    terms = retrieval.fit_terms(corpus(spark, folder), "doc_id")
    return terms.withColumn("idf", F.round("idf", 6))


def tfidf_weights(spark, folder):
    _, postings = retrieval.build_index(corpus(spark, folder), "doc_id")
    return postings.withColumn("weight", F.round("weight", 6))


def tfidf_topk(spark, folder):
    return retrieval.retrieve(questions(spark, folder), corpus(spark, folder), "query_id", "doc_id")


def tfidf_topk_padded(spark, folder):
    return retrieval.retrieve(questions(spark, folder), corpus(spark, folder), "query_id", "doc_id",
                              PADDED, pad_zero=True)


def rag_prompts(spark, folder):
    asked, docs = questions(spark, folder), corpus(spark, folder)
    top = retrieval.retrieve(asked, docs, "query_id", "doc_id")
    return retrieval.answer_prompts(asked, top, docs, "query_id", "doc_id").select(
        "query_id", "source", F.length("prompt").cast("bigint").alias("n_chars"),
        F.md5("prompt").alias("prompt_md5"))


def index_in_parts(spark, folder):
    """Postings of the questions' terms from an index that was added to, deleted from and compacted."""
    ensure_checkpoint_dir(spark)
    docs = corpus(spark, folder)
    index = TermIndex.create(spark, f"{spark.sparkContext.getCheckpointDir()}/index-{uuid.uuid4().hex}")
    index.add(docs.where("doc_id % 2 = 0"))
    index.add(docs.where("doc_id % 2 = 1"))
    again = docs.where("doc_id % 10 = 3")
    index.delete(again)
    index.compact()
    index.add(again)
    index.refresh()
    terms = retrieval.term_frequencies(questions(spark, folder), "query_id", "query").select("term")
    return index.postings(terms).withColumn("weight", F.round("weight", 6))


def _centres(spark, folder):
    """Mean vector per label, the question vectors."""
    parts = table(spark, folder, "embeddings").select(
        F.col("label").cast("bigint").alias("query_id"), F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("query_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One entry per dimension and label.
    return means.groupBy("query_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("embedding"))


def vector_topk(spark, folder):
    pool = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(pool, _centres(spark, folder))


def vector_topk_cells(spark, folder):
    """Every 20th vector against all of them."""
    pool = table(spark, folder, "embeddings").select("vec_id", "embedding")
    asked = pool.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return cells.nearest(pool, asked).rows


def adjacent_similarity(spark, folder):
    found = vectors.neighbour_similarity(table(spark, folder, "embeddings"), ["label"], "vec_id")
    return found.where(F.col("next_id").isNotNull()).withColumn("similarity", F.round("similarity", 6))


ORACLES = {
    "tfidf_terms": f"WITH {sql.tfidf()} SELECT term, df, round(idf, 6) AS idf FROM terms",
    "tfidf_weights": f"""WITH {sql.tfidf()}
        SELECT id AS doc_id, term, tf, round(weight, 6) AS weight FROM postings""",
    "index_in_parts": f"""WITH {sql.tfidf()}, {sql.tfidf_scores()}
        SELECT id AS doc_id, term, tf, round(weight, 6) AS weight FROM postings
        WHERE term IN (SELECT term FROM qtf)""",
    "tfidf_topk": f"""WITH {sql.tfidf()}, {sql.tfidf_scores()}
        SELECT query_id, id AS doc_id, score, rank FROM top""",
    "tfidf_topk_padded": f"""WITH {sql.tfidf()}, {sql.tfidf_scores()},
        every AS (SELECT item_id AS query_id, b.doc_id, coalesce(score, 0) AS score,
            (score IS NOT NULL) AS found FROM (SELECT item_id, doc_id FROM benchmark, documents) b
            LEFT JOIN scores s ON b.item_id = s.query_id AND b.doc_id = s.id)
        SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id
          ORDER BY found DESC, score DESC, doc_id DESC) AS rank FROM every QUALIFY rank <= {PADDED}""",
    "rag_prompts": f"""WITH {sql.tfidf()}, {sql.tfidf_scores()},
        e AS (SELECT query_id, string_agg('Article ' || CAST(rank AS VARCHAR) || {sql.NEWLINE} || text
            || {sql.NEWLINE}, '' ORDER BY rank) AS t FROM top JOIN documents ON id = doc_id GROUP BY query_id),
        p AS (SELECT item_id AS query_id, CASE WHEN contains(text, ' and ') THEN 'Local' ELSE 'Online' END AS source,
          CASE WHEN contains(text, ' and ') THEN 'Based on the document descriptions provided, please answer the '
            || 'following question related to the content: ' || E'\\n\\n''' || text || E'''\\n\\n'
            || 'Relevant document excerpts:' || {sql.NEWLINE} || coalesce(t, '') ELSE text END AS prompt
          FROM benchmark LEFT JOIN e ON item_id = query_id)
        SELECT query_id, source, length(prompt) AS n_chars, md5(prompt) AS prompt_md5 FROM p""",
    "vector_topk": """WITH x AS (SELECT label, unnest(embedding) AS v,
            generate_subscripts(embedding, 1) AS pos FROM embeddings),
        m AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS v FROM x GROUP BY label, pos),
        c AS (SELECT CAST(label AS BIGINT) AS query_id, list(v ORDER BY pos) AS e FROM m GROUP BY label)
        SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), e), 6) AS score,
          row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(
            CAST(embedding AS DOUBLE[]), e), 6) DESC, vec_id) AS rank
        FROM embeddings, c QUALIFY rank <= 10""",
    "vector_topk_cells": """WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 20 = 0)
        SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 6) AS score,
          row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(
            CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 6) DESC, vec_id) AS rank
        FROM embeddings, q QUALIFY rank <= 10""",
    "adjacent_similarity": """SELECT label, vec_id, next_id, round(list_cosine_similarity(
          CAST(embedding AS DOUBLE[]), CAST(n AS DOUBLE[])), 6) AS similarity
        FROM (SELECT label, vec_id, embedding, lead(vec_id) OVER w AS next_id, lead(embedding) OVER w AS n
          FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)) WHERE next_id IS NOT NULL""",
}

QUERIES = {f.__name__: f for f in (
    tfidf_terms, tfidf_weights, index_in_parts, tfidf_topk, tfidf_topk_padded, rag_prompts, vector_topk,
    vector_topk_cells,    adjacent_similarity)}
