"""One id on several texts, null ids and clashing names."""

import duckdb
import pytest

import corpus_pipeline
from sectorlens.llm import jaccard, queries, secrets, suffixes

WORDS = [f"w{i}" for i in range(300)]


def near(base, step):
    return " ".join("other" if i == step else w for i, w in enumerate(base))


ROWS = [(4, near(WORDS[:140], 50)), (4, near(WORDS[150:290], 10)), (6, near(WORDS[150:290], 90)), (9, near(WORDS[:140], 7)),
        (9, ""), (11, "alone in the world"), (11, None), (12, near(WORDS[150:290], 90))]


def test_components_of_ids_on_several_texts_equal_sql(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(docs).collect())
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    want = db.sql(queries.ORACLES["op2_ngram_jaccard_join"]).fetchall()
    assert got == sorted(want) and {c for i, _, c in got if i in (4, 6, 9, 12)} == {4}


def test_repeats_of_an_id_on_several_texts(spark):
    passage = " ".join(WORDS[:80])
    rows = [(1, f"a {passage} b"), (2, f"x {passage} y"), (2, "short"), (None, passage), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'i' AS _id", "'s' AS _spans")
    found = suffixes.matches(docs)
    # Of the texts of an id the one that sorts first counts.
    assert found.collect() == []
    turned = spark.createDataFrame([(1, f"a {passage} b"), (2, f"x {passage} y"), (2, "zzz " + " ".join(WORDS[100:170]))],
                                   "doc_id long, text string").selectExpr("*", "'i' AS _id", "'s' AS _spans")
    after = suffixes.cut(turned, suffixes.matches(turned))
    assert after.columns == turned.columns
    assert sorted(r.text for r in after.collect() if r.doc_id == 2) == ["x y", "zzz " + " ".join(WORDS[100:170])]


def test_stages_keep_documents_without_an_id_apart(spark):
    passage = " ".join(WORDS[:60])
    rows = [(None, ""), (None, None), (None, f"n {passage}"), (7, f"{passage} q"), (None, "p q r"), (None, "p q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'i' AS _id", "'k' AS _key")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted(
        [(0, ""), (0, ""), (7, f"{passage} q"), (0, "p q r")])
    cut = corpus_pipeline.cut_repeats(spark, docs, "")
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert sorted(r.text or "" for r in cut.collect()) == ["", "", "n", "p q r", "p q r", f"{passage} q"]


def test_secrets_of_documents_without_an_id_are_masked(spark):
    key = "0123456789abcdef0123456789abcdef01234567"
    rows = [(None, f'token = "{key}" here'), (5, f'token = "{key[::-1]}" here'), (None, f"id {key[::-1]} plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'src' AS source", "1 AS _id", "2 AS _secrets", "3 AS _p", "4 AS _c")
    masked = corpus_pipeline.mask_secrets(spark, docs, "")
    assert masked.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in masked.collect())[-1] == (5, 'token = "[SECRET]" here')
    assert key not in " ".join(r.text for r in masked.collect())
