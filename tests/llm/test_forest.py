"""The forest of the secret scan decides: it finds forms that no label shows and overrules labels."""

import random

from pyspark.sql import functions as F

from sectorlens.llm import queries, secrets

HEX, BASE64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
WORDS = ["international", "department", "correspondence", "responsible", "administration", "particular"]


def planted(spark, pick):
    """Keys of 40 hexadecimal digits (ids to 199), issuers' tokens (200 to 259), words (300 and up)."""
    def key(signs, size):
        return "".join(pick.choice(signs) for _ in range(size))

    rows = [(i, f'the token = "{key(HEX, 40)}" of us') for i in range(200)]
    rows += [(200 + i, f'the token = "{form}{key(BASE64, 36)}" of us')
             for i, form in enumerate(["ghp_", "npm_", "hf_"] * 20)]
    rows += [(300 + i, f"see {'/'.join(pick.sample(WORDS, 3))} and {' '.join(pick.sample(WORDS, 2))}")
             for i in range(300)]
    return spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, source string")


def test_a_form_that_is_never_labelled_is_found(spark):
    docs = planted(spark, random.Random(8))
    label = F.when(~F.col("doc_id").between(200, 299), queries.finding_label())
    rows = secrets.scanned(docs, label).collect()
    found = {r.doc_id for r in rows if r.score >= 0.5}
    assert found == set(range(260))


def test_the_forest_overrules_a_wrong_label(spark):
    docs = planted(spark, random.Random(9)).where("doc_id < 200 OR doc_id >= 300")
    # One key is labelled as none and one path as a secret.
    label = F.when(F.col("doc_id") == 7, 0).when(F.col("doc_id") == 310, 1).otherwise(
        (F.col("doc_id") < 200).cast("int"))
    score = {r.doc_id: r.score for r in secrets.scanned(docs, label).collect()}
    assert score[7] >= 0.5 > score[310]
