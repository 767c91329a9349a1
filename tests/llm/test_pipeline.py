"""Every stage of the pipeline beside a plain version on its own input."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sectorlens.llm import packing, toxicity
from sectorlens.llm.stages import stored

from test_brute_force import cut, plain_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage and after the last."""
    tables = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], FOLDER)))
    return tables


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay_until_packing(stages):
    assert all(t.schema.names == stages[0].schema.names for t in stages[:-1])
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_toxicity_drops_what_it_scores_high(spark, stages):
    model = toxicity.train(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    low = toxicity.scored(stages[0], model).where(F.col("score") < 0.7).select("doc_id").collect()
    assert set(texts(stages[1])) == {r.doc_id for r in low}


def test_one_document_of_each_group_stays(stages):
    groups = plain_components(texts(stages[1]), 5, 80)
    assert set(texts(stages[2])) == {label for _, label in groups.values()}


def test_repeats_are_cut_but_for_the_first(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(before) == set(after)
    seen = set()
    for key in sorted(before):
        words, covered = cut(before[key]), set()
        for at in range(len(words) - 49):
            window = tuple(words[at:at + 50])
            if window in seen:
                covered.update(range(at, at + 50))
            seen.add(window)
        assert cut(after[key]) == [w for i, w in enumerate(words) if i not in covered]


def test_secrets_are_masked_and_nothing_else_changes(stages):
    before, after = texts(stages[3]), texts(stages[4])
    secret = r'(?i)(token\s*=\s*")[0-9a-f]{40}(?=")'
    learned = any(re.search(secret, t) for t in before.values()) and before != after
    assert after == ({k: re.sub(secret, r"\1[SECRET]", t) for k, t in before.items()} if learned else before)


def test_packing_holds_every_document(stages):
    table = packing.table_of(packing.tokenizer_path(packing.MODEL))
    sizes = {}
    for r in stages[5].collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    for key, text in texts(stages[4]).items():
        assert sizes[key] == len(np.frombuffer(table.encode([text])[0], "<u4")) + 1
