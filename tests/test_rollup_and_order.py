import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.functions import text as tx
from sectorlens.operators import joins, lookup, ordering, retrieval, rollup, scoring, windows
from sectorlens.sources import writers


def windows_by_hand(tokens):
    out, start = [], 0
    while True:
        end = min(start + 512, len(tokens))
        if out and end - start < 128:
            return out
        out.append(tokens[start:end])
        start = end - 50
        if len(out) > 1000:
            raise AssertionError


@pytest.mark.parametrize("size", [0, 1, 127, 512, 589, 590, 1024, 2000])
def test_token_windows_equal_plain_loop(spark, size):
    tokens = [f"t{i}" for i in range(size)]
    df = spark.createDataFrame([(1, " ".join(tokens)), (2, None)], "doc_id long, content string")
    got = [r.tokens for r in windows.token_windows(df, ["doc_id"]).orderBy("seg_no").collect()]
    assert got == windows_by_hand(tokens)


def test_window_summaries_by_column_and_batch_scorer_agree(spark):
    df = spark.createDataFrame([(1, "Ab cd. ef " * 400), (2, "short"), (3, None)], "doc_id long, content string")
    inside = {r.doc_id: r.summary for r in rollup.summarize_articles(df, scorer=tx.first_sentence).collect()}
    cut = rollup.article_windows(df, ["doc_id"])
    scored = scoring.score_in_batches(
        cut, "segment", "summary_seg", T.StringType(),
        lambda: lambda texts: [t.split(".")[0] + ("." if "." in t else "") for t in texts])
    joined = {r.doc_id: r.summary for r in rollup.join_window_summaries(scored, ["doc_id"]).collect()}
    assert inside == {**joined, 3: ""}


def test_batch_scorer_retries_and_keeps_failed_rows(spark):
    def make():
        calls = {"n": 0}

        def scorer(texts):
            calls["n"] += 1
            if calls["n"] == 1:
                raise RuntimeError("first call fails")
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return [len(t) for t in texts]
        return scorer

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, None), (4, "x")], "id int, t string").coalesce(1)
    got = scoring.score_in_batches(df, "t", "n", T.LongType(), make)
    assert [(r.id, r.n, r.error) for r in got.orderBy("id").collect()] == [
        (1, 3, None), (2, None, "ValueError: bad text"), (3, None, None), (4, 1, None)]
    assert [r.id for r in scoring.failures(got, ["id"]).collect()] == [2]


def test_ordered_text_pages_and_order(spark):
    rng = random.Random(1)
    data = [("a", i, f"t{i}" if i % 3 else None) for i in range(25)] + [("b", 1, None), (None, 1, "x")]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, o long, t string")
    pages = ordering.ordered_text(df, ["k"], "o", "t", "###", "txt", 10).orderBy("k", "page_no").collect()
    whole = "###".join(p.txt for p in pages if p.k == "a")
    assert whole == "###".join(f"t{i}" for i in range(25) if i % 3)
    assert [p.txt for p in pages if p.k == "b"] == [""]


def test_first_rows_and_values(spark):
    data = [("a", 2, 7, None), ("a", 1, None, None), ("a", 3, 8, None), ("b", 5, None, None), (None, 1, 1, 1)]
    df = spark.createDataFrame(data, "k string, o long, x int, y int")
    assert [(r.k, r.o) for r in ordering.first_rows(df, ["k"], "o").orderBy("k").collect()] == [("a", 1), ("b", 5)]
    assert [tuple(r) for r in ordering.first_values(df, ["k"], ["x", "y"], "o").orderBy("k").collect()] == [
        ("a", 7, None), ("b", None, None)]


def test_ordinals_follow_any_key(spark):
    names = [f"n{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in random.Random(2).sample(names, 200)], "name string")
    got = [r.name for r in ordering.with_ordinal(df, ["name"]).orderBy("seq").collect()]
    assert got == names


@pytest.mark.parametrize("small", [True, False])
def test_lookup_join_with_hot_key(spark, monkeypatch, small):
    monkeypatch.setattr(joins, "HOT_SHARE", 4)
    if not small:
        monkeypatch.setattr(joins, "is_small", lambda side: False)
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(300, None)],
                                  "id long, k string")
    side = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    got = {r.id: r.v for r in joins.lookup_join(facts, side, ["k"]).collect()}
    want = {i: (1 if i % 3 else {0: 2, 3: 3}.get(i)) for i in range(300)}
    assert got == {**want, 300: None}
    inner = joins.lookup_join(facts, side, ["k"], "inner").count()
    assert inner == 202


def test_group_values_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", 5.0)], "k string, x double")
    got = joins.with_group_values(df, ["k"], m=F.avg("x")).orderBy("k").collect()
    assert [r.m for r in got] == [1.5, 1.5, 1.5, 5.0]


def test_add_sector_last_wins(spark):
    mapping = spark.createDataFrame([(0, "Coal", "A"), (1, "Gas", "A"), (0, "Coal", "B"), (0, "Coal", "B")],
                                    "sector_ord int, sector_name string, company_name string")
    arts = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "doc_id long, company_name string")
    assert [r.sector_name for r in lookup.add_sector(arts, mapping).orderBy("doc_id").collect()] == [
        "Gas", "Coal", ""]


def test_search_terms_and_urls(spark):
    mapping = spark.createDataFrame([("S", "A"), ("T", "B")], "sector_name string, company_name string")
    words = spark.createDataFrame([("S", ["x", "y"])], "sector_name string, keywords array<string>")
    got = sorted((r.company_name, r.keyword, r.year, r.query, str(r.date_to))
                 for r in lookup.search_terms(mapping, words, [2020]).collect())
    assert got == [("A", "x", 2020, "A x", "2020-12-31"), ("A", "y", 2020, "A y", "2020-12-31"),
                   ("B", "", 2020, "B ", "2020-12-31")]
    records = spark.createDataFrame([(None, "k", list("abcdefghijkl")), ("A", "k", [])],
                                    "company_name string, sector_keyword string, urls array<string>")
    out = lookup.explode_urls(records).collect()
    assert len(out) == 10 and {r.company_name for r in out} == {"Unknown"} and out[0]["count"] == 10


def test_keyword_lists_stay_aligned(spark):
    data = [("a", i, f"k{i}", f"{i}.5", None if i == 2 else "0.1") for i in range(5)]
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, o long, keywords string, keywords_score string, "
                                         "keywords_sentiment string")
        r = rollup.keyword_lists(df, ["k"], "o").collect()[0]
        assert r.keywords == "k0; k1; k2; k3; k4" and r.keywords_score == "0.5; 1.5; 2.5; 3.5; 4.5"
        assert r.keywords_sentiment == "0.1; 0.1; ; 0.1; 0.1"


def test_trend_prompts_take_first_row_per_year(spark):
    df = spark.createDataFrame([("S", 2009, 1, "b"), ("S", 2008, 2, "a"), ("S", 2009, 3, "later")],
                               "sector_name string, year int, o long, sector_summary string")
    prompt = rollup.trend_prompts(df, "o").collect()[0].prompt
    assert prompt.endswith("balanced view.\n\nSummary in 2008: a\nSummary in 2009: b")


def test_corpus_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, 2008, "S", "c", None, "t"), (2, 2008, "S", "c", "s", "t2")],
                               "seq long, year int, sector_name string, company_summary string, "
                               "sector_summary string, sector_trend string")
    got = [r.text for r in retrieval.build_corpus(df).orderBy("doc_ord").collect()]
    assert got == ["c", "c", "s", "t"]


@pytest.mark.parametrize("factor", [1, 5000])
def test_pages_do_not_depend_on_how_dense_the_order_is(spark, factor):
    data = [("a", i * factor, f"t{i}") for i in range(6)] + [("b", 7 * factor, "u")]
    df = spark.createDataFrame(data, "company_name string, doc_id long, summary string")
    whole = {r.company_name: r.summary for r in rollup.company_texts(df, keys=["company_name"]).collect()}
    assert whole == {"a": "t0###t1###t2###t3###t4###t5", "b": "u"}
    pages = sorted((r.company_name, r.page_no, r.summary) for r in
                   rollup.company_texts(df, keys=["company_name"], chunk_rows=2).collect())
    assert pages == [("a", 0, "t0###t1"), ("a", 1, "t2###t3"), ("a", 2, "t4###t5"), ("b", 0, "u")]


def test_a_group_of_any_size_ends_in_one_row(spark):
    segments = spark.range(1, 82).selectExpr("'g' AS k", "id AS seg_no", "false AS is_final", "'s' AS summary")
    got = rollup.merge_summaries(segments, ["k"], lambda t: F.concat(F.lit("<"), t, F.lit(">")), fan_in=2).collect()
    assert len(got) == 1 and got[0].summary.count("s") == 81


def test_side_output_computes_its_frame_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def run(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.range(10).mapInPandas(run, "id long")
    writers.write_with_side_output(df, F.col("id") > 7, f"{tmp_path}/all", f"{tmp_path}/side", ["id"])
    assert seen.value == 10 and spark.read.parquet(f"{tmp_path}/side").count() == 2
