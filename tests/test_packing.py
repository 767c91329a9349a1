import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.operators import packing, rollup


def packed(df, keys=("g",)):
    found = {}
    for r in df.orderBy(*keys, "seg_no").collect():
        found.setdefault(r.g, []).append(r.segment)
    return found


CASES = {
    "exact": ["a" * 10, "b" * 4], "over": ["a" * 10, "b" * 5], "oversized first": ["x" * 40, "y"],
    "oversized twice": ["x" * 40, "z" * 40, "y"], "empty": [""], "leading empty": ["", "", "abc"],
    "inner empty": ["a", "", "b", ""], "marker inside": ["a###b", "c" * 12, "###", "d"],
    "empty then big": ["", "x" * 40], "nearly full then empty": ["a" * 15, "", "q" * 30, "b"],
}


# Segments of at most 17 characters, worked out by hand.
EXPECTED = {
    "exact": ["aaaaaaaaaa###bbbb"], "over": ["aaaaaaaaaa", "bbbbb"], "oversized first": ["", "x" * 40, "y"],
    "oversized twice": ["", "x" * 40, "z" * 40, "y"], "leading empty": ["abc"],
    "marker inside": ["a###b", "c" * 12, "###d"],
}


def check_chars(texts, segments, limit):
    """Nothing is lost, nothing is too long, and no segment could have taken the next part."""
    parts = [p for t in texts for p in t.split("###")]
    assert [p for s in segments for p in s.split("###") if p] == [p for p in parts if p]
    for at, segment in enumerate(segments):
        assert len(segment) <= limit or segment in parts
        if at + 1 < len(segments) and segment:
            following = segments[at + 1].split("###")[0]
            assert not following or len(segment) + len(following) + 3 > limit
    big = len(parts[0]) + 3 > limit
    assert bool(segments and segments[0] == "") == (big and bool(segments))


@pytest.mark.parametrize("chunk", [2, 1000])
def test_pack_by_chars_keeps_parts_limits_and_greed(spark, monkeypatch, chunk):
    monkeypatch.setattr(packing, "BLOCK_CHUNKS", 4)
    rng = random.Random(3)
    groups = {**CASES, "long": ["".join(rng.choice("ab") for _ in range(rng.choice([1, 5, 9, 14, 18, 30])))
                                for _ in range(60)]}
    data = [(g, i, t) for g, texts in groups.items() for i, t in enumerate(texts)] + [("exact", 99, None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, o long, t string")
    got = packed(packing.pack_by_chars(df, ["g"], "o", "t", 17, chunk))
    assert {g: got[g] for g in ("exact", "over", "oversized first", "oversized twice", "leading empty")} == {
        g: s for g, s in EXPECTED.items() if g != "marker inside"}
    assert "empty" not in got
    for name in ("exact", "over", "oversized first", "oversized twice", "long"):
        check_chars(groups[name], got[name], 17)


@pytest.mark.parametrize("chunk", [2, 1000])
def test_pack_by_words_keeps_words_and_cuts_at_markers(spark, chunk):
    rng = random.Random(5)
    groups = {
        "short": ["one two", "three"], "no marker": ["w " * 30], "before": ["w " * 9, "x " * 3, "y"],
        "after": ["w " * 11, "x", "y " * 12, "z"], "inside": ["a ### b", "### c", "d ###"],
        "long": [" ".join("w" for _ in range(rng.choice([1, 3, 7, 12]))) for _ in range(60)],
    }
    data = [(g, i, t) for g, texts in groups.items() for i, t in enumerate(texts)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, o long, t string")
    got = packed(packing.pack_by_words(df, ["g"], "o", "t", 10, chunk))
    assert got["short"] == ["one two ### three"] and got["before"] == [" ".join(["w"] * 9 + ["###"] + ["x"] * 3), "### y"]
    for name, texts in groups.items():
        assert " ".join(got[name]).split() == " ### ".join(texts).split()
        for at, segment in enumerate(got[name]):
            words = segment.split()
            assert at == 0 or words[0] == "###"
            # A marker from the tenth word on would have begun the next segment.
            assert "###" not in words[10:]
            assert at + 1 == len(got[name]) or len(words) >= 10


def test_packing_refuses_an_order_that_is_not_unique(spark):
    df = spark.createDataFrame([("g", 1, "a"), ("g", 1, "b")], "g string, o long, t string")
    with pytest.raises(ValueError):
        packing.pack_by_chars(df, ["g"], "o", "t")


@pytest.mark.parametrize("rule", [packing.by_chars(50), packing.by_words(20)])
def test_outcome_runs_equal_every_single_start(rule):
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40):
        sizes = rng.integers(0, 30, n)
        runs = packing.outcome_runs(rule, sizes)
        for start in range(rule.top + 1):
            level, opened = np.array([start]), 0
            for size in sizes:
                level, opens = rule.step(level, int(size))
                opened += int(opens[0])
            assert packing.after_chunk(start, runs) == (int(level[0]), opened)
        cuts = [packing.outcome_runs(rule, sizes[i:i + 3]) for i in range(0, n, 3)]
        assert packing.chained_runs(rule, cuts).equals(runs)


def test_company_summaries_short_long_and_empty(spark):
    data = [("short", 1, "One. Two."), ("short", 2, "Three."), ("none", 1, None), ("none", 2, ""),
            ("long", 1, "First" + "x" * 2000 + ". tail"), ("long", 2, "Second" + "y" * 2000 + ". tail"),
            ("edge", 1, "z" * 2999)]
    df = spark.createDataFrame(data, "company_name string, doc_id long, summary string")
    got = {r.company_name: r.summary_result for r in
           rollup.summarize_companies(df, keys=["company_name"]).collect()}
    assert got == {"short": "One.", "none": "", "long": "First" + "x" * 2000 + ".", "edge": "z" * 2999}


def test_the_last_article_can_decide_the_summary(spark):
    """The default summary weighs the whole text, also of a group of many segments."""
    data = [("g", i, f"Plain words number {i} " + "x" * 700 + ".") for i in range(20)]
    schema = "company_name string, doc_id long, summary string"
    rich = "Markets rallied while utilities announced several ambitious wind projects today."

    def summary(rows):
        return rollup.summarize_companies(spark.createDataFrame(rows, schema), keys=["company_name"]).first().summary_result

    assert summary(data + [("g", 20, rich)]).endswith(rich)
    assert not summary(data + [("g", 20, "Nothing.")]).endswith(rich)


def test_merge_goes_through_levels(spark):
    data = [("g", i, False, f"s{i}") for i in range(1, 28)] + [("h", 1, True, "done")]
    df = spark.createDataFrame(data, "g string, seg_no long, is_final boolean, summary string")
    got = {r.g: r.summary for r in rollup.merge_summaries(
        df, ["g"], lambda t: F.concat(F.lit("<"), t, F.lit(">")), fan_in=3).collect()}
    assert got["h"] == "done"
    assert got["g"].count("<") == 13 and got["g"].startswith("<<<s1 s2 s3> <s4")
