"""The cascade works out what it needs, where it needs it, and in a steady order."""

import pytest
from sectorlens.llm import quality

TEXTS = ["plain words of a quiet text", "## ** %% $$ && || <> #", "SHOUTING ALL THE TIME", "a b c d e f",
         "same\nsame\nsame\nother line", "", None, "x" * 40, "two  words\n\n \t\nagain"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, _lines string")


def verdicts(frame):
    return {r.doc_id: r.rejected_by for r in frame.select("doc_id", "rejected_by").collect()}


def test_measures_read_or_worked_out_give_the_same(docs):
    rules = list(quality.DEFAULT_RULES)
    raw = verdicts(quality.cascade(docs, rules))
    assert raw == verdicts(quality.cascade(quality.measured(docs), rules))
    assert raw == {0: None, 1: "symbols", 2: "shouting", 3: "word_length", 4: "duplicate_lines", 5: None, 6: None,
                   7: "word_length", 8: None}


def test_a_rejected_row_is_not_shown_to_later_rules(docs):
    trap = quality.Rule("trap", "raise_error('asked') IS NULL")
    every = quality.Rule("all", "true")
    assert set(verdicts(quality.cascade(docs, [every, trap])).values()) == {"all"}
    with pytest.raises(Exception, match="asked"):
        quality.cascade(docs, [trap, every]).collect()


def test_the_dear_rule_is_asked_last(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 300) for i in range(400)], "doc_id long, text string")
    dear = quality.Rule("dear", "size(filter(transform(sequence(1, 3000), i -> sha2(concat(text, i), 256)), "
                                "x -> x < '0')) >= 0")
    cheap = quality.Rule("cheap", "doc_id >= 0")
    for _ in range(2):
        assert [r.name for r in quality.ordered(docs, (dear, cheap), sample_rows=20)] == ["cheap", "dear"]


def test_columns_of_other_names_stay(docs):
    frame = quality.measured(docs)
    assert {r["_lines"] for r in frame.collect()} == {"kept"}
    assert frame.columns == ["doc_id", "text", "_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
