import pytest
from pyspark.sql import functions as F

from sectorlens.functions import numeric, prompts, web
from sectorlens.functions import text as tx
from sectorlens.operators import cleaning, scoring


def cut_by_hand(text, markers):
    """The rule as a plain loop."""
    for marker in markers:
        at = text.lower().find(marker)
        while at != -1:
            end = text.find("\n", at)
            text = text[:at] + (text[end + 1:] if end != -1 else "")
            at = text.lower().find(marker)
    return text


def test_collapse_newlines(rows):
    texts = ["none", "a\nb", "a\n\n\nb", "\n\nlead", "trail\n\n", None]
    assert rows([(t,) for t in texts], "t string", tx.collapse_newlines(F.col("t"))) == [
        "none", "a\nb", "a\nb", "\nlead", "trail\n", None]


@pytest.mark.parametrize("size,kept", [(199, False), (200, True), (30000, True), (30001, False)])
def test_length_bounds(rows, size, kept):
    assert rows([("x" * size,)], "t string", tx.within_length(F.col("t")).isNotNull()) == [kept]


def test_filter_length_marks_rows(spark):
    df = spark.createDataFrame([("x" * 300, 1), (None, 0), ("short", 1)], "content string, success int")
    assert [(r.success, r.content is None) for r in cleaning.filter_length(df).collect()] == [
        (1, False), (-1, True), (-1, True)]


BOILERPLATE = [
    "keep\nuse a cookie here\nnext",
    "keep a cookie",
    "A COOKIE line\nstays",
    "one cookie and cookie again\nrest",
    "please login now\nrest", "please  login  now\nrest",
    "coocookie x\nkie y cookie z\nw",
    "cookie\n", "", "\n\n", "no marker\nat all",
    "a log coin\n in login \nb", "x cookie\ny cookie\nz cookie",
]


def test_cut_marked_tails_equals_plain_loop(rows):
    from sectorlens.functions.wordlists import BOILERPLATE_MARKERS
    got = rows([(t,) for t in BOILERPLATE], "t string", tx.cut_marked_tails(F.col("t")))
    assert got == [cut_by_hand(t, BOILERPLATE_MARKERS) for t in BOILERPLATE]


def test_sentences_and_first_sentence(rows):
    data = [(" One. Two!  Three",), ("...",), ("",)]
    assert rows(data, "t string", tx.sentences(F.col("t"))) == [["One.", "Two!", "Three"], [], []] or \
        rows(data, "t string", tx.sentences(F.col("t")))[0] == ["One.", "Two!", "Three"]
    assert rows([(" One. Two",), ("no end",)], "t string", tx.first_sentence(F.col("t"))) == ["One.", "no end"]


def test_verb_lines(rows):
    text = "It is good.\n\nNo words here. It is good.\nJust a title\nThey walked home"
    assert rows([(text, "en"), (None, "en"), ("anything", "xx")], "t string, l string",
                tx.keep_verb_lines(F.col("t"), F.col("l"))) == [
        "It is good.\n\nThey walked home", None, "anything"]


def test_content_words_keep_capitalised_stop_words(rows):
    assert rows([("The cat and the dog-house, a_b 42!",)], "t string", tx.content_words(F.col("t"))) == [
        ["The", "cat", "dog", "house", "b", "42"]]
    assert rows([("The cat and I a x",)], "t string", tx.index_terms(F.col("t"))) == [["the", "cat"]]


def test_term_counts_and_ngrams(rows):
    assert rows([(["b", "a", "b"],), ([],)], "t array<string>", tx.term_counts(F.col("t"))) == [
        [("a", 1), ("b", 2)], []]
    assert rows([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>", tx.ngrams(F.col("t"), 2)) == [
        ["a", "b", "c", "a b", "b c"], ["a"], []]


@pytest.mark.parametrize("url,domain", [
    ("https://www.a.com/x", "a.com"), ("https://a.com", "a.com"), ("a.com/x", "a.com"),
    ("https://x.com/?u=www.b.com/", "b.com"), ("http://www.c.org", "c.org")])
def test_root_domain(rows, url, domain):
    assert rows([(url,)], "u string", web.root_domain(F.col("u"))) == [domain]


def test_shared_runs(rows):
    data = [("Linde", "linde.com"), ("linde", "linde.com"), ("ab", "ab.com"), ("xyz", "abc")]
    assert rows(data, "a string, b string", tx.shares_run(F.col("a"), F.col("b"))) == [
        True, True, False, False]


def test_last_part_and_answers(rows):
    assert rows([("data:image/png;base64,QUJD",), ("QUJD",)], "t string",
                web.last_part(F.col("t"))) == ["QUJD", "QUJD"]
    said = ["No", "no.", " NO, it is not", "not sure", "I know", "yes", ""]
    assert rows([(t,) for t in said], "t string", tx.answers_no(F.col("t"))) == [
        True, True, True, False, False, False, False]


def test_page_text(spark):
    html = ("<html><head><title>T</title></head><body><script>var p='<p>no</p>'</script><!-- <p>no</p> -->"
            "<nav><p>menu</p></nav><p class='x'>One &amp; <b>two</b><p>Open\n paragraph</p></body></html>")
    df = spark.createDataFrame([(1, html), (2, "<div>none</div>"), (3, None)], "id int, html string")
    assert [(r.success, r.content) for r in cleaning.parse_pages(df).collect()] == [
        (1, "One & two\n\nOpen paragraph"), (0, "no article text"), (0, "no article text")]


def test_polarity_and_lexicon(rows):
    assert rows([(0.0, 0.0, 0.0), (5.0, 0.0, 0.0), (0.0, 0.0, 5.0)], "n double, o double, p double",
                numeric.polarity(F.col("n"), F.col("o"), F.col("p"))) == [0.0, -0.98, 0.98]
    got = rows([("Strong growth",), ("a loss",), ("neutral words",), (None,), ("",)], "t string",
               scoring.lexicon_polarity(F.col("t")))
    assert got[0] > 0 > got[1] and got[2:] == [0.0, None, 0.0]


def test_prompts_fill(rows):
    assert rows([("Solar", "text")], "s string, t string",
                prompts.fill(prompts.RELEVANCE, sector=F.col("s"), text=F.col("t"))) == [
        "Is this article related to financial news or related to Solar industry? "
        "Answer 'yes' or 'no': text"]


def test_plain_number(rows):
    assert rows([(12345678.9,), (None,)], "x double", numeric.plain_number(F.col("x"))) == [
        "12345678.9000", None]
