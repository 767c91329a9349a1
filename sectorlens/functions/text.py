"""Text expressions.  Every function maps columns to a column and stays JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import wordlists
from .binding import let

BLANKS = " \n\r\t"


def strip_blanks(text: Column) -> Column:
    """Trim spaces, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(BLANKS))


def collapse_newlines(text: Column) -> Column:
    """Replace runs of newlines by one newline."""
    return F.regexp_replace(text, "\n+", "\n")


def within_length(text: Column, low: int = 200, high: int = 30000) -> Column:
    """Keep the text when its length lies in [low, high], else null."""
    return F.when(F.length(text).between(low, high), text)


def sentences(text: Column) -> Column:
    """Split into trimmed, non-empty sentences ending at ``.``, ``!`` or ``?``."""
    found = F.regexp_extract_all(text, F.lit("[^.!?]+[.!?]*"), F.lit(0))
    return F.filter(F.transform(found, strip_blanks), lambda s: s != "")


def first_sentence(text: Column) -> Column:
    """The leading sentence of a text."""
    return strip_blanks(F.regexp_extract(text, "^[^.!?]*[.!?]*", 0))


def richest_sentence(text: Column) -> Column:
    """The sentence with the most distinct index terms: the default deterministic summary.

    All sentences of the text compete; of equally rich ones the earliest wins.  A text without
    sentences gives the empty text.
    """
    def rated(found: Column) -> Column:
        return F.transform(found, lambda s, i: F.struct(
            F.size(F.array_distinct(index_terms(s))).alias("terms"), (-i).alias("place"), s.alias("sentence")))

    best = let(sentences(text), lambda found: F.coalesce(
        F.array_max(rated(found))["sentence"], F.lit("")))
    return F.when(text.isNotNull(), best)


def words(text: Column) -> Column:
    """Maximal runs of letters and digits."""
    return F.filter(F.split(text, "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def blank_tokens(text: Column) -> Column:
    """Tokens between white space, punctuation kept."""
    return F.filter(F.split(text, "[ \t\r\n\f]+"), lambda w: w != "")


def content_words(text: Column, stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> Column:
    """Words that are no stop words; the comparison is case-sensitive."""
    return F.filter(words(text), lambda w: ~w.isin(*stop_words))


def index_terms(text: Column, stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> Column:
    """Terms of the retrieval index: content words, lower case, two characters or more."""
    return F.filter(F.transform(content_words(text, stop_words), F.lower),
                    lambda w: F.length(w) >= 2)


def verb_pattern(words_: Sequence[str], suffixes: Sequence[str]) -> str:
    """Pattern that finds a whole word from the lexicon or ending in a verb suffix."""
    whole = "|".join(words_)
    ends = "|".join(suffixes)
    return f"(?iu)(^|[^\\p{{L}}])(({whole})|[\\p{{L}}]+({ends}))($|[^\\p{{L}}])"


def keep_verb_lines(text: Column, language: Column,
                    lexicons: Mapping[str, Sequence[str]] = wordlists.VERB_WORDS,
                    suffixes: Mapping[str, Sequence[str]] = wordlists.VERB_SUFFIXES) -> Column:
    """Keep the lines in which every sentence bears a verb; empty lines stay.

    Texts in a language without a lexicon pass unchanged.
    """
    def kept_lines(pattern: str) -> Column:
        return F.array_join(F.filter(F.split(text, "\n"), lambda line: F.forall(
            sentences(line), lambda s: s.rlike(pattern))), "\n")

    result = text
    for code in sorted(lexicons):
        pattern = verb_pattern(lexicons[code], suffixes.get(code, ()))
        result = F.when(language == code, kept_lines(pattern)).otherwise(result)
    return result


def cut_marked_tail(text: Column, marker: str) -> Column:
    """Cut from the marker to the end of its line, newline included, until none is left.

    The text before the marker stays and is continued by the next line, where a
    new occurrence may arise across the joint.  One left-to-right fold over the
    lines handles that exactly: an open line is one whose newline was cut.  Rows
    without the marker skip the fold.
    """
    needle = marker.lower()

    def joined_line(state: Column, current: Column, at: Column) -> Column:
        hit = at > 0
        return F.struct(
            F.when(hit, state["done"])
             .otherwise(F.concat(state["done"], F.array(current))).alias("done"),
            F.when(hit, F.substr(current, F.lit(1), at - 1)).otherwise(F.lit("")).alias("open"),
            hit.alias("is_open"),
        )

    def step(state: Column, line: Column) -> Column:
        return let(F.concat(state["open"], line), lambda current: let(
            F.instr(F.lower(current), needle), lambda at: joined_line(state, current, at)))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"),
                     F.lit(False).alias("is_open"))

    def finish(state: Column) -> Column:
        lines = F.when(state["is_open"], F.concat(state["done"], F.array(state["open"]))) \
                 .otherwise(state["done"])
        return F.array_join(lines, "\n")

    # Bound once: markers are applied one after the other, each to the last one's result.
    return let(text, lambda t: F.when(
        F.contains(F.lower(t), F.lit(needle)),
        F.aggregate(F.split(t, "\n"), start, step, finish)).otherwise(t))


def cut_marked_tails(text: Column,
                     markers: Sequence[str] = wordlists.BOILERPLATE_MARKERS) -> Column:
    """Apply :func:`cut_marked_tail` for each marker in order."""
    for marker in markers:
        text = cut_marked_tail(text, marker)
    return text


def answers_no(answer: Column) -> Column:
    """True when the first word of an answer, ignoring case, is ``no``."""
    return F.lower(F.regexp_extract(answer, "[\\p{L}\\p{N}]+", 0)) == "no"


def ngrams(terms: Column, longest: int) -> Column:
    """All runs of 1 … ``longest`` neighbouring terms joined by a blank, unigrams first."""
    def runs(t: Column, n: int) -> Column:
        starts = F.filter(F.transform(t, lambda x, i: i), lambda i: i <= F.size(t) - n)
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i + 1, F.lit(n)), " "))

    return let(terms, lambda t: F.concat(t, *[runs(t, n) for n in range(2, longest + 1)]))


def term_counts(terms: Column) -> Column:
    """Distinct terms with their counts, in term order, as array<struct<term,tf>>.

    Sorting inside the row and measuring the runs needs no shuffle, in contrast
    to exploding and grouping.
    """
    def counted(ordered: Column, starts: Column) -> Column:
        return F.transform(starts, lambda p, j: F.struct(
            F.get(ordered, p).alias("term"),
            (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - p).cast("bigint").alias("tf")))

    def run_starts(ordered: Column) -> Column:
        firsts = F.transform(ordered, lambda t, i: F.when(
            (i == 0) | (t != F.get(ordered, i - 1)), i))
        return F.filter(firsts, lambda i: i.isNotNull())

    return let(F.sort_array(terms),
               lambda ordered: let(run_starts(ordered), lambda starts: counted(ordered, starts)))


def char_grams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams of a text; a shorter text is its own only gram."""
    count = F.length(text) - (n - 1)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                        lambda i: F.substr(text, i, F.lit(n)))
    return F.array_distinct(grams)


def shares_run(left: Column, right: Column, n: int = 3) -> Column:
    """True when some run of ``n`` characters of ``left`` occurs in ``right``."""
    found = F.exists(char_grams(left, n), lambda g: F.contains(right, g))
    return F.when(F.length(left) >= n, found).otherwise(F.lit(False))
