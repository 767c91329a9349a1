"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition on measures of the text that rejects a row.  A measure that the table
already has is read; any other is worked out from the text inside the rule's own branch, so a row
that one rule rejects costs nothing in the rules after it.  On a bounded sample of raw rows the
time of every rule and the rows it rejects are measured; the cascade asks the rules in the order
of rejections per second.  The order changes the time and the name of the rejecting rule, never
which rows are kept.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import free_names, stored

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Places in a text beside the bits of a hash in one number.
_PLACES = 1 << 24
# Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000


# Every rule is timed this often, on the sample's rows this many times over.
REPEATS, COPIES = 3, 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


#: Measures of a text that rules can ask for.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: F.size(_words(text)),
    "word_chars": lambda text: _without(text, " \t\n\x0b\x0c\r"),
    "n_symbols": lambda text: F.length(text) - _without(text, SYMBOLS),
    "n_lines": lambda text: F.size(_lines(text)),
    "n_dup_lines": lambda text: F.size(_lines(text)) - F.size(F.array_distinct(_lines(text))),
    "upper_chars": lambda text: F.length(text) - _without(text, UPPER),
}


@dataclass(frozen=True)
class Rule:
    """A named condition that rejects a row; null counts as not rejecting.

    ``condition`` is SQL over the table's columns, or a function that gets a function from a
    measure's name to its column.
    """

    name: str
    condition: str | Callable[[Callable[[str], Column]], Column]

    def rejects(self, columns: Collection[str] = (), text: str = "text") -> Column:
        if isinstance(self.condition, str):
            return F.expr(self.condition)
        whole = F.coalesce(F.col(text), F.lit(""))
        return self.condition(lambda name: F.col(name) if name in columns
                              else MEASURES[name](whole).cast("bigint"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of every whole text: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines`` and ``n_repeat_words``.

    Null and blank texts have no words and measure 0 throughout, but for symbols.  Columns of
    these names are replaced, all others stay.  Windows of words are compared by 64-bit hashes.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c.lower() not in names]
    hashes, windowed, lines, sorted_windows, paired = free_names(
        docs, "hashes", "windows", "lines", "packed", "pairs")
    value = F.coalesce(F.col(text), F.lit(""))
    # Each step is a projection of its own, because the next one uses its arrays several times.
    cut = docs.select(
        *kept,
        F.transform(_words(value), lambda w: F.xxhash64(w)).alias(hashes),
        _lines(value).alias(lines),
        MEASURES["word_chars"](value).cast("bigint").alias("word_chars"),
        MEASURES["n_symbols"](value).cast("bigint").alias("n_symbols"))
    words = F.size(hashes)
    counted = cut.select(
        *kept, "word_chars", "n_symbols", words.cast("bigint").alias("n_words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(words < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), words - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + step) for step in range(WINDOW)])))
        .alias(windowed))
    windows = F.size(windowed)
    # Most texts repeat no window.  In the others, 40 bits of the hash and the place make one
    # number to sort by; windows that equal a neighbour in these bits are few and sorted exactly.
    packed = counted.select("*", F.when(F.size(F.array_distinct(windowed)) < windows, F.sort_array(
        F.transform(windowed, lambda w, i: w.bitwiseAND(F.lit(-_PLACES)).bitwiseOR(
            F.pmod(i.cast("bigint"), F.lit(_PLACES)))))).alias(sorted_windows))
    alike = F.filter(sorted_windows, lambda x, j: F.coalesce(
        x.bitwiseXOR(F.get(sorted_windows, j - 1)).between(0, _PLACES - 1), F.lit(False))
        | F.coalesce(x.bitwiseXOR(F.get(sorted_windows, j + 1)).between(0, _PLACES - 1), F.lit(False)))
    pairs = F.when(windows <= _PLACES, F.transform(alike, lambda x: F.struct(
        F.get(windowed, x.bitwiseAND(F.lit(_PLACES - 1)).cast("int")).alias("w"),
        x.bitwiseAND(F.lit(_PLACES - 1)).cast("int").alias("i")))).otherwise(
        F.transform(windowed, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    found = packed.select("*", F.when(F.col(sorted_windows).isNotNull(), F.sort_array(pairs)).alias(paired))
    return found.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(_covered(F.col(paired)), F.lit(0)).cast("bigint").alias("n_repeat_words"))


def _covered(pairs: Column) -> Column:
    """Words that lie in a window found twice or more, from sorted pairs of window and place.

    A window is matched with its neighbours; the places of the matched ones, sorted again, count
    at most the window's width each.
    """
    hits = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j - 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.get(pairs, j + 1)["w"] == x["w"], F.lit(False)))
    places = F.sort_array(F.transform(hits, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(places, start, lambda done, at: F.struct(
        at.alias("last"),
        (done["total"] + F.least(F.lit(WINDOW), at - done["last"])).alias("total")))["total"]


#: Rules over the measures; shares are compared without division, so empty texts pass.
DEFAULT_RULES = (
    Rule("symbols", lambda m: m("n_symbols") * 10 > m("n_words") * 3),
    # Lines are counted only where one of them is repeated.
    Rule("duplicate_lines", lambda m: (m("n_dup_lines") > 0) & (m("n_dup_lines") * 10 > m("n_lines") * 3)),
    Rule("word_length", lambda m: (m("word_chars") < m("n_words") * 2) | (m("word_chars") > m("n_words") * 15)),
    Rule("shouting", lambda m: m("upper_chars") * 2 > m("word_chars")),
)


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS,
            text: str = "text", prepare: Callable[[DataFrame], DataFrame] = lambda docs: docs) -> list[Rule]:
    """The rules by rejections per second, each counted on what those before it leave.

    At most ``sample_rows`` raw rows, spread over the table, are drawn first; ``prepare`` adds to
    the sample alone what the rules will find in the table.  A rule's cost is its shortest time
    over the time of a job without a rule, as a power of two, so that chance rarely changes the
    order.  An empty sample leaves the order as it is.
    """
    rows = docs.count()
    share = min(1.0, 2 * sample_rows / max(rows, 1))
    sample = stored(prepare(docs.sample(share, seed=7).limit(sample_rows)))
    if not sample.head(1):
        return list(rules)
    copy, = free_names(sample, "copy")
    every = sample.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def seconds(condition: Column) -> float:
        times = []
        for _ in range(REPEATS):
            begun = time.perf_counter()
            every.agg(F.count(F.when(condition, 1))).collect()
            times.append(time.perf_counter() - begun)
        return min(times)

    rejects = {rule.name: rule.rejects(sample.columns, text) for rule in rules}
    # The first job also compiles; what is left is the cost of any job.
    empty = seconds(F.col(sample.columns[0]).isNull())
    cost = {name: 2.0 ** round(math.log2(max(seconds(c) - empty, empty / 16))) for name, c in rejects.items()}
    flags = [set(i for i, f in enumerate(column) if f) for column in zip(*sample.select(
        *[F.coalesce(c, F.lit(False)) for c in rejects.values()]).collect())]
    left, result, gone = dict(zip(rejects, flags)), [], set()
    by_name = {r.name: r for r in rules}
    while left:
        best = max(left, key=lambda n: len(left[n] - gone) / cost[n])
        gone |= left.pop(best)
        result.append(by_name[best])
    return result


def cascade(docs: DataFrame, rules: list[Rule], name: str = "rejected_by", text: str = "text") -> DataFrame:
    """Add the name of the first rule that rejects the row, or null."""
    verdict = reduce(lambda done, rule: done.when(rule.rejects(docs.columns, text), F.lit(rule.name)), rules,
                     F.when(F.lit(False), F.lit("")))
    return docs.withColumn(name, verdict)
