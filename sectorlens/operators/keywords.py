"""Keyword extraction with maximal marginal relevance, row by row.

A document's keyword candidates depend on that document alone, so nothing here
shuffles.  Words are cut and filtered JVM-side; the greedy choice, whose every
step depends on the picks before it, runs over Arrow batches of word lists, of which
one list at a time becomes Python objects.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import wordlists

# Weight of diversity against relevance.
DIVERSITY = 0.7


def keyword_terms(text: Column, stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> Column:
    """Lower-case words of two characters or more that are no stop words."""
    return F.filter(F.transform(tx.words(text), F.lower),
                    lambda w: (F.length(w) >= 2) & ~w.isin(*stop_words))


def candidates(terms: Sequence[str], longest: int) -> list[tuple[str, float]]:
    """All n-gram candidates with their relevance, best first, ties by name.

    Relevance is the cosine between the bags of words of candidate and document.
    """
    counts = Counter(terms)
    length = math.sqrt(sum(n * n for n in counts.values()))
    rated = [(-n / length, term) for term, n in counts.items()]
    for n in range(2, longest + 1):
        plain = length * math.sqrt(n)
        for run in set(zip(*[terms[i:] for i in range(n)])):
            size = plain if len(set(run)) == n else length * math.sqrt(
                sum(m * m for m in Counter(run).values()))
            rated.append((-sum([counts[t] for t in run]) / size, " ".join(run)))
    rated.sort()
    return [(keyword, -rel) for rel, keyword in rated]


def _grams(keyword: str, n: int = 3) -> frozenset[str]:
    return frozenset(keyword[i:i + n] for i in range(max(len(keyword) - n + 1, 1)))


def choose(rated: Sequence[tuple[str, float]], top_n: int,
           diversity: float = DIVERSITY) -> list[tuple[str, float]]:
    """Greedy choice of ``top_n`` candidates, relevant and unlike those chosen before.

    The first pick is the most relevant; each further one maximises
    (1 - diversity) * relevance - diversity * greatest similarity to a pick, the
    similarity being the Jaccard index of character 3-grams.  All candidates stay
    in play.  A candidate's score only falls as picks are added, so an old score
    is an upper bound and is brought up to date only when it leads the queue.
    """
    # Best first, so the list is a heap as it stands.
    queue = [(-(1 - diversity) * rel, at, 0, 0.0) for at, (_, rel) in enumerate(rated)]
    picked: list[int] = []
    grams: list[frozenset[str]] = []
    while queue and len(picked) < top_n:
        _, at, seen, near = heapq.heappop(queue)
        keyword, rel = rated[at]
        own = _grams(keyword)
        if seen == len(picked):
            picked.append(at)
            grams.append(own)
            continue
        for other in grams[seen:]:
            shared = len(own & other)
            near = max(near, shared / (len(own) + len(other) - shared))
        heapq.heappush(queue, (-((1 - diversity) * rel - diversity * near), at, len(picked), near))
    return [rated[at] for at in picked]


def chosen_lists(lists: pa.Array, longest: int, top_n: int, diversity: float = DIVERSITY) -> pa.Array:
    """The choice for every word list of a batch; a null list gives null.

    The batch stays in Arrow: as Python strings it would take many times its size.
    """
    keywords, relevances, ends, missing = [], [], [0], []
    for terms in lists:
        missing.append(not terms.is_valid)
        for keyword, rel in choose(candidates(terms.as_py(), longest), top_n, diversity) if terms.is_valid else ():
            keywords.append(keyword)
            relevances.append(rel)
        ends.append(len(keywords))
    picked = pa.StructArray.from_arrays(
        [pa.array(keywords, pa.string()), pa.array(relevances, pa.float64())], ["keyword", "rel"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), picked, mask=pa.array(missing, pa.bool_()))


def select_diverse(terms: Column, longest: int, top_n: int,
                   diversity: float = DIVERSITY) -> Column:
    """Diverse keywords of a word list as array<struct<keyword,rel>>, in order of choice."""

    @F.arrow_udf("array<struct<keyword:string,rel:double>>")
    def select(lists: pa.Array) -> pa.Array:
        return chosen_lists(lists, longest, top_n, diversity)

    return select(terms)


def diverse_keywords(text: Column, longest: int, top_n: int, diversity: float = DIVERSITY,
                     stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> Column:
    """The ``top_n`` diverse keywords of a text, most relevant first."""
    picked = select_diverse(keyword_terms(text, stop_words), longest, top_n, diversity)
    ordered = F.sort_array(F.transform(picked, lambda p: F.struct(
        (-p["rel"]).alias("neg"), p["keyword"].alias("keyword"))))
    return F.transform(ordered, lambda p: F.struct(
        p["keyword"].alias("keyword"), F.round(-p["neg"], 4).alias("score")))


def keyword_rows(df: DataFrame, found: Column, keep: int = 5) -> DataFrame:
    """One row per keyword: ``kw_no`` from 1, ``keywords``, ``keywords_score``.

    Documents without keywords give no row.
    """
    return (df.withColumn("found", found)
              .select(*df.columns, F.posexplode(F.slice("found", 1, keep)).alias("kw_no", "kw"))
              .select(*df.columns, (F.col("kw_no") + 1).cast("bigint").alias("kw_no"),
                      F.col("kw.keyword").alias("keywords"), F.col("kw.score").alias("keywords_score")))


def company_keywords(df: DataFrame, text: str = "summary_result", company: str = "company_name",
                     sector: str = "sector_name", year: str = "year", top_n: int = 10,
                     keep: int = 5, case_sensitive: bool = False, **options) -> DataFrame:
    """Keywords of company texts, none of which is the company, the sector or the year."""
    names = [F.col(company), F.col(sector), F.col(year).cast("string")]
    barred = F.array(*[n if case_sensitive else F.lower(n) for n in names])
    found = diverse_keywords(F.coalesce(F.col(text), F.lit("")), 1, top_n, **options)
    kept = F.filter(found, lambda k: ~F.coalesce(F.array_contains(
        barred, k["keyword"] if case_sensitive else F.lower(k["keyword"])), F.lit(False)))
    return keyword_rows(df, kept, keep)


def sector_keywords(df: DataFrame, text: str = "sector_summary", sector: str = "sector_name",
                    year: str = "year", top_n: int = 7, keep: int = 5, **options) -> DataFrame:
    """One- and two-word keywords of sector texts that contain neither year nor sector name."""
    found = diverse_keywords(F.coalesce(F.col(text), F.lit("")), 2, top_n, **options)
    kept = F.filter(found, lambda k: ~F.contains(k["keyword"], F.col(year).cast("string"))
                    & ~F.contains(F.lower(k["keyword"]), F.lower(F.col(sector))))
    return keyword_rows(df, kept, keep)
