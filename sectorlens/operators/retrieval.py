"""TF-IDF index and retrieval for a whole table of questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions import text as tx
from ..functions import wordlists
from ..session import checkpointed, stored
from . import impact_index
from .joins import is_small, lookup_join, spread_join
from .ordering import first_values, joined

# Question terms that are sent to every task at most: tens of megabytes.
BROADCAST_TERMS = 500_000
# Most frequent terms that are sent to every task at most, with their idf.
FREQUENT_TERMS = 200_000


def build_corpus(final: DataFrame, order: str = "seq") -> DataFrame:
    """Texts to retrieve from: every company text, the first sector text per year and
    sector, the first trend per sector.

    Duplicates are kept.  ``doc_ord`` is a struct that orders the documents; it
    takes the place of a running number, which would need a global sort.
    """
    def doc(kind: int, text: str, year: Column, sector: Column, seq: Column) -> list[Column]:
        place = F.struct(F.lit(kind).alias("kind"), year.cast("bigint").alias("year"),
                         sector.cast("string").alias("sector"), seq.cast("bigint").alias("seq"))
        return [place.alias("doc_ord"), F.col(text).alias("text")]

    none = F.lit(0)
    company = final.select(*doc(1, "company_summary", none, F.lit(""), F.col(order)))
    sectors = first_values(final, ["year", "sector_name"], ["sector_summary"], order)
    trends = first_values(final, ["sector_name"], ["sector_trend"], order)
    return (company
            .unionByName(sectors.select(*doc(2, "sector_summary", F.col("year"),
                                             F.col("sector_name"), none)))
            .unionByName(trends.select(*doc(3, "sector_trend", none, F.col("sector_name"), none))))


def term_frequencies(docs: DataFrame, key: str, text: str = "text",
                     stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> DataFrame:
    """(key, term, tf) of each document.  Counted inside the row: no shuffle."""
    counts = tx.term_counts(tx.index_terms(F.coalesce(F.col(text), F.lit("")), stop_words))
    return docs.select(key, F.explode(counts).alias("t")).select(
        key, F.col("t.term").alias("term"), F.col("t.tf").alias("tf"))


def fit_terms(docs: DataFrame, key: str, text: str = "text",
              stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> DataFrame:
    """Vocabulary: ``term``, ``df`` and idf = ln((1 + documents) / (1 + df)) + 1.

    Combined map-side, so a term found in every document is no burden.
    """
    return _vocabulary(term_frequencies(docs, key, text, stop_words), docs)


def _vocabulary(frequencies: DataFrame, docs: DataFrame) -> DataFrame:
    size = docs.agg(F.count(F.lit(1)).alias("n"))
    counted = frequencies.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.withColumn("idf", F.log((F.lit(1) + size.scalar()) / (F.lit(1) + F.col("df"))) + 1)


def weigh(docs: DataFrame, terms: DataFrame, key: str, text: str = "text",
          stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> DataFrame:
    """Postings (key, term, tf, weight): tf * idf, scaled to length one per document.

    Unknown terms are ignored.  The document frequency tells which terms are hot,
    so the join spreads them without counting again.  A document's terms meet
    once more for its length; that group is bounded by the document itself.
    """
    return _weighed(term_frequencies(docs, key, text, stop_words), terms, key)


def _weighed(frequencies: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    hot = terms.select("term", F.col("df").alias("key_rows"))
    return _scaled(lookup_join(frequencies, terms.select("term", "idf"), ["term"], "inner",
                               [key], hot), key)


def _scaled(found: DataFrame, key: str) -> DataFrame:
    raw = found.withColumn("raw", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", (F.col("raw") / length).alias("weight"))


def build_index(docs: DataFrame, key: str, text: str = "text",
                stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> tuple[DataFrame, DataFrame]:
    """(terms, postings) of a corpus.  Write both with ``sources.writers.save_index``.

    The term counts are written down once, so that no text is cut into terms twice, and so is the
    vocabulary, which every later step reads.
    """
    frequencies = stored(term_frequencies(docs, key, text, stop_words))
    terms = checkpointed(_vocabulary(frequencies, docs))
    return terms, _weighed(frequencies, terms, key)


def frequent_from(terms: DataFrame, most: int | None = None) -> int:
    """The smallest power of two as a document frequency that at most ``most`` terms reach."""
    power = F.floor(F.log2(F.col("df").cast("double"))).cast("int")
    # One row per power of two.
    sizes = {r["power"]: r["n"] for r in terms.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    most, total, least = FREQUENT_TERMS if most is None else most, 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    return 1 << least


def wanted_documents(frequencies: DataFrame, terms: DataFrame, wanted: DataFrame, key: str,
                     most: int | None = None) -> DataFrame:
    """(key, ``listed``): each document's weights of the wanted terms, scaled by the length of all its terms.

    ``wanted`` has (term, code), few rows; ``listed`` is array<struct<weight,term>> with codes as
    terms.  The idf of frequent and of wanted terms is sent to all tasks, where a document's rows lie
    together; only rows of rarer terms, none of which is hot, are shuffled to meet theirs.
    """
    least = frequent_from(terms, most)
    near = stored(terms.join(F.broadcast(wanted), "term", "left")
                  .where((F.col("df") >= least) | F.col("code").isNotNull()).select("term", "idf", "code"))
    raw = F.col("tf") * F.col("idf")
    known = frequencies.join(F.broadcast(near), "term").groupBy(key).agg(
        F.sum(raw * raw).alias("square"),
        F.collect_list(F.when(F.col("code").isNotNull(), F.struct(raw.alias("weight"), F.col("code").alias("term")))
                       ).alias("listed"))
    rare = frequencies.join(F.broadcast(near.select("term")), "term", "left_anti") \
                      .join(terms.where(F.col("df") < least).select("term", "idf"), "term") \
                      .groupBy(key).agg(F.sum(raw * raw).alias("rest"))
    length = F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0)))
    return known.where(F.size("listed") > 0).join(rare, key, "left").withColumn("length", length).select(
        key, F.transform("listed", lambda p: F.struct(
            (p["weight"] / F.col("length")).alias("weight"), p["term"].alias("term"))).alias("listed"))


def count_terms(questions: DataFrame, query: str = "query",
                stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> int:
    """How many terms all questions have together.  Runs a job on the questions."""
    counted = questions.agg(F.sum(F.size(tx.index_terms(F.col(query), stop_words))).alias("n"))
    return counted.first()["n"] or 0


def weigh_questions(questions: DataFrame, terms: DataFrame, query_key: str, query: str = "query",
                    small: bool = False, stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> DataFrame:
    """(question, term, asked): the questions' known terms weighed like those of documents.

    ``small`` sends the questions' terms to the vocabulary instead of shuffling both.
    """
    frequencies = term_frequencies(questions, query_key, query, stop_words)
    wanted = F.broadcast(frequencies) if small else frequencies
    return _scaled(wanted.join(terms.select("term", "idf"), "term"), query_key).select(
        query_key, "term", F.col("weight").alias("asked"))


def score(questions: DataFrame, terms: DataFrame, postings: DataFrame, query_key: str,
          key: str, query: str = "query", decimals: int = 6,
          stop_words: Sequence[str] = wordlists.STOP_WORDS_EN) -> DataFrame:
    """Cosine of every question with every document that shares a term with it.

    The questions' terms are counted first.  Up to ``BROADCAST_TERMS`` of them are
    sent to all tasks: the postings then stay where they are, partitioned by
    document, which is what the sum per question and document needs.  More
    questions than that meet the postings in a join that spreads hot terms over
    tasks by document.
    """
    small = count_terms(questions, query, stop_words) <= BROADCAST_TERMS
    asked = weigh_questions(questions, terms, query_key, query, small, stop_words)
    listed = postings.select(key, "term", "weight")
    if small:
        met = listed.join(F.broadcast(asked), "term")
    else:
        met = spread_join(listed, asked, ["term"], "inner", [key],
                          terms.select("term", F.col("df").alias("key_rows")))
    return met.groupBy(query_key, key).agg(
        F.round(F.sum(F.col("asked") * F.col("weight")), decimals).alias("score"))


def top_documents(scores: DataFrame, query_key: str, key: str, n: int = 10) -> DataFrame:
    """The n best documents per question; on equal scores the later document comes first.

    The rank limit also works before the shuffle, so a task sends n rows per question.
    """
    order = Window.partitionBy(query_key).orderBy(F.desc("score"), F.desc(key))
    ranked = scores.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))


def pad_with_zeros(top: DataFrame, questions: DataFrame, docs: DataFrame, query_key: str,
                   key: str, n: int = 10) -> DataFrame:
    """Fill questions with fewer than n matches up to n by the last documents, score 0.

    At most n documents can be taken already, so the last 2n documents hold
    enough candidates.
    """
    last = docs.select(key).orderBy(F.desc(key)).limit(2 * n)
    spare = last.agg(F.sort_array(F.collect_list(key), asc=False).alias("spare"))
    taken = questions.select(query_key).join(
        top.groupBy(query_key).agg(F.collect_list(key).alias("taken")), query_key, "left")
    have = F.greatest(F.size("taken"), F.lit(0))
    free = F.array_except(spare.scalar(), F.coalesce("taken", F.slice(spare.scalar(), 1, 0)))
    fill = taken.select(query_key, have.alias("have"),
                        F.posexplode(F.slice(free, F.lit(1), F.greatest(n - have, F.lit(0)))).alias("at", key)
                        ).select(
        query_key, key, F.lit(0.0).alias("score"),
        (F.col("have") + F.col("at") + 1).cast("bigint").alias("rank"))
    return top.select(*fill.columns).unionByName(fill)


def retrieve(questions: DataFrame, docs: DataFrame, query_key: str, key: str, n: int = 10,
             query: str = "query", text: str = "text", pad_zero: bool = False,
             index: tuple[DataFrame, DataFrame] | None = None,
             stop_words: Sequence[str] = wordlists.STOP_WORDS_EN,
             impacts: impact_index.ImpactIndex | None = None) -> DataFrame:
    """Best n documents for every question: query key, document key, score, rank.

    Blocks of documents that cannot reach a question's n-th score are not scored, see
    :mod:`.impact_index`.  ``impacts`` is the postings' index in blocks, in which case ``index`` is
    what it was built from; without it one is built.  Without either, few questions get an index
    of the terms they ask for; documents' lengths still count all terms.
    """
    small = count_terms(questions, query, stop_words) <= BROADCAST_TERMS
    if index is None:
        frequencies = stored(term_frequencies(docs, key, text, stop_words))
        terms = stored(_vocabulary(frequencies, docs))
    else:
        terms, postings = index
    asked = weigh_questions(questions, terms, query_key, query, small, stop_words)
    if impacts is None and index is None and small:
        asked = checkpointed(asked)
        wanted = checkpointed(asked.select("term").distinct().withColumn("code", F.monotonically_increasing_id()))
        impacts = impact_index.from_documents(wanted_documents(frequencies, terms, wanted, key), key)
        asked = asked.join(F.broadcast(wanted), "term").select(query_key, F.col("code").alias("term"), "asked")
    elif impacts is None:
        impacts = impact_index.build(postings if index else _weighed(frequencies, terms, key), key)
    top = impact_index.search(asked, impacts, query_key, n)
    return pad_with_zeros(stored(top), questions, docs, query_key, key, n) if pad_zero else top


def answer_prompts(questions: DataFrame, top: DataFrame, docs: DataFrame, query_key: str,
                   key: str, query: str = "query", text: str = "text",
                   source: str = "source") -> DataFrame:
    """Prompt per question: the question itself for source ``Online``, else with excerpts.

    A question has at most n excerpts, so its group is bounded.  The chosen keys
    are written down and counted; when they are few, the documents' texts are not
    shuffled to find them.
    """
    chosen = checkpointed(top.select(query_key, key, "rank"))
    wanted = F.broadcast(chosen) if is_small(chosen) else chosen
    excerpts = docs.select(key, F.col(text).alias("excerpt")).join(wanted, key)
    piece = prompts.fill(prompts.EXCERPT, number=F.col("rank"), text=F.col("excerpt"))
    gathered = excerpts.groupBy(query_key).agg(joined(piece, F.col("rank"), "").alias("excerpts"))
    local = prompts.fill(prompts.RETRIEVAL, question=F.col(query),
                         text=F.coalesce("excerpts", F.lit("")))
    return questions.join(gathered, query_key, "left").select(
        query_key, source,
        F.when(F.col(source) == "Online", F.col(query)).otherwise(local).alias("prompt"))
