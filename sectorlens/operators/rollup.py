"""Roll-ups: article windows to article, articles to company, companies to sector, years to trend."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions import text as tx
from ..session import checkpointed, stored
from .joins import lookup_join
from .ordering import CHUNK_ROWS, block_of, first_rows, joined, joined_together, ordered_text, with_pages
from .packing import pack_by_chars, pack_by_words
from .scoring import ColumnScorer
from .windows import token_windows, window_arrays

# Segment summaries that are joined for one summary of the next level.
FAN_IN = 1000


def summarize_articles(df: DataFrame, text: str = "content", name: str = "summary",
                       scorer: ColumnScorer = tx.richest_sentence, **window) -> DataFrame:
    """Summary of each article: the window summaries joined by a blank.

    The windows cover the whole text; they are cut, scored and joined inside the row, without a shuffle.
    For a batch scorer use :func:`token_windows`, then
    ``scoring.score_in_batches`` and :func:`join_window_summaries`.
    """
    windows = window_arrays(tx.blank_tokens(F.col(text)), keep_tail=True, **window)
    found = F.transform(windows, lambda t: scorer(F.array_join(t, " ")))
    whole = F.array_join(F.filter(found, lambda s: s.isNotNull()), " ")
    return df.withColumn(name, F.when(F.col(text).isNotNull(), whole).otherwise(F.lit("")))


def article_windows(df: DataFrame, keys: Sequence[str], text: str = "content",
                    **window) -> DataFrame:
    """Window texts keyed by document and window, the input of a batch scorer."""
    return (token_windows(df, keys, text, keep_tail=True, **window)
            .withColumn("segment", F.array_join("tokens", " ")).drop("tokens"))


def join_window_summaries(scored: DataFrame, keys: Sequence[str], summary: str = "summary_seg",
                          name: str = "summary") -> DataFrame:
    """Join the scored windows of a document in order; a group is one document."""
    return scored.groupBy(*keys).agg(
        F.coalesce(joined(F.col(summary), F.col("seg_no"), " "), F.lit("")).alias(name))


def company_texts(df: DataFrame, order: str = "doc_id", text: str = "summary",
                  keys: Sequence[str] = ("company_name", "sector_name"),
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Article summaries per company joined by ``###``, in pages.  Empty summaries are skipped."""
    filled = df.withColumn(text, F.nullif(F.col(text), F.lit("")))
    return ordered_text(filled, keys, order, text, "###", "summary", chunk_rows)


def sector_texts(df: DataFrame, order: str, text: str = "summary_result",
                 keys: Sequence[str] = ("year", "sector_name"),
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Company summaries per sector joined by `` ### ``, in pages."""
    return ordered_text(df, keys, order, text, " ### ", "sector_content", chunk_rows)


def merge_summaries(segments: DataFrame, keys: Sequence[str], final: ColumnScorer,
                    fan_in: int = FAN_IN, in_pages: bool = False) -> DataFrame:
    """Reduce the segment summaries of a group to one text per group, whatever its size.

    ``segments`` has keys, ``seg_no`` from 1, ``summary`` and ``is_final``, which
    marks a lone summary that is the result already.  Up to ``fan_in`` summaries
    are joined in order and summarised once more with ``final``; a group with
    more goes through further levels of the same kind, as many as the largest
    group needs.  So ``final`` sees at most ``fan_in`` summaries at a time and must
    be able to summarise its own results; a smaller ``fan_in`` means more calls.
    Every level is written down, so no call is repeated.

    ``in_pages`` is for a ``final`` that gives back its text with something before it, like a
    prompt: such a text grows with its group and fits no row.  It is returned in pages (keys,
    ``page_no``, ``summary``) whose concatenation in order is the text.  Keys and summaries are not null.
    """
    keys = list(keys)
    if in_pages:
        return _merged_in_pages(segments, keys, final, fan_in)
    level = checkpointed(segments.select(*keys, (F.col("seg_no") - 1).alias("no"), "is_final", "summary"))
    open_groups = True
    while open_groups:
        grouped = level.groupBy(*keys, block_of("no", fan_in).alias("page")).agg(
            F.count(F.lit(1)).alias("parts"), F.max("is_final").alias("is_final"),
            joined(F.col("summary"), F.col("no"), " ").alias("text"))
        done = F.col("is_final") & (F.col("parts") == 1)
        level = checkpointed(grouped.select(
            *keys, F.col("page").alias("no"), F.lit(True).alias("is_final"),
            F.when(done, F.col("text")).otherwise(final(F.coalesce("text", F.lit("")))).alias("summary")))
        open_groups = bool(level.where("no > 0").head(1))
    return level.select(*keys, "summary")


def _merged_in_pages(segments: DataFrame, keys: list[str], final: ColumnScorer, fan_in: int) -> DataFrame:
    """The levels of :func:`merge_summaries` on numbers alone: where each text that ``final`` is asked about begins."""
    texts = stored(segments.select(*keys, (F.col("seg_no") - 1).alias("no"), "is_final", "summary"))
    level, asked = texts.select(*keys, "no", "is_final", F.col("no").alias("at")), []
    open_groups = True
    while open_groups:
        grouped = level.groupBy(*keys, block_of("no", fan_in).alias("page")).agg(
            F.count(F.lit(1)).alias("parts"), F.max("is_final").alias("is_final"), F.min("at").alias("at"))
        level = checkpointed(grouped.select(
            *keys, F.col("page").alias("no"), F.lit(True).alias("is_final"), "at",
            (~F.col("is_final") | (F.col("parts") > 1)).cast("int").alias("leads")))
        asked.append(level.select(*keys, F.col("at").alias("no"), "leads", F.lit(False).alias("is_first")))
        open_groups = bool(level.where("no > 0").head(1))
    # The last level has one row per group, which begins with the group.
    firsts = level.select(*keys, F.col("at").alias("no"), F.lit(0).alias("leads"), F.lit(True).alias("is_first"))
    marks = checkpointed(functools.reduce(DataFrame.unionAll, asked, firsts).groupBy(*keys, "no").agg(
        F.sum("leads").cast("int").alias("leads"), F.max("is_first").alias("is_first")))
    before = F.concat(F.when(F.col("is_first"), F.lit("")).otherwise(F.lit(" ")),
                      F.repeat(final(F.lit("")), F.coalesce("leads", F.lit(0))))
    return lookup_join(texts, marks, [*keys, "no"]).select(
        *keys, F.col("no").alias("page_no"), F.concat(before, "summary").alias("summary"))


def summarize_companies(df: DataFrame, order: str = "doc_id", text: str = "summary",
                        keys: Sequence[str] = ("company_name", "sector_name"),
                        scorer: ColumnScorer = tx.richest_sentence, limit: int = 3000,
                        with_prompts: bool = False, in_pages: bool = False) -> DataFrame:
    """One ``summary_result`` per company: short texts at once, long ones by segments.

    A text longer than ``limit`` is packed into segments, each is summarised and
    the joined summaries are summarised again.  ``in_pages`` as in :func:`merge_summaries`.
    """
    keys = list(keys)

    def ask(template: str):
        if not with_prompts:
            return scorer
        return lambda t: scorer(prompts.fill(template, text=t))

    present = df.where(_present(keys)).withColumn(text, F.nullif(F.col(text), F.lit("")))
    # Length of the whole joined text, markers included, without building it.
    sizes = checkpointed(present.groupBy(*keys).agg(
        F.coalesce(F.sum(F.length(text) + 3) - 3, F.lit(0)).alias("n_chars"), F.count(text).alias("texts")))
    segments = pack_by_chars(present, keys, order, text, limit)
    # A company without any summary is asked about the empty text.
    columns = [*keys, "seg_no", "segment", "n_chars"]
    whole = lookup_join(segments, sizes.drop("texts"), keys, "left", ["seg_no"]).select(*columns).unionByName(
        sizes.where("texts = 0").select(*keys, F.lit(1).cast("bigint").alias("seg_no"),
                                        F.lit("").alias("segment"), "n_chars"))
    # A short text is one segment, after an empty one when it nearly reaches the limit.
    is_final = F.col("n_chars") <= limit
    asked = whole.where(~is_final | (F.col("segment") != "") | (F.col("n_chars") == 0))
    scored = asked.select(*keys, "seg_no", is_final.alias("is_final"),
                          ask(prompts.COMPANY_SEGMENT)(F.col("segment")).alias("summary"))
    merged = merge_summaries(scored, keys, ask(prompts.COMPANY_FINAL), in_pages=in_pages)
    return merged.withColumnRenamed("summary", "summary_result")


def summarize_sectors(companies: DataFrame, order: str,
                      keys: Sequence[str] = ("year", "sector_name"), text: str = "summary_result",
                      scorer: ColumnScorer = tx.richest_sentence, limit: int = 3000,
                      with_prompts: bool = False, in_pages: bool = False) -> DataFrame:
    """One ``sector_summary`` per sector and year: segments of about ``limit`` words are
    summarised and consolidated.  ``in_pages`` as in :func:`merge_summaries`."""
    keys = list(keys)
    sector = F.col(keys[-1])

    def segment_scorer(t: Column) -> Column:
        return scorer(prompts.fill(prompts.SECTOR_SEGMENT, sector=sector, text=t)) if with_prompts \
            else scorer(t)

    def final_scorer(t: Column) -> Column:
        if not with_prompts:
            return scorer(t)
        return scorer(prompts.fill(prompts.SECTOR_FINAL, sector=sector, year=F.col(keys[0]), text=t))

    segments = pack_by_words(companies.where(_present(keys)), keys, order, text, limit)
    summary = segment_scorer(F.col("segment"))
    if with_prompts:
        summary = prompts.fill(prompts.SECTOR_PART, sector=sector, number=F.col("seg_no"), text=summary)
    scored = segments.select(*keys, "seg_no", F.lit(False).alias("is_final"), summary.alias("summary"))
    merged = merge_summaries(scored, keys, final_scorer, in_pages=in_pages)
    return merged.withColumnRenamed("summary", "sector_summary")


def trend_prompts(sectors: DataFrame, order: str | None = None,
                  text: str = "sector_summary") -> DataFrame:
    """One prompt per sector with its yearly summaries in order of the year: ``lines``, ``prompt``.

    The first row per sector and year counts, so a group has one line per year.
    Without an order column the table is taken to have one row per sector and year.
    """
    yearly = sectors if order is None else first_rows(sectors, ["sector_name", "year"], order)
    line = prompts.fill(prompts.TREND_LINE, year=F.col("year"), text=F.col(text))
    lines = yearly.groupBy("sector_name").agg(
        F.coalesce(joined(line, F.col("year"), "\n"), F.lit("")).alias("lines"))
    return lines.select("sector_name", "lines", prompts.fill(
        prompts.TREND, sector=F.col("sector_name"), text=F.col("lines")).alias("prompt"))


def keyword_lists(rows: DataFrame, keys: Sequence[str], order: str,
                  columns: Sequence[str] = ("keywords", "keywords_score", "keywords_sentiment"),
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Join keyword, score and sentiment rows of a group by ``; ``, aligned, in pages.

    A page holds ``chunk_rows`` rows that follow each other in the group's order,
    which bounds what one task joins.
    """
    lists = joined_together({c: F.col(c) for c in columns}, F.col(order), "; ")
    paged = with_pages(rows.where(_present(keys)), keys, order, chunk_rows)
    return paged.groupBy(*keys, "page_no").agg(*lists)


def aggregate_rows(rows: DataFrame, keys: Sequence[str], order: str,
                   lists: Sequence[str] = (), first: Sequence[str] = (),
                   aggregates: Mapping[str, Column] | None = None,
                   rename: Mapping[str, str] | None = None, separator: str = "; ") -> DataFrame:
    """Aggregate a keyword table by the caller's choice, in one pass.

    ``lists`` are joined in one common order, ``first`` keeps the first non-null
    value, ``aggregates`` names further aggregate columns, ``rename`` maps names
    of the result; names it does not have are ignored.  For groups of bounded
    size, such as the keywords of one text; see :func:`keyword_lists` otherwise.
    """
    joins = joined_together({c: F.col(c) for c in lists}, F.col(order), separator) if lists else []
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
             for c in first if c not in keys]
    further = [c.alias(n) for n, c in (aggregates or {}).items()]
    done = rows.where(_present(keys)).groupBy(*keys).agg(*joins, *picks, *further)
    return done.withColumnsRenamed(dict(rename or {}))


def _present(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
