"""Row-wise cleaning of article tables.  Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web, wordlists

# Codes of the ``success`` column.
FETCHED, FETCH_FAILED, BAD_LENGTH, IRRELEVANT = 1, 0, -1, -2


def null_failed_text(df: DataFrame, text: str = "content", success: str = "success") -> DataFrame:
    """Null out the text, an error message, of rows that could not be fetched."""
    return df.withColumn(text, F.when(F.col(success) != FETCH_FAILED, F.col(text)))


def collapse_blank_lines(df: DataFrame, text: str = "content") -> DataFrame:
    """Turn runs of newlines into one newline."""
    return df.withColumn(text, tx.collapse_newlines(F.col(text)))


def keep_verb_lines(df: DataFrame, text: str = "content", language: str | Column = "language",
                    lexicons: Mapping[str, Sequence[str]] = wordlists.VERB_WORDS,
                    suffixes: Mapping[str, Sequence[str]] = wordlists.VERB_SUFFIXES) -> DataFrame:
    """Drop lines that hold a sentence without a verb."""
    code = F.col(language) if isinstance(language, str) else language
    return df.withColumn(text, tx.keep_verb_lines(F.col(text), code, lexicons, suffixes))


def filter_length(df: DataFrame, text: str = "content", success: str = "success",
                  low: int = 200, high: int = 30000) -> DataFrame:
    """Null texts outside the length range and mark every textless row."""
    kept = df.withColumn(text, tx.within_length(F.col(text), low, high))
    return kept.withColumn(success, F.when(F.col(text).isNull(), F.lit(BAD_LENGTH))
                           .otherwise(F.col(success)))


def strip_boilerplate(df: DataFrame, text: str = "content",
                      markers: Sequence[str] = wordlists.BOILERPLATE_MARKERS) -> DataFrame:
    """Cut boilerplate from its marker to the end of the line."""
    return df.withColumn(text, tx.cut_marked_tails(F.col(text), markers))


def clean_articles(df: DataFrame, text: str = "content", success: str = "success",
                   language: str | Column = "language",
                   markers: Sequence[str] = wordlists.BOILERPLATE_MARKERS) -> DataFrame:
    """The whole cleaning stage: failures, lines, length, boilerplate, length again."""
    df = null_failed_text(df, text, success)
    df = keep_verb_lines(collapse_blank_lines(df, text), text, language)
    df = filter_length(df, text, success)
    return filter_length(strip_boilerplate(df, text, markers), text, success)


def split_sentences(df: DataFrame, keys: Sequence[str], text: str = "content") -> DataFrame:
    """One row per sentence with its position, from 1."""
    return df.select(*keys, F.posexplode(tx.sentences(F.col(text))).alias("pos", "sentence")) \
             .withColumn("pos", (F.col("pos") + 1).cast("bigint"))


def parse_pages(df: DataFrame, html: str = "html", text: str = "content") -> DataFrame:
    """Article text of raw pages; a page without paragraph text counts as failed."""
    body = web.article_text(F.col(html))
    parsed = df.withColumn(text, body)
    ok = F.coalesce(F.length(text) > 0, F.lit(False))
    return (parsed.withColumn("success", F.when(ok, FETCHED).otherwise(FETCH_FAILED))
                  .withColumn(text, F.when(ok, F.col(text)).otherwise("no article text"))
                  .drop(html))


def reject_irrelevant(df: DataFrame, answer: str = "answer", summary: str = "summary",
                      success: str = "success") -> DataFrame:
    """Apply relevance answers: ``no`` empties the summary and marks the row.

    The rejected text stays in ``rejected_text`` for the side output; rows
    without a summary are not judged.
    """
    said_no = F.coalesce(F.col(summary) != "", F.lit(False)) & F.coalesce(tx.answers_no(F.col(answer)), F.lit(False))
    return (df.withColumn("rejected_text", F.when(said_no, F.col(summary)))
              .withColumn(success, F.when(said_no, F.lit(IRRELEVANT)).otherwise(F.col(success)))
              .withColumn(summary, F.when(said_no, F.lit("")).otherwise(F.col(summary))))


def rejected(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Side output of :func:`reject_irrelevant`: keys and rejected text."""
    return df.where(F.col("rejected_text").isNotNull()).select(*keys, "rejected_text")
