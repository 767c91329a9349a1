"""Question flow: corpus of the final table, index, retrieval, prompts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import retrieval
from ..sources import readers, writers

KEY = "doc_ord"


@dataclass(frozen=True)
class Index:
    """Documents with their order key, vocabulary and postings."""

    docs: DataFrame
    terms: DataFrame
    postings: DataFrame

    def save(self, folder: str) -> None:
        writers.save_index(self.docs, self.terms, self.postings, folder)

    @classmethod
    def load(cls, spark, folder: str) -> "Index":
        return cls(*readers.load_index(spark, folder))


def build(final: DataFrame, order: str = "seq") -> Index:
    """Index of the texts of the final table."""
    docs = retrieval.build_corpus(final, order)
    return Index(docs, *retrieval.build_index(docs, KEY))


def answer(questions: DataFrame, index: Index, n: int = 10) -> DataFrame:
    """Prompt for every question (query_id, query, source), all of them at once.

    Local questions always get n excerpts, if need be of score zero.
    """
    # Online questions are passed on as they are, so nothing is looked up for them.
    local = questions.where(F.coalesce(F.col("source") != "Online", F.lit(True)))
    top = retrieval.retrieve(local, index.docs, "query_id", KEY, n, pad_zero=True,
                             index=(index.terms, index.postings))
    return retrieval.answer_prompts(questions, top, index.docs, "query_id", KEY)
