"""The news flow: articles to company, sector and trend texts to the final table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, prompts
from ..functions import text as tx
from ..operators import cleaning, keywords, lookup, rollup, scoring
from ..operators.joins import lookup_join
from ..operators.ordering import with_ordinal
from ..session import checkpointed

COMPANY = ["year", "company_name", "sector_name"]
SECTOR = ["year", "sector_name"]


@dataclass(frozen=True)
class Report:
    """Tables of the flow, from finest to coarsest, and the final join."""

    companies: DataFrame
    sectors: DataFrame
    trends: DataFrame
    final: DataFrame


def sentiment_lists(rows: DataFrame, keys: list[str], prefix: str,
                    polarity: Callable[[Column], Column], summary: str) -> DataFrame:
    """Score keyword rows and gather them per key: three aligned lists, the mean, the text.

    There is one text per key and at most five keywords per text, so the groups
    are bounded.
    """
    scored = rows.withColumn("keywords_sentiment", polarity(F.col("keywords")))
    return rollup.aggregate_rows(
        scored.withColumns({
            "sentiment": F.col("keywords_sentiment"),
            "keywords_score": numeric.plain_number(F.col("keywords_score")),
            "keywords_sentiment": numeric.plain_number(F.col("keywords_sentiment"))}),
        keys, "kw_no", ("keywords", "keywords_score", "keywords_sentiment"), (summary,),
        {f"{prefix}_sentiment": F.avg("sentiment")},
        {"keywords": f"{prefix}_keywords", "keywords_score": f"{prefix}_keywords_score",
         "keywords_sentiment": f"{prefix}_keywords_sentiment", summary: f"{prefix}_summary"})


def merge_report(companies: DataFrame, sectors: DataFrame, trends: DataFrame) -> DataFrame:
    """Company rows with their sector's row of the year and the sector's trend."""
    with_sector = lookup_join(companies, sectors, SECTOR, "left", ["company_name"])
    return lookup_join(with_sector, trends.select("sector_name", "sector_trend"), ["sector_name"], "left",
                       ["year", "company_name"])


def report(articles: DataFrame, mapping: DataFrame, order: str,
           polarity: Callable[[Column], Column] = scoring.lexicon_polarity,
           scorer: scoring.ColumnScorer = tx.richest_sentence,
           judge: scoring.ColumnScorer | None = None, with_prompts: bool = False,
           materialize: Callable[[DataFrame, str], DataFrame] = checkpointed) -> Report:
    """Run the flow on cleaned articles (company_name, year, content and an order column).

    ``mapping`` is the sector table of :func:`lookup.add_sector`.  ``judge``
    answers the relevance prompt with yes or no; without it all articles count.
    With ``with_prompts`` the scorer gets the prompts of each level around the texts.
    ``materialize``
    writes a stage and reads it back; the default uses the checkpoint folder.  It
    follows the scorers, so that neither reuse nor a retry repeats inference.
    """
    summarized = rollup.summarize_articles(articles, scorer=scorer)
    summaries = materialize(summarized.select("year", "company_name", order, "summary"), "summaries")
    placed = lookup.add_sector(summaries, mapping, [order])
    if judge is not None:
        asked = prompts.fill(prompts.RELEVANCE, sector=F.col("sector_name"), text=F.col("summary"))
        answered = materialize(placed.withColumns({"answer": judge(asked), "success": F.lit(1)}), "answers")
        placed = cleaning.reject_irrelevant(answered)
    companies = checkpointed(rollup.summarize_companies(
        placed, order, keys=COMPANY, scorer=scorer, with_prompts=with_prompts))
    # Companies follow each other by name; the range sort turns names into ordinals.
    ordered = with_ordinal(companies, SECTOR + ["company_name"], "company_ord")
    companies = ordered.drop("company_ord")
    sectors = materialize(rollup.summarize_sectors(
        ordered, "company_ord", SECTOR, scorer=scorer, with_prompts=with_prompts), "sectors")
    asked = rollup.trend_prompts(sectors)
    # A scorer that answers prompts gets the whole prompt, any other the summaries alone.
    trends = materialize(asked.select("sector_name", scorer(F.col(
        "prompt" if with_prompts else "lines")).alias("sector_trend")), "trends")
    company_rows = sentiment_lists(keywords.company_keywords(companies), COMPANY,
                                   "company", polarity, "summary_result")
    sector_rows = sentiment_lists(keywords.sector_keywords(sectors), SECTOR, "sector", polarity,
                                  "sector_summary")
    return Report(companies, sectors, trends, merge_report(company_rows, sector_rows, trends))
