"""Prompt texts as column expressions.  The wording is a fixed value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt wording.
RELEVANCE = ("Is this article related to financial news or related to {sector} industry? "
             "Answer 'yes' or 'no': {text}")
COMPANY_SEGMENT = "Summarize this detailed content: {text}"
COMPANY_FINAL = "Provide a final summary: {text}"
SECTOR_SEGMENT = (
    "Provide a comprehensive summary focusing on the {sector} sector for the year, highlighting key "
    "developments, challenges, and achievements. Pay special attention to advancements in technology, "
    "market dynamics, regulatory changes, and significant industry milestones. Ensure the report captures "
    "the essence of the sector's progress while discussing its difficulties, including economic "
    "fluctuations, supply chain issues, and environmental challenges.\n\n{text}")
SECTOR_PART = "For the {sector} sector, summary part {number}: {text}"
SECTOR_FINAL = ("Provide a concise summary for the {sector} sector for {year}, not exceeding 150 words, "
                "based on the following summaries.{text}")
TREND = (
    "Provide a comprehensive analysis on {sector} sector trends. Include developments, challenges, and "
    "achievements. Focus on technology, market dynamics, regulatory changes, and milestones. Highlight the "
    "main challenges and forces hindering the sector's development, offering a balanced view.\n\n{text}")
TREND_LINE = "Summary in {year}: {text}"
RETRIEVAL = ("Based on the document descriptions provided, please answer the following question related to "
             "the content: \n\n'{question}'\n\nRelevant document excerpts:\n{text}")
EXCERPT = "Article {number}\n{text}\n"


def fill(template: str, **parts: Column) -> Column:
    """Concatenate a template's literal pieces with the named columns.

    Null parts make the whole prompt null, so that a missing text never turns
    into a prompt about nothing.
    """
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if before:
            pieces.append(F.lit(before))
        pieces.append(parts[name].cast("string"))
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)
