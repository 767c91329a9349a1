"""Company and sector look-ups, search terms, site checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web, wordlists
from .joins import lookup_join


def sector_of_company(mapping: DataFrame) -> DataFrame:
    """One sector per company from (sector_ord, sector_name, company_name): the last wins."""
    return mapping.groupBy("company_name").agg(
        F.max_by("sector_name", "sector_ord").alias("sector_name"))


def add_sector(articles: DataFrame, mapping: DataFrame,
               spread_by: Sequence[str] | None = None) -> DataFrame:
    """Add ``sector_name``; a company in no sector gets the empty text."""
    plain = articles.drop("sector_name")
    found = lookup_join(plain, sector_of_company(mapping), ["company_name"], "left", spread_by)
    return found.withColumn("sector_name", F.coalesce("sector_name", F.lit("")))


def search_terms(mapping: DataFrame, keywords: DataFrame, years: Sequence[int]) -> DataFrame:
    """Sector x company x keyword x year with the query text and the year's date range.

    A sector without keywords searches by company name alone.  Every entry of the
    mapping is searched, a company listed twice therefore twice.
    """
    terms = mapping.select("sector_name", "company_name").join(keywords, "sector_name", "left").withColumn(
        "keywords", F.coalesce("keywords", F.array(F.lit(""))))
    year = F.explode(F.array(*[F.lit(y) for y in years]))
    return (terms.select("sector_name", "company_name", F.explode("keywords").alias("keyword"))
                 .withColumn("year", year)
                 .withColumn("query", F.concat_ws(" ", "company_name", "keyword"))
                 .withColumn("date_from", F.make_date("year", F.lit(1), F.lit(1)))
                 .withColumn("date_to", F.make_date("year", F.lit(12), F.lit(31))))


def explode_urls(records: DataFrame, limit: int = 10) -> DataFrame:
    """One row per URL of a search record, the first ``limit`` of each.

    ``count`` repeats how many URLs the record keeps; a record without a company
    is filed under ``Unknown``.
    """
    kept = F.slice(F.col("urls"), 1, limit)
    return records.select(
        F.coalesce("company_name", F.lit("Unknown")).alias("company_name"),
        "sector_keyword",
        F.size(kept).cast("bigint").alias("count"),
        F.posexplode(kept).alias("url_no", "url"),
    ).withColumn("url_no", (F.col("url_no") + 1).cast("bigint"))


def search_records(found: DataFrame, keys: Sequence[str], order: str, url: str,
                   limit: int = 10) -> DataFrame:
    """Gather the first ``limit`` URLs per search into one record.

    The rank limit is applied before the shuffle as well, so each task sends at
    most ``limit`` rows per key however many a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    first = found.select(*keys, order, url, rank.alias("rank")).where(F.col("rank") <= limit)
    urls = F.transform(F.array_sort(F.collect_list(F.struct("rank", url))), lambda r: r[url])
    return first.groupBy(*keys).agg(urls.alias("urls"))


def root_domains(sites: DataFrame, url: str = "url") -> DataFrame:
    """Add the root domain of each URL."""
    return sites.withColumn("root_domain", web.root_domain(F.col(url)))


def name_mismatches(sites: DataFrame, name: str = "company_name",
                    domain: str = "root_domain", run: int = 3) -> DataFrame:
    """Rows whose name and domain share no run of three characters."""
    return sites.where(~tx.shares_run(F.col(name), F.col(domain), run))


def report_family(sector: Column, level: str,
                  energy_sectors: Sequence[str] = wordlists.ENERGY_SECTORS) -> Column:
    """Report that belongs to a sector at level nationwide, provinces or other."""
    energy = sector.isin(*energy_sectors)
    if level == "nationwide":
        return F.when(energy, "nationwideEnergy").otherwise("nationwideUtil")
    if level == "provinces":
        return F.when(energy, "provincesEnergyMap").otherwise("provincesUtilMap")
    return F.lit("sectorSentiment")
