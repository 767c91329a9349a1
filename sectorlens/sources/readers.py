"""Sources: yearly CSV files, JSON maps and records, statistics tables, the retrieval index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.energy import number


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return the table, or fail before any job runs when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")
    return df


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for a scan of fewer input splits than cores.

    Meant for scans ahead of work that is heavy per row.  Large tables have more
    splits than cores and are left alone, so nothing is shuffled there.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes; optionally some columns only.

    Columns are found by header name, so a file may order them otherwise.  Only an
    empty field is null.
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
               .option("escape", '"').option("enforceSchema", False).csv(path))
    return df if columns is None else require_columns(df, columns).select(*columns)


def read_yearly_csv(spark: SparkSession, folder: str, schema: T.StructType,
                    years: Sequence[int] | None = None, pattern: str = "*.csv",
                    columns: Sequence[str] | None = None) -> DataFrame:
    """All years of a table kept as one CSV file per year, with a ``year`` column.

    The year is the first number of four digits in the file name.  Years without
    a file have no rows.
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
               .option("escape", '"').option("pathGlobFilter", pattern).csv(folder))
    year = F.regexp_extract(F.col("_metadata.file_name"), "([0-9]{4})", 1).cast("int")
    df = df.withColumn("year", year)
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    return df if columns is None else df.select(*columns, "year")


def read_yearly_tables(spark: SparkSession, folder: str,
                       years: Sequence[int] | None = None) -> DataFrame:
    """A table written by :func:`writers.write_years`; other years are not opened."""
    df = spark.read.parquet(folder)
    return df if years is None else df.where(F.col("year").isin(list(years)))


def _json_map(spark: SparkSession, path: str, schema: T.MapType) -> DataFrame:
    """Entries of one JSON object in file order: ``ord``, ``key``, ``value``."""
    parsed = F.from_json("value", schema)
    return (spark.read.text(path, wholetext=True)
                 .select(F.posexplode(F.map_entries(parsed)).alias("ord", "e"))
                 .select("ord", F.col("e.key").alias("key"), F.col("e.value").alias("value")))


def read_sector_companies(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """(sector_ord, sector_name, company_name).

    Duplicates inside a sector vanish, unless the list is wanted as it stands,
    as for search terms.
    """
    companies = F.array_distinct("value") if distinct else F.col("value")
    return _json_map(spark, path, schemas.SECTOR_MAP).select(
        F.col("ord").alias("sector_ord"), F.col("key").alias("sector_name"),
        F.explode(companies).alias("company_name"))


def read_sector_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(sector_name, keywords array)."""
    return _json_map(spark, path, schemas.SECTOR_MAP).select(
        F.col("key").alias("sector_name"), F.col("value").alias("keywords"))


def read_company_sites(spark: SparkSession, path: str) -> DataFrame:
    """(company_name, url)."""
    return _json_map(spark, path, schemas.SITE_MAP).select(
        F.col("key").alias("company_name"), F.col("value").alias("url"))


def read_search_records(spark: SparkSession, folder: str) -> DataFrame:
    """Search records of all years, one JSON array per year, with a ``year`` column."""
    df = spark.read.schema(schemas.SEARCH_RECORDS).option("multiLine", True).json(folder)
    return df.withColumn("year", F.regexp_extract(
        F.col("_metadata.file_name"), "([0-9]{4})", 1).cast("int"))


def read_statistics(spark: SparkSession, path: str, label: str, unit: str = "UOM",
                    ref_date: str = "REF_DATE", geo: str = "GEO", value: str = "VALUE",
                    extra: Sequence[str] = ()) -> DataFrame:
    """A monthly statistics CSV as (ref_date, geo, label, uom, value, extra…).

    A month such as ``2016-01`` becomes its first day; symbols in the value
    column become null.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    require_columns(raw, [ref_date, geo, label, unit, value, *extra])
    day = F.concat(F.substring(F.col(f"`{ref_date}`"), 1, 7), F.lit("-01"))
    full = F.when(F.length(F.col(f"`{ref_date}`")) > 7, F.col(f"`{ref_date}`")).otherwise(day)
    return raw.select(
        F.to_date(full).alias("ref_date"), F.col(f"`{geo}`").alias("geo"),
        F.col(f"`{label}`").alias("label"), F.col(f"`{unit}`").alias("uom"),
        number(F.col(f"`{value}`")).alias("value"), *[F.col(f"`{c}`") for c in extra])


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """(geo, latitude, longitude); a byte-order mark before the header does no harm."""
    return spark.read.schema(schemas.COORDINATES).option("header", True).csv(path)


def load_index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, terms, postings) of an index saved by :func:`writers.save_index`."""
    docs, terms, postings = (spark.read.parquet(f"{folder}/{n}")
                             for n in ("docs", "terms", "postings"))
    return docs, terms, postings
