"""Sinks: yearly tables, exports, side outputs, the retrieval index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def write_years(df: DataFrame, folder: str) -> None:
    """Replace the years present in the table; other years stay.  Parquet, one folder per year."""
    df.write.partitionBy("year").mode("overwrite") \
      .option("partitionOverwriteMode", "dynamic").parquet(folder)


def write_csv_years(df: DataFrame, folder: str) -> None:
    """The same as CSV with header."""
    df.write.partitionBy("year").mode("overwrite").option("partitionOverwriteMode", "dynamic") \
      .option("header", True).option("escape", '"').csv(folder)


def export_csv(df: DataFrame, folder: str, order: Sequence[str] = ()) -> None:
    """Export as CSV, in order when asked.

    The export is a folder of files whose names follow the order.  It is never
    drawn together into one task.
    """
    if order:
        df = df.orderBy(*order)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def export_json(df: DataFrame, folder: str) -> None:
    """Export as JSON records, one per line."""
    df.write.mode("overwrite").json(folder)


def export_sites(sites: DataFrame, folder: str) -> None:
    """Export ``{company: [url, root domain]}`` entries, one object per line."""
    entry = F.create_map("company_name", F.array("url", "root_domain"))
    sites.select(F.to_json(entry).alias("value")).write.mode("overwrite").text(folder)


def write_with_side_output(df: DataFrame, flagged: Column, folder: str, side_folder: str,
                           side_columns: Sequence[str]) -> None:
    """Write all rows and, next to them, some columns of the flagged ones.

    The side output is read back from the first one, so that ``df`` is computed once.
    """
    df.write.mode("overwrite").parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    written.where(flagged).select(*side_columns).write.mode("overwrite").parquet(side_folder)


def save_index(docs: DataFrame, terms: DataFrame, postings: DataFrame, folder: str) -> None:
    """Save a retrieval index as three Parquet tables.

    Postings are range-partitioned and sorted by term and document: a look-up of
    some terms skips most files, and a hot term spans several of them.
    """
    # Written down before the range sort, whose sampling would compute them once more.
    terms, postings = checkpointed(terms), checkpointed(postings)
    key = [c for c in postings.columns if c not in ("term", "tf", "weight")]
    docs.write.mode("overwrite").parquet(f"{folder}/docs")
    terms.repartitionByRange("term").sortWithinPartitions("term") \
         .write.mode("overwrite").parquet(f"{folder}/terms")
    postings.repartitionByRange("term", *key).sortWithinPartitions("term", *key) \
            .write.mode("overwrite").parquet(f"{folder}/postings")
