"""A term index on disk that grows by segments.

A segment holds the postings and document frequencies of the documents that one call added, both
in buckets by the terms' hash, or the keys that a call deleted with their frequencies counted
negatively.  Nothing written is changed: a new version of the manifest, one row per segment, makes a
segment visible, so readers see either state.  Frequencies are sums over segments.  ``compact`` writes
all live postings as one segment.  Look-ups read only the buckets of the wanted terms.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wordlists
from ..operators.joins import is_small
from ..operators.retrieval import term_frequencies

BUCKETS = 32
_MANIFEST = "version long, segment long, documents long, deletes boolean"


class TermIndex:
    """The index in a folder that all executors share; ``key`` is the documents' key column.

    A key may be added again after it was deleted.  Calls that change one index must not overlap.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str = "doc_id", buckets: int = BUCKETS,
                 stop_words: Sequence[str] = wordlists.STOP_WORDS_EN):
        self.spark, self.folder, self.key, self.buckets, self.stop_words = spark, folder, key, buckets, stop_words

    @classmethod
    def create(cls, spark: SparkSession, folder: str, **options) -> "TermIndex":
        """An empty index in a new folder."""
        index = cls(spark, folder, **options)
        spark.createDataFrame([(0, None, 0, False)], _MANIFEST).write.parquet(f"{folder}/manifest/version=0")
        return index

    def segments(self) -> list:
        """The rows of the latest manifest by segment number."""
        manifest = self.spark.read.parquet(f"{self.folder}/manifest")
        rows = manifest.where(F.col("version") == self._version()).collect()
        return sorted((r for r in rows if r["segment"] is not None), key=lambda r: r["segment"])

    def _version(self) -> int:
        return self.spark.read.parquet(f"{self.folder}/manifest").agg(F.max("version")).first()[0]

    def _publish(self, rows: list[tuple]) -> None:
        version = self._version() + 1
        listing = [(version, *row) for row in rows] or [(version, None, 0, False)]
        self.spark.createDataFrame(listing, _MANIFEST).drop("version").coalesce(1) \
            .write.parquet(f"{self.folder}/manifest/version={version}")

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _place(self, segment: int, name: str) -> str:
        return f"{self.folder}/segment-{segment}/{name}"

    def _write(self, df: DataFrame, segment: int, name: str) -> None:
        """Several files per bucket where a bucket is large, one row group after another by term."""
        df.withColumn("bucket", self._bucket(F.col("term"))).repartition("bucket", "term") \
          .sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(self._place(segment, name))

    def _next(self) -> int:
        return self._version() + 1

    def add(self, docs: DataFrame, text: str = "text") -> int:
        """Add documents whose keys are not in the index; returns the number of the new segment."""
        segment = self._next()
        self._write(term_frequencies(docs, self.key, text, self.stop_words).withColumn("tf", F.col("tf").cast("long")),
                    segment, "postings")
        docs.select(self.key).write.parquet(self._place(segment, "docs"))
        self._count(segment, self._read(segment, "postings"), 1)
        count = self._read(segment, "docs").count()
        self._publish([(r["segment"], r["documents"], r["deletes"]) for r in self.segments()] + [(segment, count, False)])
        return segment

    def _count(self, segment: int, postings: DataFrame, sign: int) -> None:
        self._write(postings.groupBy("term").agg((sign * F.count(F.lit(1))).alias("df")), segment, "frequencies")

    def _read(self, segment: int, name: str) -> DataFrame:
        """A table of a segment; documents without terms leave folders without files."""
        if name == "docs" or name == "gone":
            return self.spark.read.parquet(self._place(segment, name))
        kind = "df long" if name == "frequencies" else \
            f"`{self.key}` {self._read(segment, 'docs').schema[self.key].dataType.simpleString()}, tf long"
        return self.spark.read.schema(f"{kind}, term string, bucket int").parquet(self._place(segment, name))

    def _union(self, parts: list[DataFrame]) -> DataFrame | None:
        return functools.reduce(DataFrame.unionByName, parts) if parts else None

    def _gone(self) -> DataFrame | None:
        """(key, gone): the keys deleted by each segment."""
        return self._union([self._read(r["segment"], "gone").withColumn(
            "gone", F.lit(r["segment"])) for r in self.segments() if r["deletes"]])

    def live(self, name: str = "postings") -> DataFrame | None:
        """Rows of all segments but those of deleted documents; None for an empty index."""
        rows = self._union([self._read(r["segment"], name).withColumn(
            "segment", F.lit(r["segment"])) for r in self.segments() if not r["deletes"]])
        gone = self._gone()
        if rows is None or gone is None:
            return rows
        last = gone.groupBy(F.col(self.key).alias("_gone_key")).agg(F.max("gone").alias("gone"))
        last = F.broadcast(last) if is_small(last) else last
        return rows.join(last, (F.col(self.key) == F.col("_gone_key")) & (F.col("segment") < F.col("gone")), "left_anti")

    def delete(self, keys: DataFrame) -> int:
        """Delete documents by key; unknown keys do no harm."""
        segment = self._next()
        there = self.live("docs")
        known = keys.select(self.key).distinct()
        known = known.where(F.lit(False)) if there is None else known.join(there.select(self.key), self.key, "left_semi")
        known.write.parquet(self._place(segment, "gone"))
        known = self._read(segment, "gone")
        count = known.count()
        postings = self.live()
        if postings is not None:
            small = F.broadcast(known) if is_small(known) else known
            self._count(segment, postings.join(small, self.key, "left_semi"), -1)
        self._publish([(r["segment"], r["documents"], r["deletes"]) for r in self.segments()] + [(segment, -count, True)])
        return segment

    def compact(self) -> None:
        """Write everything alive as one segment; files of older ones stay for readers that use them."""
        postings, docs = self.live(), self.live("docs")
        if postings is None:
            return
        segment = self._next()
        self._write(postings.select(self.key, "term", "tf"), segment, "postings")
        docs.select(self.key).write.parquet(self._place(segment, "docs"))
        self._count(segment, self._read(segment, "postings"), 1)
        count = self._read(segment, "docs").count()
        self._publish([(segment, count, False)])

    def _wanted(self, rows: DataFrame, terms: DataFrame | None) -> DataFrame:
        """Rows of the wanted terms; only their buckets, few numbers, reach the scan."""
        if terms is None:
            return rows
        terms = terms.select("term").distinct()
        chosen = [r["b"] for r in terms.select(self._bucket(F.col("term")).alias("b")).distinct().collect()]
        wanted = F.broadcast(terms) if is_small(terms) else terms
        return rows.where(F.col("bucket").isin(chosen)).join(wanted, "term", "left_semi")

    def vocabulary(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, df, idf) of all terms or of the wanted ones, over all segments."""
        listed = self.segments()
        rows = self._union([self._read(r["segment"], "frequencies") for r in listed])
        size = sum(r["documents"] for r in listed)
        summed = self._wanted(rows, terms).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        return summed.withColumn("idf", F.log(F.lit(1.0 + size) / (F.lit(1) + F.col("df"))) + 1)

    def refresh(self) -> None:
        """Work out the documents' lengths again, which every change of the frequencies changes."""
        weights = self.live().join(self.vocabulary().select("term", "idf"), "term")
        lengths = weights.groupBy(self.key).agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("length"))
        lengths.write.mode("overwrite").parquet(f"{self.folder}/lengths-{self._version()}")

    def postings(self, terms: DataFrame | None = None) -> DataFrame:
        """(key, term, tf, weight) as :func:`retrieval.build_index` gives them, after :meth:`refresh`."""
        lengths = self.spark.read.parquet(f"{self.folder}/lengths-{self._version()}")
        rows = self._wanted(self.live(), terms).select(self.key, "term", "tf")
        known = self.vocabulary(terms).select("term", "idf")
        known = F.broadcast(known) if is_small(known) else known
        return rows.join(known, "term").join(lengths, self.key).select(
            self.key, "term", "tf", (F.col("tf") * F.col("idf") / F.col("length")).alias("weight"))
