"""A corpus from raw documents to packed sequences, in stages that each call one operator.

On a cluster the package travels with the job (``--py-files``); every stage works on all that the
stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorlens.llm import jaccard, packing, secrets, suffixes, toxicity
from sectorlens.llm.queries import finding_label
from sectorlens.llm.stages import free_names, let_go, scratch, small_batches, stored
from sectorlens.operators.joins import is_small

TOXIC = 0.7
# Ids, of eight bytes each, that are sent to every task at most.
BROADCAST_IDS = 200_000


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` again after a change of the texts."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def _identified(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """Rows without an id get ids beyond all others, marked by a column; most tables have none."""
    if not docs.where("doc_id IS NULL").head(1):
        return docs, None
    mark, = free_names(docs, "nameless")
    most = docs.agg(F.coalesce(F.greatest(F.max("doc_id"), F.lit(0)), F.lit(0))).first()[0]
    named = F.coalesce("doc_id", F.lit(most + 1) + F.monotonically_increasing_id())
    return stored(docs.withColumn(mark, F.col("doc_id").isNull()).withColumn("doc_id", named)), mark


def _anonymous(docs: DataFrame, mark: str | None) -> DataFrame:
    """The ids as they were before :func:`_identified`."""
    return docs if mark is None else docs.withColumn("doc_id", F.when(~F.col(mark), F.col("doc_id"))).drop(mark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic score stay."""
    small_batches(spark)
    let_go(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    carried = tuple(c for c in docs.columns if c != "doc_id")
    scores = toxicity.scored(docs.withColumnRenamed("score", "_score"), model, spans=False,
                             keep=tuple("_score" if c == "score" else c for c in carried))
    kept = scores.where(F.col("score") < TOXIC).drop("score").withColumnRenamed("_score", "score")
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id stays of each group, at five words and a similarity of 0.8.

    Documents without words stay.  Those without an id come after all others and are told apart;
    equal rows with one id count once.
    """
    small_batches(spark)
    let_go(spark)
    docs, mark = _identified(docs)
    with scratch(spark) as keep:
        groups = jaccard.joined(docs, size=5, percent=80)
        losers = keep(groups.where("doc_id <> component_id").select("doc_id").distinct())
    if docs.groupBy("doc_id").count().where("count > 1").head(1):
        docs = docs.dropDuplicates(["doc_id", "text"])
    losers = F.broadcast(losers) if is_small(losers, BROADCAST_IDS) else losers
    return _anonymous(docs.join(losers, "doc_id", "left_anti").select(*docs.columns), mark)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the first document that has them."""
    small_batches(spark)
    let_go(spark)
    docs, mark = _identified(docs)
    with scratch(spark) as keep:
        found = keep(suffixes.matches(docs))
    return _counted(_anonymous(suffixes.cut(docs, found), mark))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay."""
    small_batches(spark)
    let_go(spark)
    docs, mark = _identified(docs)
    with scratch(spark) as keep:
        found = keep(secrets.scanned(docs, finding_label()))
    return _counted(_anonymous(secrets.masked(docs, found), mark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of whole sequences with their ids, one document each."""
    small_batches(spark)
    let_go(spark)
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

# Learned scores and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written down before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
