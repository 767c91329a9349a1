"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame functions only.  A candidate is a long run of letters, digits and a few signs.  Its
features are its length and alphabet, its character transitions (changes of kind, and how likely
its letters follow each other in the words of all documents), the share that dictionary words
cover, the path of its document and the words next to it.  Words and paths count by their log odds
in one half of the labelled findings; the forest learns from the other half.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import is_small
from .stages import free_names, stored

CANDIDATE = "[A-Za-z0-9_+/=-]{16,}"
CONTEXT = 60
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789_"
# Documents a dictionary word stands in at least, labelled findings learned from at most, trees.
LEAST_DOCUMENTS, LABELLED, TREES, DEPTH = 3, 50_000, 20, 6
# Rows and bytes up to which a side with one row per key goes to every task.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16_000_000
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def candidates(docs: DataFrame, id_column: str = "doc_id", path: str = "source",
               text: str = "text") -> DataFrame:
    """One row per candidate: ``row`` (its document's row), the id, ``path``, ``nth`` in the text
    (from 0), ``gap`` (characters since the one before), ``candidate``, ``before`` and ``after``."""
    found = docs.where(F.col(text).rlike(CANDIDATE)).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(1)).alias("c"),
        F.split(text, CANDIDATE).alias("p"))
    rows = F.transform("c", lambda c, i: F.struct(
        i.alias("nth"), F.length(F.get("p", i)).alias("gap"), c.alias("candidate"),
        F.right(F.get("p", i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("p", i + 1), F.lit(CONTEXT)).alias("after")))
    return found.select("row", "doc_id", "path", F.inline(rows))


def dictionary(docs: DataFrame, text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Words of three letters a-z and more, with the number of texts they stand in: ``word``, ``n``."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z]+"))
    return docs.select(F.explode(words).alias("word")).where(F.length("word") >= 3) \
               .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def transitions(words: DataFrame) -> list[float]:
    """Logarithms of how often each character follows each other in words: one per ordered pair of
    ``ALPHABET``, a table of fixed size.  Pairs never seen count as seen once."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    pairs = words.select("word", "n", at.alias("i")).groupBy(F.substring("word", F.col("i"), F.lit(2)).alias("pair")) \
                 .agg(F.sum("n").alias("n")).collect()
    counts = {r["pair"]: r["n"] for r in pairs}
    size, table = len(ALPHABET), []
    for a in ALPHABET:
        total = sum(counts.get(a + b, 0) for b in ALPHABET) + size
        table += [math.log((counts.get(a + b, 0) + 1) / total) for b in ALPHABET]
    return table


def _likelihood(value: Column, table: list[float]) -> Column:
    """Mean logarithm over the character pairs of a candidate."""
    size = len(ALPHABET)
    lower = F.lower(value)

    def place(at: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(lower, at, F.lit(1))) - 1

    worst = min(table)
    scores = F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.coalesce(F.when(
        (place(i) >= 0) & (place(i + 1) >= 0), F.get(F.lit(table), place(i) * size + place(i + 1))), F.lit(worst)))
    return F.aggregate(scores, F.lit(0.0), lambda a, b: a + b) / (F.length(value) - 1)


def _kinds(value: Column) -> Column:
    return F.translate(value, _LOWER + _UPPER + _DIGIT, "a" * 26 + "A" * 26 + "0" * 10)


def _side(df: DataFrame) -> DataFrame:
    df = stored(df)
    size = F.sum(F.length(F.to_json(F.struct("*"))))
    fits = is_small(df, BROADCAST_ROWS) and (df.agg(size).first()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def _coverage(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Share of each distinct candidate that its letter runs in the dictionary cover."""
    distinct = stored(rows.select("candidate").distinct())
    runs = distinct.select("candidate", F.explode(F.regexp_extract_all(
        F.lower("candidate"), F.lit("([a-z]{3,})"), F.lit(1))).alias("word"))
    known = runs.join(_side(words.select("word")), "word", "left_semi")
    return known.groupBy("candidate").agg(
        (F.sum(F.length("word")) / F.first(F.length("candidate"))).alias("coverage"))


FEATURES = ("size", "digits", "uppers", "distinct", "changes", "likelihood", "coverage", "path_odds",
            "before_odds", "after_odds")


def _features(rows: DataFrame, words: DataFrame, table: list[float]) -> DataFrame:
    value, kinds = F.col("candidate"), _kinds(F.col("candidate"))
    plain = rows.select(
        "*", F.length(value).cast("double").alias("size"),
        ((F.length(value) - F.length(F.translate(value, _DIGIT, ""))) / F.length(value)).alias("digits"),
        ((F.length(value) - F.length(F.translate(value, _UPPER, ""))) / F.length(value)).alias("uppers"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
        (F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) / F.length(value)).alias("changes"),
        _likelihood(value, table).alias("likelihood"),
        F.lower(F.regexp_extract("before", r"([^\s]+)\s*[^\sA-Za-z0-9]*\s*[^\sA-Za-z0-9]*$", 1)).alias("word_before"),
        F.lower(F.regexp_extract("after", r"^([^\s]*\s*[^\s]*)", 1)).alias("word_after"))
    return plain.join(_side(_coverage(rows, words)), "candidate", "left").fillna({"coverage": 0.0})


def _odds(labelled: DataFrame, column: str, name: str) -> DataFrame:
    """Log odds of label 1 by a value, drawn towards even odds by two findings."""
    positive = F.sum(F.col("label") * F.col("weight"))
    return labelled.groupBy(column).agg(
        F.log((positive + 1) / (F.sum("weight") - positive + 1)).alias(name))


def _sample(known: DataFrame, labelled: int) -> DataFrame:
    """About ``labelled`` labelled rows, chosen by hash in each class for itself: of the rarer class
    half of them or all, the rest of the other.  ``weight`` is how many each stands for, ``half`` is
    0 for those the forest learns from, which has every class there is, and 1 for the others."""
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rarer = min(min(counts.values(), default=0), labelled // 2)
    share = {k: min(1.0, (rarer if n == min(counts.values()) else labelled - rarer) / n) for k, n in counts.items()}
    of = F.lit(1.0)
    for label, value in share.items():
        of = F.when(F.col("label") == label, F.lit(value)).otherwise(of)
    place = F.pmod(F.xxhash64("candidate", "doc_id", "nth"), F.lit(1 << 52))
    chosen = known.withColumn("place", place).where(F.col("place") < of * float(1 << 52)) \
                  .withColumn("weight", 1 / of)
    # Bounded by the sample's size.
    order = Window.partitionBy("label").orderBy("place", "doc_id", "nth", "row")
    return chosen.withColumn("half", (F.row_number().over(order) - 1) % 2)


def _with_odds(df: DataFrame, sides: list[tuple[str, str, DataFrame]]) -> DataFrame:
    for column, name, side in sides:
        df = df.join(side, column, "left")
    return df.fillna({name: 0.0 for _, name, _ in sides})


def scanned(docs: DataFrame, label: Column, id_column: str = "doc_id", path: str = "source",
            text: str = "text", labelled: int = LABELLED) -> DataFrame:
    """Score every candidate of whole texts.

    ``label`` is evaluated on the rows of :func:`candidates`: 1 or 0 for a labelled finding, null
    for all others.  About ``labelled`` of them at most, chosen by hash in each class, are learned from;
    the forest scores all candidates, labelled ones too.  Result: ``row``, ``doc_id``, ``nth``,
    ``start`` (characters before it), ``candidate`` and ``score`` (0 to 1).  If the labels are not of both kinds, labelled findings score their label and others
    1 if they mix digits with letters that dictionary words do not cover, else 0.
    Null and empty texts have no candidates; repeated rows are scanned each; other columns are
    ignored.
    """
    rows = stored(candidates(docs, id_column, path, text).withColumn("label", label.cast("int")))
    words = stored(dictionary(docs, text))
    full = stored(_features(rows, words, transitions(words)))
    sample = stored(_sample(full.where("label IS NOT NULL"), labelled))
    first, second = sample.where("half = 1"), sample.where("half = 0")
    sides = [(c, n, _side(_odds(first, c, n))) for c, n in (
        ("path", "path_odds"), ("word_before", "before_odds"), ("word_after", "after_odds"))]
    learned = stored(_with_odds(second, sides).select("label", "weight", *FEATURES))
    kinds = [r["label"] for r in learned.select("label").distinct().collect()]
    ready = _with_odds(full, sides)
    if len(kinds) == 2:
        scored = _forest(learned).transform(_assembled(ready)).withColumn(
            "score", F.get(vector_to_array("probability"), F.lit(1)))
    else:
        mixed = F.col("digits").between(0.05, 0.95) & (F.col("coverage") < 0.5) \
            & (F.col("distinct") * F.col("size") >= 8)
        scored = ready.withColumn("score", F.coalesce("label", mixed.cast("int")).cast("double"))
    # The candidates of a text in order: the lengths before one give its place.
    order = Window.partitionBy("row").orderBy("nth")
    size = F.length("candidate")
    return scored.select("row", "doc_id", "nth", "candidate", "score",
                         (F.sum(F.col("gap") + size).over(order) - size).alias("start"))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def _forest(learned: DataFrame) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, labelCol="label",
                                    featuresCol="features", weightCol="weight", subsamplingRate=0.8)
    return forest.fit(_assembled(learned.withColumn("label", F.col("label").cast("double"))))


def masked(docs: DataFrame, findings: DataFrame, id_column: str = "doc_id", threshold: float = 0.5,
           text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every found candidate of at least this score replaced by ``mask``.

    ``findings`` come from :func:`scanned` on the same documents.  A text's candidates are found
    again by the id and compared as strings, so of several rows with one id each loses its own.
    All columns and rows are kept; rows without an id are not masked.
    """
    name, secrets, between, candidates_ = free_names(docs, "id", "secrets", "between", "candidates")
    chosen = findings.where(F.col("score") >= threshold).groupBy(F.col("doc_id").alias(name)).agg(
        F.collect_set("candidate").alias(secrets))
    some = F.col(secrets).isNotNull()
    marked = docs.join(_side(chosen), F.col(id_column) == F.col(name), "left").select(
        *docs.columns, secrets, F.when(some, F.split(text, CANDIDATE)).alias(between),
        F.when(some, F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(1))).alias(candidates_))
    parts = F.transform(between, lambda p, i: F.concat(p, F.coalesce(F.when(
        F.array_contains(secrets, F.get(candidates_, i)), F.lit(mask)).otherwise(F.get(candidates_, i)), F.lit(""))))
    clean = F.when(~some, F.col(text)).otherwise(F.array_join(parts, ""))
    return marked.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])
