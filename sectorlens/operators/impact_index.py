"""A retrieval index in blocks of documents, searched without scoring what cannot win.

Documents of one leading term lie side by side and are cut into blocks.  A row holds a document's
terms and weights; per block and term the index also holds the largest weight.  The sum of the largest
weights, times those of a question's terms, bounds the score of every document in a block.  Each
question is first scored on its most promising blocks; its n-th score there is a threshold, and of
the other blocks only those are scored whose bound reaches it, and only documents that reach it are
handed on.  With E first blocks of B, about E * size documents a question leave the first pass and
n * B / E the second; E is chosen to make both alike, so they grow with the root of the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, stored
from .joins import is_small, spread_join

# Documents of a block, and questions that are scored on a block in one task at most.
BLOCK, QUESTIONS = 128, 2048
# Question terms, narrow rows, that are sent to every task at most.
BROADCAST_TERMS = 500_000
# Terms of questions that are scored on a block at once.
TERMS_AT_ONCE = 4096


@dataclass(frozen=True)
class ImpactIndex:
    """``rows`` (block, place, key, terms, weights), one per document, and ``tops`` (block, term, top)."""

    rows: DataFrame
    tops: DataFrame
    key: str
    size: int = BLOCK

    @property
    def members(self) -> DataFrame:
        """(block, place, key): where each document lies."""
        return self.rows.select("block", "place", self.key)


def build(postings: DataFrame, key: str, size: int = BLOCK) -> ImpactIndex:
    """Index of postings (key, term, weight), which are read once.  All tables are written down."""
    listed = postings.groupBy(key).agg(F.collect_list(F.struct("weight", "term")).alias("listed"))
    return from_documents(listed, key, size)


def from_documents(listed: DataFrame, key: str, size: int = BLOCK) -> ImpactIndex:
    """Index of documents (key, ``listed``: array<struct<weight,term>>); empty lists are left out.

    One range shuffle lays documents of one leading term side by side.  Numbers within a range
    partition depend on its borders, so they are written down before anything reads them.
    """
    known = listed.where(F.col(key).isNotNull() & (F.size("listed") > 0)).select(
        key, F.array_max("listed")["term"].alias("leading"), F.col("listed.term").alias("terms"),
        F.col("listed.weight").alias("weights"))
    ordered = known.repartitionByRange("leading", key).sortWithinPartitions("leading", key)
    at = F.monotonically_increasing_id()
    rows = stored(ordered.withColumn("at", at).select(
        F.expr(f"at div {size}").alias("block"), F.expr(f"cast(at % {size} AS int)").alias("place"),
        key, "terms", "weights"))
    each = rows.select("block", F.explode(F.arrays_zip("terms", "weights")).alias("p"))
    tops = stored(each.groupBy("block", F.col("p.terms").alias("term")).agg(F.max("p.weights").alias("top")))
    return ImpactIndex(rows, tops, key, size)


def bounds(asked: DataFrame, index: ImpactIndex, query_key: str) -> DataFrame:
    """(question, block, bound): no document of the block scores more.  ``asked`` has (question, term, asked)."""
    tops = index.tops
    if is_small(asked, BROADCAST_TERMS):
        met = tops.join(F.broadcast(asked), "term")
    else:
        met = spread_join(tops, asked, ["term"], "inner", ["block"])
    return met.groupBy(query_key, "block").agg(F.sum(F.col("asked") * F.col("top")).alias("bound"))


def promising(bounded: DataFrame, query_key: str, blocks: int) -> DataFrame:
    """Add ``early``: whether a block is one of the ``blocks`` with the highest bounds of its question."""
    order = Window.partitionBy(query_key).orderBy(F.desc("bound"), "block")
    first = checkpointed(bounded.withColumn("at", F.row_number().over(order)).where(F.col("at") <= blocks)
                         .select(query_key, "block", F.lit(True).alias("early")))
    return bounded.join(F.broadcast(first) if is_small(first) else first, [query_key, "block"], "left") \
                  .withColumn("early", F.coalesce("early", F.lit(False)))


def _block_best(pairs: DataFrame, asked: DataFrame, index: ImpactIndex, query_key: str, n: int, decimals: int
                ) -> DataFrame:
    """(question, key, score): the best documents, ties included, of each question and block.

    Where ``pairs`` has a column ``least``, documents that score less are left out.
    """
    kind, key = asked.schema[query_key].dataType.simpleString(), index.key
    of_key = index.rows.schema[key].dataType.simpleString()
    # In one order everywhere, so that equal documents get equal sums.
    each = F.sort_array(F.collect_list(F.struct("term", "asked")))
    wanted = asked.groupBy(query_key).agg(each.alias("each")).select(
        query_key, F.col("each.term").alias("terms"), F.col("each.asked").alias("asked"))
    wanted = F.broadcast(wanted) if is_small(asked, BROADCAST_TERMS) else wanted
    # The questions of a block are dealt to groups of bounded size.
    counts = pairs.groupBy("block").count().select("block", F.expr(f"cast((count + {QUESTIONS - 1}) div {QUESTIONS} AS int)").alias("parts"))
    parts = checkpointed(counts)
    few = F.broadcast if is_small(parts) else lambda side: side
    least = F.col("least") if "least" in pairs.columns else F.lit(None).cast("double").alias("least")
    dealt = pairs.select(query_key, "block", least).join(few(parts), "block").withColumn(
        "part", F.pmod(F.xxhash64(query_key), F.col("parts")).cast("int"))
    left = dealt.join(wanted, query_key).select("block", "part", query_key, "least", "terms", "asked")
    # The documents' side gets columns of its own, else the two would be taken for one table.
    copies = parts.select(F.col("block").alias("of"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("copy"))
    rows_of = index.rows.join(few(copies), F.col("block") == F.col("of")).select(
        F.col("of").alias("block"), F.col("copy").alias("part"), F.col(key).alias("_key"),
        F.col("terms").alias("terms"), F.col("weights").alias("weights"))

    def run(questions: pa.Table, documents: pa.Table) -> pa.Table:
        asking, found, scores = [], [], []
        if len(questions) and len(documents):
            for i, at, score in _best(questions, documents, n, decimals):
                asking.append(i)
                found.append(at)
                scores.append(score)
        take = pa.array(np.concatenate(asking) if asking else [], pa.int64())
        at = pa.array(np.concatenate(found) if found else [], pa.int64())
        return pa.table({query_key: questions[query_key].take(take), key: documents["_key"].take(at),
                         "score": pa.array(np.concatenate(scores) if scores else [], pa.float64())})

    return left.groupBy("block", "part").cogroup(rows_of.groupBy("block", "part")).applyInArrow(
        run, f"`{query_key}` {kind}, `{key}` {of_key}, score double")


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The lists' values one after the other, and the list that each belongs to."""
    whole = lists.combine_chunks()
    return pc.list_flatten(whole), np.asarray(pc.list_parent_indices(whole))


def _best(questions: pa.Table, documents: pa.Table, n: int, decimals: int):
    """Question rows, document rows and scores of a block, for some questions at a time."""
    theirs, of = _flat(documents["terms"])
    weights = np.asarray(_flat(documents["weights"])[0])
    asked, by = _flat(questions["terms"])
    share = np.asarray(_flat(questions["asked"])[0])
    least = np.asarray(pc.fill_null(questions["least"], -math.inf))
    codes = asked.dictionary_encode()
    row = np.asarray(pc.fill_null(pc.index_in(theirs, value_set=codes.dictionary), -1))
    known = row >= 0
    row, of, weights = row[known], of[known], weights[known]
    # Entries by term, and the asked terms that the block has.
    order = np.argsort(row, kind="stable")
    row, of, weights = row[order], of[order], weights[order]
    present = np.zeros(len(codes.dictionary), bool)
    present[row] = True
    code = np.asarray(codes.indices)
    has = present[code]
    code, by, share = code[has], by[has], share[has]
    begin = 0
    while begin < len(code):
        # Whole questions only.
        end = min(len(code), begin + TERMS_AT_ONCE)
        if end < len(code):
            whole = int(np.searchsorted(by, by[end]))
            end = whole if whole > begin else int(np.searchsorted(by, by[end], "right"))
        own, place = np.unique(code[begin:end], return_inverse=True)
        table = np.zeros((len(own), len(documents)))
        slot = np.full(len(present), -1)
        slot[own] = np.arange(len(own))
        mine = slot[row] >= 0
        table[slot[row[mine]], of[mine]] = weights[mine]
        heads = np.flatnonzero(np.append(True, by[begin + 1:end] != by[begin:end - 1]))
        # Weights are positive, so a document that shares a term has a sum.
        total = np.add.reduceat(table[place] * share[begin:end, None], heads, axis=0)
        found = np.round(total, decimals + 3)
        # The final rounding may make near scores equal.
        floor = least[by[begin:end][heads]] - 10.0 ** -decimals
        if len(documents) > n:
            edge = np.partition(found, len(documents) - n, axis=1)[:, len(documents) - n] - 10.0 ** -decimals
            floor = np.maximum(floor, edge)
        which, at = np.nonzero((total > 0) & (found >= floor[:, None]))
        yield by[begin:end][heads][which], at, total[which, at]
        begin = end


def first_blocks(index: ImpactIndex, n: int) -> int:
    """Blocks a question is first scored on: those of the n best at least, else the root that evens both passes."""
    blocks = index.rows.select("block").distinct().count()
    return max(1 + -(-2 * n // index.size), math.isqrt(n * blocks // index.size))


def search(asked: DataFrame, index: ImpactIndex, query_key: str, n: int = 10, decimals: int = 6) -> DataFrame:
    """The n best documents per question: (question, key, score, rank); later keys first on equal scores.

    ``asked`` has (question, term, asked): the question's weighted terms.  Only documents that share a
    term with a question count.
    """
    asked = checkpointed(asked.select(query_key, "term", "asked"))
    bounded = stored(promising(stored(bounds(asked, index, query_key)), query_key, first_blocks(index, n)))
    first = stored(_ranked(_block_best(bounded.where("early"), asked, index, query_key, n, decimals),
                           index, query_key, n, decimals))
    rest = surviving(bounded, first, query_key, n, decimals)
    later = _block_best(rest, asked, index, query_key, n, decimals)
    both = _ranked(first.drop("rank").unionByName(later), index, query_key, n, decimals)
    return both.withColumn("rank", F.col("rank").cast("bigint"))


def surviving(bounded: DataFrame, first: DataFrame, query_key: str, n: int, decimals: int) -> DataFrame:
    """The later blocks that may hold one of the n best: their bound, rounded up, reaches the n-th score."""
    threshold = first.where(F.col("rank") == n).select(query_key, F.col("score").alias("least"))
    threshold = F.broadcast(threshold) if is_small(threshold) else threshold
    open_blocks = bounded.where("NOT early").join(threshold, query_key, "left")
    return stored(open_blocks.where(
        F.col("least").isNull() | (F.col("bound") + 10.0 ** -decimals >= F.col("least"))).select(query_key, "block", "least"))


def _ranked(found: DataFrame, index: ImpactIndex, query_key: str, n: int, decimals: int) -> DataFrame:
    named = found.select(query_key, index.key, F.round("score", decimals).alias("score"))
    order = Window.partitionBy(query_key).orderBy(F.desc("score"), F.desc(index.key))
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
