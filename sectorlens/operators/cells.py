"""Exact nearest vectors through cells: a centre and a radius rule out whole cells.

Unit vectors are given to the nearest of at most ``CELLS`` centres, fitted on a bounded sample.  A
question first meets the nearest cells that hold n vectors; its n-th score there is a bound.  By
the triangle inequality a cell whose centre is further away than that bound and the cell's radius
holds nothing better, so the question only meets the others, whatever the centres are like.

Vectors and questions meet in a shuffle by (cell, part, share): large cells have several parts,
cells that many questions want have several shares of questions.  A task holds one part and lets
the questions pass by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, stored

# Centres at most; vectors per part; questions per share; sample per centre.
CELLS, PART_ROWS, SHARE_ROWS, SAMPLE_PER_CELL = 1024, 50_000, 250_000, 16
SCORES = "query_id long, vec_id long, score double"
NO_CELL = -1


def unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one; zero vectors stay zero."""
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def best(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int,
         decimals: int) -> pd.DataFrame:
    """The n best ids per question row of a score matrix; the smaller id wins ties."""
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], np.round(scores[:, order], decimals)
    if scores.shape[1] > 4 * n:
        # Only what reaches the n-th score of its row is sorted.
        edge = np.partition(scores, -n, axis=1)[:, -n:].min(axis=1, keepdims=True)
        most = int((scores >= edge).sum(axis=1).max())
        near = np.argsort(np.where(scores >= edge, 0, 1), axis=1, kind="stable")[:, :most]
        values = np.take_along_axis(scores, near, axis=1)
        top = np.take_along_axis(near, np.argsort(-values, axis=1, kind="stable"), axis=1)[:, :n]
    else:
        top = np.argsort(-scores, axis=1, kind="stable")[:, :n]
    return pd.DataFrame({"query_id": np.repeat(query_ids, top.shape[1]),
                         "vec_id": ids[top].reshape(-1),
                         "score": np.take_along_axis(scores, top, axis=1).reshape(-1)})


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (vectors ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1) - 2 * vectors @ centres.T
    return np.sqrt(np.maximum(squares, 0))


def fit(sample: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Centres by Lloyd's algorithm on a sample of unit vectors."""
    centres = sample[np.random.default_rng(5).permutation(len(sample))[:count]]
    for _ in range(rounds):
        own = _distances(sample, centres).argmin(axis=1)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Cells:
    """Centres with the radius and the number of vectors of each cell."""

    centres: np.ndarray
    radii: np.ndarray
    rows: np.ndarray

    def first(self, asked: np.ndarray, n: int) -> list[list[int]]:
        """The nearest cells that hold n vectors together, per question."""
        if not self.rows.any():
            return [[] for _ in asked]
        near = np.argsort(_distances(asked, self.centres), axis=1, kind="stable")
        enough = np.cumsum(self.rows[near], axis=1) >= n
        many = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, near.shape[1])
        return [[int(c) for c in row[:k] if self.rows[c]] for row, k in zip(near, many)]

    def open(self, asked: np.ndarray, score: np.ndarray, decimals: int) -> np.ndarray:
        """Whether a cell may hold a vector whose rounded score reaches the given one.

        The slack covers the rounding of scores and of distances.
        """
        if not self.rows.any():
            return np.zeros((len(asked), 0), bool)
        reach = np.sqrt(np.maximum(2 - 2 * (score - 10.0 ** -decimals), 0)) + 1e-6
        return (_distances(asked, self.centres) - self.radii <= reach[:, None]) & (self.rows > 0)


@dataclass(frozen=True)
class Found:
    """``rows``: the n nearest per question.  ``work``: per question the vectors it was compared with."""

    rows: DataFrame
    work: DataFrame


def _assigned(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """Vectors with their cell, the distance from its centre and a running number."""
    shared = corpus.sparkSession.sparkContext.broadcast(centres)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for frame in frames:
            if not len(frame):
                continue
            vectors = unit(frame["embedding"])
            away = _distances(vectors, shared.value)
            cell = np.where(vectors.any(axis=1), away.argmin(axis=1), NO_CELL)
            yield frame.assign(cell=cell.astype(np.int32), away=away.min(axis=1),
                               place=np.arange(seen, seen + len(frame)))
            seen += len(frame)

    kind = corpus.schema["embedding"].dataType.simpleString()
    return corpus.mapInPandas(run, f"vec_id long, embedding {kind}, cell int, away double, place long")


def _numbers(count: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), count - 1)


def _compared(asked: DataFrame, placed: DataFrame, cells: Cells, n: int, decimals: int) -> DataFrame:
    """The n best of every (question, cell part); ``asked`` has one row per question and cell."""
    spark = asked.sparkSession
    wanted = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    # At most CELLS rows.
    split = F.broadcast(spark.createDataFrame(
        [(int(c), -(-int(cells.rows[c]) // PART_ROWS), -(-k // SHARE_ROWS)) for c, k in wanted.items()],
        "cell int, parts long, shares long"))
    left = placed.join(split, "cell").select(
        "cell", F.pmod("place", "parts").alias("part"), F.explode(_numbers(F.col("shares"))).alias("share"),
        F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "embedding")
    right = asked.join(split, "cell").select(
        "cell", F.pmod(F.xxhash64("query_id"), "shares").alias("share"),
        F.explode(_numbers(F.col("parts"))).alias("part"),
        F.lit(1).alias("kind"), F.col("query_id").alias("id"), "embedding")
    block = ["cell", "part", "share"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ids, held = None, [], []
        for frame in frames:
            for key, rows in frame.groupby(block, sort=False):
                if key != current:
                    current, ids, held = key, [], []
                vectors, questions = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
                if len(vectors):
                    ids.append(vectors["id"].to_numpy())
                    held.append(unit(vectors["embedding"]))
                if not len(questions) or not held:
                    continue
                if len(held) > 1:
                    ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                for at in range(0, len(questions), 256):
                    some = questions.iloc[at:at + 256]
                    yield best(some["id"].to_numpy(), ids[0], unit(some["embedding"]) @ held[0].T, n, decimals)

    # Vectors of a part stand before the questions.
    return left.unionByName(right).repartition(*block).sortWithinPartitions(*block, "kind") \
               .mapInPandas(run, SCORES)


def top(scores: DataFrame, n: int) -> DataFrame:
    """The n best rows per question with their rank; the smaller id wins ties."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def _equal_scores(questions: DataFrame, ids: list[int]) -> DataFrame:
    return questions.select("query_id", F.explode(F.array(*map(F.lit, ids)).cast("array<bigint>")).alias("vec_id"),
                            F.lit(0.0).alias("score"))


def nearest(corpus: DataFrame, questions: DataFrame, n: int = 10, decimals: int = 6,
            max_cells: int = CELLS) -> Found:
    """The n corpus vectors of greatest cosine per question vector, exactly.

    ``corpus`` has (vec_id, embedding), ``questions`` (query_id, embedding); rows without a vector
    have no match.  A zero vector scores 0 with every other: of those only the n smallest ids can
    be found, and they are added without being compared.
    """
    corpus = corpus.where(F.col("embedding").isNotNull()).select("vec_id", "embedding")
    questions = questions.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
    zero = F.forall("embedding", lambda x: x == 0)
    total = corpus.count()
    count = int(min(max_cells, max(1, total ** 0.5)))
    # Bounded by the number of centres, whatever the table.
    share = min(1.0, SAMPLE_PER_CELL * count / max(total, 1))
    sample = corpus.where(~zero).sample(share, seed=5).limit(2 * SAMPLE_PER_CELL * count).toPandas()
    centres = fit(unit(sample["embedding"]), count) if len(sample) else np.zeros((0, 1))
    if not len(centres):
        # Nothing sampled: the first vector, if there is one, is the only centre.
        head = corpus.where(~zero).limit(1).toPandas()
        centres = unit(head["embedding"]) if len(head) else np.zeros((1, 1))
        if not len(head):
            corpus = corpus.withColumn("cell", F.lit(NO_CELL)).withColumn("away", F.lit(0.0)) \
                           .withColumn("place", F.lit(0).cast("bigint"))
    placed = stored(corpus if "cell" in corpus.columns else _assigned(corpus, centres))
    shape = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).collect()}
    cells = Cells(centres, *(np.array([shape[c][name] if c in shape else 0 for c in range(len(centres))])
                             for name in ("away", "n")))
    smallest = [r["vec_id"] for r in placed.orderBy("vec_id").limit(n).collect()]
    zeros = [r["vec_id"] for r in placed.where(F.col("cell") == NO_CELL).orderBy("vec_id").limit(n).collect()]

    shared = questions.sparkSession.sparkContext.broadcast(cells)
    kind = questions.schema["embedding"].dataType.simpleString()

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(home=shared.value.first(unit(frame["embedding"]), n))

    def go_on(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            open_cells = shared.value.open(
                unit(frame["embedding"]), frame["bound"].fillna(-1.0).to_numpy(), decimals)
            more = [sorted(set(np.flatnonzero(o).tolist()) - set(h)) for o, h in zip(open_cells, frame["home"])]
            met = [int(shared.value.rows[[*h, *m]].sum()) for h, m in zip(frame["home"], more)]
            yield frame[["query_id", "embedding"]].assign(more=more, compared=met)

    asked = stored(questions.where(~zero).mapInPandas(
        begin, f"query_id long, embedding {kind}, home array<int>"))
    first = checkpointed(top(_compared(
        asked.select("query_id", "embedding", F.explode("home").alias("cell")), placed, cells, n, decimals), n))
    bounds = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == n, F.min("score")).otherwise(F.lit(-1.0)).alias("bound"))
    second = stored(asked.join(bounds, "query_id", "left").select("query_id", "embedding", "home", "bound").mapInPandas(
        go_on, f"query_id long, embedding {kind}, more array<int>, compared long"))
    rest = _compared(second.select("query_id", "embedding", F.explode("more").alias("cell")),
                     placed, cells, n, decimals)
    scores = first.drop("rank").unionByName(rest) \
        .unionByName(_equal_scores(asked, zeros)) \
        .unionByName(_equal_scores(questions.where(zero), smallest))
    return Found(top(scores, n), second.select("query_id", "compared"))
