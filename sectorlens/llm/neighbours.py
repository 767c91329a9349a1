"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by rotations that are learned on a bounded sample (principal axes,
turned so that signs lose little).  A code is split into bytes, and each byte has an index.  A
code within Hamming distance r of the query's must come close in one byte at least (pigeonhole):
probing the close values of every byte finds every code within r, and these are compared as
floats.  r is learned too, as what covers nearly all true neighbours within the sample, whose
neighbours are farther than those in the whole table.

The table is dealt by id; a task indexes its rows block by block and keeps ten candidates per
query.  Queries are sent to the tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stages import stored

# Rows on which rotations and radius are learned, rows per index, queries sent out at once.
SAMPLE, INDEX_ROWS, QUERY_BLOCK = 8000, 8192, 4096
ROTATIONS, COVERED = 2, 0.98
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)
_APART = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None]]


@dataclass
class Coder:
    """Learned rotations; ``codes`` gives one row of bytes per vector."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits((vectors - self.mean) @ self.axes > 0, axis=1)


def learned(sample: np.ndarray, neighbours: int = 10, seed: int = 0) -> Coder:
    """Fit rotations and radius; ``sample`` has a vector per row."""
    dims = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, basis = np.linalg.eigh(centred.T @ centred)
    flat, rng, axes = centred @ basis, np.random.default_rng(seed), []
    for _ in range(ROTATIONS):
        turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(25):
            u, _, v = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (u @ v).T
        axes.append(basis @ turn)
    coder = Coder(mean, np.concatenate(axes, axis=1), 0)
    asked = rng.choice(len(sample), min(200, len(sample)), replace=False)
    codes, found = coder.codes(sample), []
    for at in asked:
        far = ((sample - sample[at]) ** 2).sum(axis=1)
        far[at] = np.inf
        close = np.argsort(far, kind="stable")[:min(neighbours, len(sample) - 1)]
        found.append(_BITS[codes[close] ^ codes[at]].sum(axis=1))
    apart = np.concatenate(found) if found else np.zeros(0)
    coder.radius = int(np.quantile(apart, COVERED)) if len(apart) else 8 * codes.shape[1]
    return coder


class Index:
    """Codes of some rows, with the rows sorted by the value of each byte."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(column, kind="stable") for column in codes.T]
        self.counts = [np.bincount(column, minlength=256) for column in codes.T]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is at most ``radius`` bits from ``code``."""
        parts = len(code)
        if radius >= 8 * parts:
            return np.arange(len(self.codes))
        near, rest = divmod(radius, parts)
        hit = np.zeros(len(self.codes), bool)
        for part, value in enumerate(code):
            # With radius = parts * near + rest, one of the first rest + 1 bytes differs in
            # at most ``near`` bits, or one of the others in fewer.
            limit = near if part <= rest else near - 1
            if limit >= 0:
                hit[self.order[part][np.repeat(_APART[value] <= limit, self.counts[part])]] = True
        rows = np.flatnonzero(hit)
        return rows[_BITS[self.codes[rows] ^ code].sum(axis=1) <= radius]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dims)


def nearest(vectors: DataFrame, asked: Column, id_column: str = "vec_id", vector: str = "embedding",
            n: int = 10, sample: int = SAMPLE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``n`` nearest found rows, by Euclidean distance, of every row where ``asked`` holds.

    Result: ``query_id``, ``rank`` from 1, the id and ``score``, the distance in double precision;
    ties go to the smaller id.  A query with fewer than ``n`` codes in reach is compared with all
    rows.  Ids or vectors that are null, zero vectors, those with a null or non-finite component
    and those of another length than the most frequent take no part.  A repeated id counts once,
    with the smallest of its vectors; other columns are ignored.  An empty table gives no rows.
    """
    usable = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"),
                            F.coalesce(asked, F.lit(False)).alias("asked")) \
                    .where(F.col("id").isNotNull() & _usable(F.col("v")))
    rows = stored(usable.groupBy("id").agg(F.min("v").alias("v"), F.max("asked").alias("asked")))
    schema = "query_id long, vec_id long, score double"
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = sizes[0]["d"]
    rows = rows.where(F.size("v") == dims)
    some = rows.orderBy(F.xxhash64("id", F.lit(1))).limit(sample).select("v").toArrow()
    coder = learned(_matrix(some["v"].combine_chunks(), dims), n)
    queries = rows.where("asked").select("id", "v")
    blocks = max(1, -(-queries.count() // query_block))
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)))
    found = None
    for block in range(blocks):
        part = _search(rows, numbered.where(F.col("block") == block), coder, dims, coder.radius, n, schema)
        found = part if found is None else found.unionAll(part)
    best = stored(_best(found, n))
    # Queries whose reach holds too few rows are compared with every row.
    few = best.groupBy("query_id").count().where(F.col("count") >= n).select(F.col("query_id").alias("id"))
    rest = stored(queries.join(few, "id", "left_anti"))
    left = rest.count()
    if left:
        numbered = rest.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)),
                                                   F.lit(max(1, -(-left // query_block)))))
        best = best.join(rest.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        for block in range(max(1, -(-left // query_block))):
            best = best.unionByName(_best(_search(
                rows, numbered.where(F.col("block") == block), coder, dims, 10 ** 9, n, schema), n))
    return best.select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _search(rows: DataFrame, queries: DataFrame, coder: Coder, dims: int, radius: int, n: int,
            schema: str) -> DataFrame:
    asked = queries.select("id", "v").toArrow()
    ids, points = np.asarray(asked["id"], np.int64), _matrix(asked["v"].combine_chunks(), dims)
    shared = rows.sparkSession.sparkContext.broadcast((ids, points, coder.codes(points)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_points, query_codes = shared.value
        kept_ids = [np.zeros(0, np.int64)] * len(query_ids)
        kept_far = [np.zeros(0)] * len(query_ids)
        for batch in batches:
            for begin in range(0, len(batch), INDEX_ROWS):
                part = batch.slice(begin, INDEX_ROWS)
                own, points = np.asarray(part["id"]), _matrix(part["v"], dims)
                index = Index(coder.codes(points))
                for q, (qid, point, code) in enumerate(zip(query_ids, query_points, query_codes)):
                    close = index.within(code, radius)
                    close = close[own[close] != qid]
                    far = np.sqrt(((points[close] - point) ** 2).sum(axis=1))
                    far = np.concatenate([kept_far[q], far])
                    names = np.concatenate([kept_ids[q], own[close]])
                    if len(far) > n:
                        edge = np.partition(far, n - 1)[n - 1]
                        inside = np.flatnonzero(far <= edge)
                        best = inside[np.lexsort((names[inside], far[inside]))[:n]]
                        far, names = far[best], names[best]
                    kept_far[q], kept_ids[q] = far, names
        sizes = [len(x) for x in kept_ids]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(query_ids, sizes)), pa.array(np.concatenate(kept_ids)),
                 pa.array(np.concatenate(kept_far))], ["query_id", "vec_id", "score"])

    return rows.select("id", "v").mapInArrow(run, schema)
