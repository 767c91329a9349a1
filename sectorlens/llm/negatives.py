"""Hard negatives through an R-tree packed by sort-tile-recursive (STR).

Rows are sorted by label and widest coordinate and cut into slabs, each slab is sorted by the next
coordinate and cut into tiles of equal size: the lower nodes of the tree, one group of rows each.
Within its task a tile is packed the same way down to leaves.  A node has a minimum bounding box.
Per coordinate the box and the query's sign give the least and the greatest product, and their sums
an interval that holds the inner products of all rows in the box.

A best-first queue takes nodes by their upper bound, cut at the window's upper end.  Nodes whose
interval misses the window, whose labels do not fit, or whose bound lies strictly below the kth row
found are pruned.  Queries go out twice: first to the one tile of greatest bound, which gives each
a kth row to start from, then to all tiles that this row does not prune.  Queries travel in blocks,
and a block meets the rows of a tile only if one of its queries needs them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import dense_ordinals
from .stages import stored

# Rows of a tile and of a leaf, parts that a node is cut into.
TILE, LEAF, FAN = 4096, 256, 4
# Queries that meet a tile together, queries scored at once, tiles whose boxes are tested together.
QUERIES, SCORED, BOXES = 4096, 256, 1024
_WINDOWS = "array<struct<key:bigint,low:bigint,high:bigint,kth:bigint,kth_id:bigint>>"


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of integers in a type in which their products' sums are exact."""
    if a.size and b.size and a.shape[-1] * float(np.abs(a).max()) * float(np.abs(b).max()) >= 2.0 ** 53:
        return tuple(np.array([int(x) for x in m.ravel()], object).reshape(m.shape) for m in (a, b))
    return a, b


def intervals(points: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each point with any vector in each box."""
    points, both = exact(points, np.concatenate([least, most]))
    least, most = both[:len(least)], both[len(least):]
    up, down = np.maximum(points, 0), np.minimum(points, 0)
    return up @ least.T + down @ most.T, up @ most.T + down @ least.T


class Tree:
    """One tile: rows in packed order and nodes with boxes, the root first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        order: list[np.ndarray] = []
        self.children: list[list[int]] = []
        spans: list[tuple[int, int]] = []

        def pack(rows: np.ndarray, begin: int) -> int:
            node = len(spans)
            spans.append((begin, begin + len(rows)))
            self.children.append([])
            if len(rows) <= leaf:
                order.append(rows)
                return node
            part = points[rows]
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            rows = rows[np.lexsort((ids[rows], part[:, axis]))]
            size = max(leaf, -(-len(rows) // fan))
            for at in range(0, len(rows), size):
                self.children[node].append(pack(rows[at:at + size], begin + at))
            return node

        pack(np.lexsort((ids, labels)), 0)
        rows = np.concatenate(order)
        self.ids, self.labels, self.points, self.spans = ids[rows], labels[rows], points[rows], spans
        self.least = np.stack([self.points[a:z].min(axis=0) for a, z in spans])
        self.most = np.stack([self.points[a:z].max(axis=0) for a, z in spans])
        self.low_label = np.array([self.labels[a:z].min() for a, z in spans])
        self.high_label = np.array([self.labels[a:z].max() for a, z in spans])
        self.first_id = np.array([self.ids[a:z].min() for a, z in spans])
        #: Rows whose products were looked at, over all queries and windows.
        self.compared = 0

    def search(self, names: np.ndarray, labels: np.ndarray, points: np.ndarray, windows: list, same: bool, n: int):
        """For each query and window its key and the first ``n`` rows that fit: ids and scores."""
        for begin in range(0, len(names), SCORED):
            part = slice(begin, begin + SCORED)
            low, high = intervals(points[part], self.least, self.most)
            fits = fitting(self.low_label, self.high_label, labels[part], same)
            scores: dict[int, np.ndarray] = {}
            for q, (name, label, own) in enumerate(zip(names[part], labels[part], windows[part])):
                for window in own:
                    ids, found = self._best(q, name, label, points[part], window, same, n, low[q], high[q], fits[q], scores)
                    if len(ids):
                        yield name, window["key"], ids, found

    def _best(self, q, name, label, points, window, same, n, low, high, fits, scores):
        least = -np.inf if window["low"] is None else window["low"]
        most = np.inf if window["high"] is None else window["high"]
        kth, kth_id = (-np.inf, -1) if window["kth"] is None else (window["kth"], window["kth_id"])
        ids, found = np.zeros(0, np.int64), np.zeros(0)
        queue = [(-min(high[0], most), 0)] if fits[0] and high[0] >= least and low[0] <= most else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < kth:
                break
            if -bound == kth and self.first_id[node] > kth_id:
                continue
            for child in self.children[node]:
                if fits[child] and high[child] >= max(least, kth) and low[child] <= most:
                    heapq.heappush(queue, (-min(high[child], most), child))
            if self.children[node]:
                continue
            a, z = self.spans[node]
            if node not in scores:
                left, right = exact(points, self.points[a:z])
                scores[node] = left @ right.T
            self.compared += z - a
            own = scores[node][q]
            hit = (own >= max(least, kth)) & (own <= most)
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            at = at[(self.labels[a:z][at] == label) == same]
            at = at[self.ids[a:z][at] != name]
            found, ids = np.concatenate([found, own[at]]), np.concatenate([ids, self.ids[a:z][at]])
            if len(ids) >= n:
                best = sorted(range(len(ids)), key=lambda i: (-found[i], ids[i]))[:n] \
                    if found.dtype == object else np.lexsort((ids, -found))[:n]
                found, ids = found[best], ids[best]
                if (-found[-1], ids[-1]) < (-kth, kth_id):
                    kth, kth_id = found[-1], ids[-1]
        return ids, found


def fitting(low: np.ndarray, high: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
    """Whether a box with labels from ``low`` to ``high`` may hold rows of each label, or of another."""
    labels = labels[:, None]
    return (low <= labels) & (labels <= high) if same else ~((low == labels) & (labels == high))


def _matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    flat = pa.concat_arrays([chunk.flatten() for chunk in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    with np.errstate(over="ignore"):
        return np.floor(scale * np.asarray(flat, np.float64)).reshape(len(column), -1)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column, np.int64)


def _wide(rows: DataFrame, dims: int) -> list[int]:
    """Coordinates by falling variance."""
    def run(batches):
        for batch in batches:
            points = np.asarray(batch["v"].flatten(), np.float64).reshape(-1, dims)
            sums = [points.sum(axis=0), (points ** 2).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), *map(pa.array, sums),
                                              pa.array(np.full(dims, len(points)))], ["i", "s", "t", "n"])

    sums = rows.select("v").mapInArrow(run, "i int, s double, t double, n long").groupBy("i").agg(
        (F.sum("t") / F.sum("n") - (F.sum("s") / F.sum("n")) ** 2).alias("wide"))
    return [r["i"] for r in sums.orderBy(F.desc("wide"), "i").limit(2).collect()]


def _tiled(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """Rows with their ``tile``: slabs along the widest coordinate, cut along the next one."""
    count = rows.count()
    if count <= size:
        return rows.withColumn("tile", F.lit(0).cast("long"))
    axes = _wide(rows, dims)
    tiles = -(-count // size)
    slab = size * max(1, round(tiles ** 0.5))
    keyed = rows.select("id", "label", F.col("v")[axes[0]].alias("x"), F.col("v")[axes[-1]].alias("y"))
    slabs = dense_ordinals(keyed, ["label", "x"], "id").select("id", F.expr(f"ordinal div {slab}").alias("slab"))
    placed = dense_ordinals(keyed.select("id", "y").join(slabs, "id"), ["slab", "y"], "id") \
        .select("id", F.expr(f"ordinal div {size}").alias("tile"))
    return stored(rows.join(placed, "id"))


def _boxes(rows: DataFrame, scale: float) -> DataFrame:
    """Per tile its box, the range of its labels and its smallest id."""
    def run(part: pa.Table) -> pa.Table:
        points, labels = _matrix(part["v"], scale), _numbers(part["label"])
        return pa.table({"tile": part["tile"][:1].cast(pa.int64()),
                         "least": pa.array([points.min(axis=0)]), "most": pa.array([points.max(axis=0)]),
                         "low_label": [int(labels.min())], "high_label": [int(labels.max())],
                         "first_id": [int(_numbers(part["id"]).min())]})

    return rows.groupBy("tile").applyInArrow(
        run, "tile long, least array<double>, most array<double>, low_label long, high_label long, first_id long")


def _tested(queries: DataFrame, boxes: DataFrame, blocks: int, groups: int, scale: float, same: bool,
            first: bool) -> DataFrame:
    """Blocks of queries beside boxes: each query's tile of greatest bound, or the tiles that a block needs."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, tiles = _numbers(left["id"]), _numbers(right["tile"])
        low, high = intervals(_matrix(left["v"], scale), _matrix(right["least"], 1), _matrix(right["most"], 1))
        fits = fitting(_numbers(right["low_label"]), _numbers(right["high_label"]), _numbers(left["label"]), same)
        ids, out = _numbers(right["first_id"]), []
        needed = np.zeros(len(tiles), bool)
        for q, own in enumerate(left["windows"].to_pylist()):
            bound = np.full(len(tiles), -np.inf)
            for window in own:
                least = -np.inf if window["low"] is None else window["low"]
                most = np.inf if window["high"] is None else window["high"]
                good = fits[q] & (high[q] >= least).astype(bool) & (low[q] <= most).astype(bool)
                top = np.minimum(high[q], most)
                if window["kth"] is not None:
                    good &= ((top > window["kth"]) | ((top == window["kth"]) & (ids <= window["kth_id"]))).astype(bool)
                needed |= good
                bound = np.maximum(bound, np.where(good, top, -np.inf).astype(float))
            if first and len(tiles) and bound.max() > -np.inf:
                out.append((int(names[q]), int(tiles[bound.argmax()]), float(bound.max())))
        if not first and len(names):
            block = left["block"][0].as_py()
            out = [(block, int(tile), 0.0) for tile in tiles[needed]]
        return pa.table({"name": pa.array([r[0] for r in out], pa.int64()), "tile": pa.array([r[1] for r in out], pa.int64()),
                         "bound": pa.array([r[2] for r in out], pa.float64())})

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    asked = queries.withColumn("group", numbers(groups))
    there = boxes.withColumn("group", F.expr(f"tile div {BOXES}")).withColumn("block", numbers(blocks))
    return asked.groupBy("block", "group").cogroup(there.groupBy("block", "group")).applyInArrow(
        run, "name long, tile long, bound double")


def _visited(asked: DataFrame, rows: DataFrame, scale: float, same: bool, n: int) -> DataFrame:
    """The first ``n`` rows of each query, window and tile; ``asked`` names each query's tiles."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            tree = Tree(_numbers(right["id"]), _numbers(right["label"]), _matrix(right["v"], scale))
            found = list(tree.search(_numbers(left["id"]), _numbers(left["label"]), _matrix(left["v"], scale),
                                     left["windows"].to_pylist(), same, n))
        sizes = [len(ids) for _, _, ids, _ in found]
        bound = 2 ** 63 - 1
        return pa.table({
            "id": pa.array(np.repeat([f[0] for f in found], sizes).astype(np.int64)),
            "key": pa.array(np.repeat([f[1] for f in found], sizes).astype(np.int64)),
            "row": pa.array(np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)),
            "score": pa.array([max(-bound, min(bound, int(s))) for f in found for s in f[3]], pa.int64())})

    # The rows' side gets columns of its own, else the two would be taken for one table.
    pairs = asked.select(F.col("tile").alias("at"), F.col("block").alias("meets")).distinct()
    there = rows.select("id", "label", "v", "tile").join(pairs, F.col("tile") == F.col("at")).select(
        *[F.col(c).alias(c) for c in ("id", "label", "v", "tile")], F.col("meets").alias("block"))
    return asked.groupBy("tile", "block").cogroup(there.groupBy("tile", "block")).applyInArrow(
        run, "id long, key long, row long, score long")


def _ranked(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("id", "key").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _first(queries: DataFrame, rows: DataFrame, boxes: DataFrame, blocks: int, groups: int, scale: float,
           same: bool, n: int) -> DataFrame:
    """The first ``n`` rows in each window of each query, over all tiles."""
    best = _tested(queries, boxes, blocks, groups, scale, same, True).groupBy(F.col("name").alias("id")).agg(
        F.max_by("tile", F.struct("bound", -F.col("tile"))).alias("tile"))
    start = _ranked(_visited(queries.join(best, "id"), rows, scale, same, n), n).where(F.col("rank") == n)
    known = start.groupBy("id").agg(F.map_from_entries(F.collect_list(
        F.struct("key", F.struct("score", "row")))).alias("kth"))
    started = stored(queries.join(known, "id", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
        w["key"].alias("key"), w["low"].alias("low"), w["high"].alias("high"),
        F.col("kth")[w["key"]]["score"].alias("kth"), F.col("kth")[w["key"]]["row"].alias("kth_id")))).drop("kth"))
    needed = _tested(started, boxes, blocks, groups, scale, same, False).select(F.col("name").alias("block"), "tile")
    return stored(_ranked(_visited(started.join(needed, "block"), rows, scale, same, n), n))


def mined(vectors: DataFrame, asked: Column, label: Column | str = "label", id_column: str = "vec_id",
          vector: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
          scale: float = 256.0, tile: int = TILE) -> DataFrame:
    """Hard negatives of each anchor and each of its positives.

    A component x counts as ``floor(scale * x)``; the score of two rows is their integer inner product.
    Anchors are the rows where ``asked`` holds.  An anchor's positives are the ``positives`` other rows
    of its label with the highest scores; of each, the negatives are the ``negatives`` rows of another
    label with the highest scores between ``low`` and ``high`` percent of the positive's.  Ties go to
    the smaller id.  Result: ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Labels are integers.  Rows without id, label or vector, with a component that is null or not finite
    after scaling, and those of another length than the most frequent take no part.  A repeated id
    counts once, with the smallest of its labels and vectors, and is an anchor if one of its rows is.
    Scores beyond 64 bits count as the largest.  Other columns are ignored; an empty table gives no rows.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("the window must lie between 0 and 100 percent")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    label = F.col(label) if isinstance(label, str) else label
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    usable = vectors.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                            numbers.alias("v"), F.coalesce(asked, F.lit(False)).alias("asked")) \
                    .where("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0").where(finite)
    rows = stored(usable.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"), F.max("asked").alias("asked"))
                  .select("id", "row.label", "row.v", "asked"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = sizes[0]["d"]
    rows = _tiled(rows.where(F.size("v") == dims), dims, tile)
    boxes = stored(_boxes(rows, scale))
    groups = -(-(boxes.agg(F.max("tile")).first()[0] + 1) // BOXES)
    anchors = rows.where("asked")
    count = anchors.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = -(-count // QUERIES)
    if blocks > 1:
        # Anchors of one block lie in tiles beside each other.
        places = dense_ordinals(anchors.select("tile", "id"), ["tile"], "id")
        anchors = anchors.join(places.select("id", F.expr(f"ordinal div {QUERIES}").alias("block")), "id")
    else:
        anchors = anchors.withColumn("block", F.lit(0).cast("long"))
    anchors = stored(anchors.select("id", "label", "v", "block"))
    everything = F.expr(f"cast(array(named_struct('key', 0L, 'low', null, 'high', null, 'kth', null, "
                        f"'kth_id', null)) AS {_WINDOWS})")
    near = _first(anchors.withColumn("windows", everything), rows, boxes, blocks, groups, scale, True, positives)
    # Exact shares of the positive's score, without leaving 64 bits.
    whole, part = "((score - pmod(score, 100)) div 100)", "pmod(score, 100)"
    window = near.select("id", F.col("row").alias("key"),
                         F.expr(f"{whole} * {low} + ({part} * {low} + 99) div 100").alias("low"),
                         F.expr(f"{whole} * {high} + ({part} * {high}) div 100").alias("high")).where("low <= high")
    windows = window.groupBy("id").agg(F.collect_list(F.struct(
        "key", "low", "high", F.lit(None).cast("long").alias("kth"), F.lit(None).cast("long").alias("kth_id")))
        .alias("windows"))
    far = _first(stored(anchors.join(windows, "id")), rows, boxes, blocks, groups, scale, False, negatives)
    return far.join(near.select("id", F.col("row").alias("key"), F.col("score").alias("positive_score")), ["id", "key"]) \
              .select(F.col("id").alias("anchor_id"), F.col("key").alias("positive_id"), "rank",
                      F.col("row").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
