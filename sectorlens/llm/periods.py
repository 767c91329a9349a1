"""Periodic runs of words: stretches that repeat with a period, found on tiles by scale.

A run is a maximal stretch of consecutive words whose smallest period is q and whose length is
``max(12, 2q)`` or more.  Periods are cut into octaves.  For the octave from Q to 2Q there is a
boundary every Q words, and each run of such a period holds a boundary b with room for one whole
period behind it.  Around a boundary the tile looks 2Q - 1 words to the left and, behind b + q, as
many to the right: the longest match of the words from b with those from b + q (the Z-function of
the right part at q) and of the words before b with those before b + q (that of the reversed left
part).  Together with q they make a fragment of a run, and the fragments that neighbouring
boundaries give of one run overlap by q words or more, those of two runs by less.

Tiles need nothing from each other.  Whole documents of usual length are tiled in the task that
reads them, many documents side by side; the tiles of very long ones are dealt over the cluster.
Fragments are then shuffled by document and period and stitched.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stages import stored
from .words import BLANKS, mixed, slices, words_of

LEAST = 12
# Words beyond which the tiles of a document are dealt over tasks, and words of such a tile.
LONG, TILE = 1 << 18, 1 << 16
_FACTOR = np.uint64(0xBF58476D1CE4E5B9)
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))


@dataclass(frozen=True)
class Octave:
    """Periods ``low`` to ``high`` - 1, a boundary every ``step`` words, matches up to 2 ``top`` - 1."""

    low: int
    high: int
    step: int
    top: int
    window: int


def octave(low: int) -> Octave:
    """Periods below 8 go together: their runs have 12 words, so that a boundary every 4 is enough."""
    return Octave(1, 8, 4, 8, 2) if low == 1 else Octave(low, 2 * low, low, low, low // 2)


def octaves(words: int) -> list[Octave]:
    """The octaves of all periods that a text of so many words can have."""
    found = [octave(1)] if words >= LEAST else []
    while found and 2 * found[-1].high <= words:
        found.append(octave(found[-1].high))
    return found


def _unlike(count: int, salt: int) -> np.ndarray:
    """Values that equal no other value."""
    return mixed(np.arange(count, dtype=np.uint64), salt)


@functools.lru_cache(maxsize=32)
def _divisors(limit: int) -> np.ndarray:
    """The smallest prime factor of every number below ``limit``."""
    least = np.arange(limit)
    for p in range(2, int(limit ** 0.5) + 1):
        if least[p] == p:
            multiples = least[p * p::p]
            multiples[multiples == np.arange(p * p, limit, p)] = p
    return least


def fragments(tokens: np.ndarray, scales: list[Octave], first: int = 0,
              last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Periods, starts and ends of runs, or parts of them, around the boundaries from ``first`` to ``last``.

    Parts that overlap by their period are put together; sorted by period and start.
    """
    none = (np.zeros(0, np.int64),) * 3
    if not scales or not len(tokens):
        return none
    last = len(tokens) if last is None else last
    most = scales[-1]
    front, back = 2 * most.top, most.high + 2 * most.top + most.step
    padded = np.concatenate([_unlike(front, 11), tokens, _unlike(back, 12)])
    # Level j holds a hash of the 2 ** j words from each place.
    levels = [padded]
    while (1 << len(levels)) <= most.top:
        width = 1 << (len(levels) - 1)
        levels.append(mixed(levels[-1][:-width] * _FACTOR + levels[-1][width:]))
    found = [_around(levels, scale, front + first, front + last) for scale in scales]
    period, start, end = (np.concatenate(x) for x in zip(*found))
    return stitched(period, start - front, end - front)


def _around(levels: list[np.ndarray], scale: Octave, first: int, last: int):
    """Fragments of one octave in padded coordinates."""
    seen = levels[scale.window.bit_length() - 1]
    grid = np.arange(first, last, scale.step)
    spans = np.arange(scale.low, scale.high)
    if scale.step == scale.high - scale.low:
        # The words one period behind each boundary are rows of one matrix.
        def behind(at):
            begin = at + scale.low
            return seen[begin:begin + len(grid) * scale.step].reshape(len(grid), -1) == seen[grid - first + at][:, None]
    else:
        def behind(at):
            own = seen[grid - first + at]
            return np.stack([seen[grid - first + at + q] == own for q in spans.tolist()], axis=1)
    # Matches of together q words and more hold a match of a window on one side at least.
    place, span = np.nonzero(behind(first) | behind(first - scale.window))
    b, q = grid[place], spans[span]
    right, left = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
    step = scale.top
    while step:
        level = levels[step.bit_length() - 1]
        right += step * (level[b + right] == level[b + q + right])
        left += step * (level[b - left - step] == level[b + q - left - step])
        step >>= 1
    keep = q + left + right >= np.maximum(LEAST, 2 * q)
    b, q, start, end = b[keep], q[keep], (b - left)[keep], (b + q + right)[keep]
    # A run with a smaller period has one that divides q.
    smallest, rest, least = np.ones(len(q), bool), q.copy(), _divisors(scale.high)
    while (rest > 1).any():
        prime = least[rest]
        shorter = q // np.maximum(prime, 1)
        for bit in range(scale.high.bit_length()):
            width = 1 << bit
            at = np.flatnonzero((rest > 1) & smallest & (q >= width) & (q < 2 * width))
            if len(at):
                level, s, d, n = levels[bit], start[at], shorter[at], q[at]
                smallest[at] = ~((level[s] == level[s + d])
                                 & (level[s + n - width] == level[s + d + n - width]))
        rest = np.where(rest > 1, rest // np.maximum(prime, 1), rest)
    return q[smallest], start[smallest], end[smallest]


def stitched(period: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Put fragments of one period together that overlap by it."""
    if not len(period):
        return period, start, end
    order = np.lexsort((start, period))
    period, start, end = period[order], start[order], end[order]
    bound = np.int64(end.max() + 1)
    reach = np.maximum.accumulate(period * bound + end)
    new = np.ones(len(period), bool)
    new[1:] = (period[1:] != period[:-1]) | (period[1:] * bound + start[1:] + period[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    return period[heads], start[heads], np.maximum.reduceat(end, heads)


_STAGE = pa.schema([("key", pa.int64()), ("id", pa.string()), ("fragments", _FRAGMENTS), ("text", pa.string()),
                    ("collapsed", pa.string()), ("low", pa.int64()), ("offset", pa.int64()), ("first", pa.int64()),
                    ("last", pa.int64()), ("tokens", pa.binary())])


def _tiles(key: int, tokens: np.ndarray, size: int) -> Iterator[dict]:
    """The tiles of a long document: boundaries of about ``size`` words with the words around them."""
    for scale in octaves(len(tokens)):
        block = max(size, 4 * scale.step)
        for begin in range(0, len(tokens), block):
            low = max(0, begin - 2 * scale.top)
            end = min(len(tokens), begin + block)
            yield {"key": key, "low": scale.low, "offset": low, "first": begin - low, "last": end - low,
                   "tokens": tokens[low:end + scale.high + 2 * scale.top].tobytes()}


def _solved(docs: DataFrame, keep: bool, long: int, tile: int) -> DataFrame:
    """Per document its fragments, or its collapsed text where it has none; and the tiles of long ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], BLANKS, lower=False)
            first = words.first()
            counts = np.diff(first)
            keys, texts, out = batch["key"].to_pylist(), batch["text"].to_pylist(), []
            # All usual documents side by side, an unlike word between any two.
            usual = counts <= long
            begins = np.append(0, np.cumsum(np.where(usual, counts + 1, 0)))
            tokens = _unlike(int(begins[-1]), 13)
            own = usual[words.row]
            tokens[(np.arange(len(words.row)) - first[words.row] + begins[words.row])[own]] = words.hash[own]
            most = int(counts[usual].max()) if usual.any() else 0
            period, start, end = fragments(tokens, octaves(most))
            row = np.searchsorted(begins, start, "right") - 1
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(len(keys) + 1))
            for i, (key, name, text) in enumerate(zip(keys, batch["id"].to_pylist(), texts)):
                some = order[cuts[i]:cuts[i + 1]]
                done = {"key": key, "id": name}
                if len(some) or not usual[i]:
                    done["text"] = text
                    done["fragments"] = [{"period": p, "start": s, "length": n} for p, s, n in zip(
                        period[some].tolist(), (start[some] - begins[i]).tolist(), (end - start)[some].tolist())]
                else:
                    done["collapsed"] = _text(b" ".join((text or "").encode().split()), keep)
                out.append(done)
                if not usual[i]:
                    for part in _tiles(key, words.hash[first[i]:first[i + 1]], tile):
                        yield pa.RecordBatch.from_pylist([part], _STAGE)
            yield pa.RecordBatch.from_pylist(out, _STAGE)

    return docs.mapInArrow(run, "key long, id string, fragments array<struct<period:long,start:long,length:long>>, "
                                "text string, collapsed string, low long, offset long, first long, last long, "
                                "tokens binary")


def _of_tiles(tiles: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                period, start, end = fragments(np.frombuffer(tile["tokens"], np.uint64), [octave(tile["low"])],
                                               tile["first"], tile["last"])
                if len(period):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(period), tile["key"])), pa.array(period),
                         pa.array(start + tile["offset"]), pa.array(end - start)],
                        ["key", "period", "start", "length"])

    return tiles.repartition("key", "low", "offset").mapInArrow(
        run, "key long, period long, start long, length long")


def _text(words: bytes, keep: bool) -> str:
    return words.decode() if keep else hashlib.sha256(words).hexdigest()


def _collapsed(docs: DataFrame, keep: bool) -> DataFrame:
    """Drop the words that repeat a run's first period."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = []
            for text, found in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
                words = (text or "").encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                for one in found or ():
                    edges[one["start"] + one["period"]] += 1
                    edges[one["start"] + one["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()
                texts.append(_text(b" ".join([words[i] for i in kept]), keep))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["runs"], pa.array(texts, pa.string())],
                                             ["id", "runs", "collapsed"])

    return docs.select("id", "runs", "text").mapInArrow(
        run, "id string, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def found(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: bool = True, long: int = LONG,
          tile: int = TILE) -> DataFrame:
    """All periodic runs of every whole text.

    Words are what stands between blanks, compared with case.  Per row: the id, ``n_runs``, ``runs``
    (start, length and period, by start and then period), the run of greatest length as ``start``,
    ``length``, ``period`` and ``exponent_milli`` (ties: smallest start, then period; no run: null)
    and ``collapsed``: the words, joined by one space, without those that a run holds behind its
    first period.  Without ``keep``, ``collapsed`` is the SHA-256 of that text in hexadecimal.
    A null text has no words.  Repeated rows and null ids are returned each; other columns are
    ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_column].dataType
    stage = stored(_solved(docs.select(F.monotonically_increasing_id().alias("key"),
                                       F.col(id_column).cast("string").alias("id"), F.col(text).alias("text")),
                           keep, long, tile))
    parts = stage.where("fragments IS NOT NULL").select("key", F.inline("fragments")).unionByName(
        _of_tiles(stage.where("tokens IS NOT NULL").select("key", "low", "offset", "first", "last", "tokens")))
    inside = Window.partitionBy("key", "period").orderBy("start", "length")
    islands = parts.withColumn("end", F.col("start") + F.col("length")) \
                   .withColumn("reach", F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))) \
                   .withColumn("new", F.when(F.col("start") + F.col("period") <= F.col("reach"), 0).otherwise(1)) \
                   .withColumn("island", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("key", "period", "island").agg(
        F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    # What has a smaller period too is the run of that period.
    each = runs.groupBy("key", "start", "length").agg(F.min("period").alias("period")) \
               .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    open_docs = stage.where("text IS NOT NULL").select("key", "id", "text")
    with_runs = _collapsed(open_docs.join(each, "key", "left"), keep)
    without = stage.where("collapsed IS NOT NULL").select(
        "id", F.lit(None).cast("array<struct<start:long,length:long,period:long>>").alias("runs"), "collapsed")
    none = F.coalesce("runs", F.expr("cast(array() AS array<struct<start:bigint,length:bigint,period:bigint>>)"))
    whole = without.unionByName(with_runs).withColumn("runs", none)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return whole.withColumn("best", best).select(
        F.col("id").cast(kind).alias(id_column), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"), "runs", "collapsed")
