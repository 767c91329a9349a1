"""Repeated passages by a sparse suffix array.

Only suffixes at minimiser positions are kept: the word run of least hash in every window that fits
into the shortest passage sought, so two copies of a passage keep the same places.  Kept suffixes
are sorted by the words on either side of their place, then by all words of the windows that the
place stands for, then by document.  Neighbours alike in all of these are copies of each other;
where places agree only in the nearer words, the first of each kind is asked again, window by
window, so that no third copy hides a passage that two of them share.  Matches are extended word by
word to the left and the right.

The sort is a range sort over (words, document, place), so a passage that stands in a third of all
documents fills many tasks; a task hands its first and last row on, to be compared across the edge.
A copy is compared with its neighbour only, so a passage of n copies gives n - 1 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stages import free_names, scratch, stored
from .words import BLANKS, Words, mixed, runs, slices, words_of

# Words of a passage at least, of a hashed run, and runs on each side that a suffix is sorted by.
LEAST, RUN, SIDE = 50, 8, 2


def minimisers(words: Words, least: int = LEAST, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs by their first word; the windows of ``least`` words of one text, by their
    first word, and the word at which the kept run of each begins.

    The kept run is chosen by the window's words alone: the leftmost run of least hash in it.
    """
    found, at = runs(words, run)
    by_word = np.full(len(words.row), np.iinfo(np.uint64).max, np.uint64)
    by_word[at] = found
    width = least - run + 1
    count = len(words.row) - least + 1
    if count <= 0:
        return by_word, np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Leftmost minimum of windows of 1, 2, 4 … runs, then of two that overlap to the width.
    best, size = np.arange(len(by_word)), 1
    while 2 * size <= width:
        left, right = best[:-size], best[size:]
        best = np.where(by_word[right] < by_word[left], right, left)
        size *= 2
    left, right = best[:count], best[width - size:width - size + count]
    best = np.where(by_word[right] < by_word[left], right, left)
    start = np.arange(count)
    inside = words.row[start] == words.row[start + least - 1]
    return by_word, start[inside], best[inside]


def _suffixes(docs: DataFrame, least: int) -> DataFrame:
    """Rows (key, whole, doc_id, pos): each kept suffix by the words to its right or to its left, and
    by all words of the windows it is kept for.

    A window with words enough to the right of its kept run belongs to the right key, any other to
    the left one; so the words of a key lie in every window that belongs to it.
    """
    sides = min(SIDE, (least + 1 - RUN) // (2 * RUN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], BLANKS)
            by_word, start, kept = minimisers(words, least)
            if not len(start):
                continue
            begin = words.first()
            left = kept - start > least - RUN * (sides + 1)
            # Windows of one place and side follow each other.
            new = np.flatnonzero(np.append(True, (kept[1:] != kept[:-1]) | (left[1:] != left[:-1])))
            place, low, high = kept[new], start[new], start[np.append(new[1:], len(start)) - 1]
            side = np.where(left[new], 2, 1).astype(np.uint64)
            step = np.where(left[new], -RUN, RUN)
            key = mixed(by_word[place] + mixed(side))
            for more in range(1, sides + 1):
                key = mixed(key + by_word[place + more * step])
            whole = mixed(_spans(by_word, low, high + least - RUN + 1)
                          + mixed((place - low).astype(np.uint64)) + mixed((high - low).astype(np.uint64), 1))
            row = words.row[place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
                 batch["doc_id"].take(pa.array(row)), pa.array(place - begin[row], pa.int32())],
                ["key", "whole", "doc_id", "pos"])

    return docs.mapInArrow(run, "key long, whole long, doc_id long, pos int")


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the values from each start up to its end, by their order: a polynomial modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    powers = np.cumprod(np.full(len(values), base, np.uint64))
    back = np.cumprod(np.full(len(values), pow(base, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers)])
    return (sums[end] - sums[start]) * back[start]


def _windows(chosen: DataFrame, least: int) -> DataFrame:
    """Rows (key, whole, doc_id, pos) like suffixes: all windows whose kept run begins at one of the
    row's ``places``, by all their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], BLANKS)
            by_word, start, kept = minimisers(words, least)
            begin = words.first()
            places = batch["places"]
            row = np.repeat(np.arange(len(batch)), np.asarray(pc.list_value_length(places)))
            wanted = np.zeros(len(words.row) + 1, bool)
            wanted[np.minimum(begin[row] + np.asarray(places.flatten()), len(words.row))] = True
            start = start[wanted[kept]] if len(start) else start
            key = np.zeros(len(start), np.uint64)
            for step in [*range(0, least - RUN, RUN), least - RUN]:
                key = mixed(key + by_word[start + step])
            row = words.row[start]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.zeros(len(start), np.int64)),
                 batch["doc_id"].take(pa.array(row)), pa.array(start - begin[row], pa.int32())],
                ["key", "whole", "doc_id", "pos"])

    return chosen.mapInArrow(run, "key long, whole long, doc_id long, pos int")


def _neighbours(suffixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of neighbouring suffixes of equal key and whole, (doc_id, pos) and the one before it; and
    (doc_id, pos) of the first suffix of each whole where a key has several."""
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "whole", "doc_id", "pos"]

    def rows(edge: int | None, now: list, before: list | None = None) -> pa.RecordBatch:
        count = len(now[0])
        before = before or [pa.nulls(count, pa.int64()), pa.nulls(count, pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array([edge] * count, pa.int64()), *map(pa.array, now), *map(pa.array, before)],
            ["edge", *order, "before_doc", "before_pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # last: the row before; head: the first one of this task that is like it.
        part, last, head = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not len(batch):
                continue
            columns = [np.asarray(batch[n]) for n in order]
            if last is None:
                yield rows(2 * part, [c[:1] for c in columns])
                last = head = [c[:1] for c in columns]
                columns = [c[1:] for c in columns]
            now = [np.concatenate(x) for x in zip(last, columns)]
            key, whole, doc, pos = now
            alike = key[1:] == key[:-1]
            same = alike & (whole[1:] == whole[:-1])
            at = np.flatnonzero(same)
            yield rows(None, [c[at + 1] for c in now], [doc[at], pos[at]])
            # Firsts, the one that began in an earlier batch at 0.
            first = np.append(0, np.flatnonzero(~same) + 1)
            heads = [np.append(h, c[first[1:]]) for h, c in zip(head, now)]
            several = np.flatnonzero(alike[first[1:] - 1])
            several = np.union1d(several, several + 1)
            yield rows(None, [c[several] for c in heads])
            last, head = [c[-1:] for c in now], [c[-1:] for c in heads]
        if last is not None:
            yield rows(2 * part + 1, last, head[2:])

    with scratch(suffixes.sparkSession) as keep:
        # Stored, because a range sort reads its rows twice.
        ordered = stored(suffixes).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        found = keep(ordered.mapInArrow(run, "edge long, key long, whole long, doc_id long, pos int, "
                                             "before_doc long, before_pos int"))
    # Two rows per task: the last one of a task and the first of the next are neighbours too.
    lag = {c: F.lag(c).over(Window.orderBy("edge")) for c in [*order, "before_doc", "before_pos"]}
    edges = found.where("edge IS NOT NULL").select(
        "edge", *order, *[lag[c].alias(f"_{c}") for c in lag]).where("edge % 2 = 0 AND key = _key")
    across = edges.where("whole = _whole").selectExpr("doc_id", "pos", "_doc_id AS before_doc", "_pos AS before_pos")
    inner = found.where("edge IS NULL")
    pairs = inner.where("before_doc IS NOT NULL").select("doc_id", "pos", "before_doc", "before_pos").unionAll(across)
    firsts = inner.where("before_doc IS NULL").select("doc_id", "pos").unionAll(
        edges.select("doc_id", "pos")).unionAll(
        edges.selectExpr("_before_doc AS doc_id", "_before_pos AS pos"))
    return pairs, firsts


def extended(words: list, before: list, pairs: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Matches of at least ``least`` words around the given places: starts in both, and length.

    Places on a match that was already found are passed over.  Within one text a match may
    overlap its copy.
    """
    found, reached = [], {}
    same = words is before
    for here, there in sorted(pairs):
        diagonal = here - there
        if same and diagonal == 0 or here < reached.get(diagonal, -1):
            continue
        a = 0
        while a < min(here, there) and words[here - a - 1] == before[there - a - 1]:
            a += 1
        z, room = 0, min(len(words) - here, len(before) - there)
        while z < room and words[here + z] == before[there + z]:
            z += 1
        reached[diagonal] = here + z
        if a + z >= least:
            found.append((here - a, there - a, a + z))
    return found


def matches(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
            least: int = LEAST) -> DataFrame:
    """Passages of at least ``least`` words that stand in an earlier place too.

    Per match: the id, ``start`` (words before it) and ``length`` in words, and the place of an
    earlier copy, ``source_id`` and ``source_start``; places are ordered by id and position, and the
    earlier copy is a neighbour in the order of suffixes or of windows.  Words are compared with A-Z in lower case.
    Ids are integers.  Rows with a null id or text, and texts of fewer words, give nothing; of
    several rows with one id the text that sorts first counts; other columns are ignored.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")) \
                .where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = _first_texts(plain) if _repeats(plain) else plain
    plain = stored(texts) if texts is not plain else plain
    with scratch(docs.sparkSession) as keep:
        pairs, firsts = _neighbours(_suffixes(plain, least))
        none = F.lit(None).cast("int").alias("pos")
        needed = firsts.unionAll(pairs.select("doc_id", none)).unionAll(pairs.select("before_doc", none)) \
                       .groupBy("doc_id").agg(F.collect_set("pos").alias("places"))
        placed = stored(plain.join(needed, "doc_id"))
        again, _ = _neighbours(_windows(placed, least))
        # Windows that overlap on one diagonal are one match: the first of them stands for all.
        again = again.groupBy("doc_id", "before_doc", F.expr("pos - before_pos"), F.floor(F.col("pos") / least)).agg(
            F.min("pos").alias("pos"), F.min("before_pos").alias("before_pos"))
        grouped = keep(pairs.unionByName(again.select(*pairs.columns)).groupBy("doc_id", "before_doc").agg(
            F.collect_set(F.struct("pos", "before_pos")).alias("places")))
        matched = grouped.select("doc_id").unionAll(grouped.select("before_doc")).distinct()
        chosen = keep(placed.drop("places").join(matched, "doc_id", "left_semi"))
    both = grouped.join(chosen.withColumnRenamed("text", "x"), "doc_id") \
                  .join(chosen.withColumnsRenamed({"doc_id": "before_doc", "text": "y"}), "before_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            rows, starts, sources, lengths = [], [], [], []
            own, other = words_of(batch["x"], BLANKS), words_of(batch["y"], BLANKS)
            a, b = own.first(), other.first()
            same = np.asarray(batch["doc_id"]) == np.asarray(batch["before_doc"])
            for row, places in enumerate(batch["places"].to_pylist()):
                x = own.hash[a[row]:a[row + 1]].tolist()
                y = x if same[row] else other.hash[b[row]:b[row + 1]].tolist()
                for start, source, length in extended(
                        x, y, [(p["pos"], p["before_pos"]) for p in places], least):
                    rows.append(row)
                    starts.append(start)
                    sources.append(source)
                    lengths.append(length)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(take), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 batch["before_doc"].take(take), pa.array(sources, pa.int64())],
                ["doc_id", "start", "length", "source_id", "source_start"])

    return both.select("doc_id", "before_doc", "places", "x", "y").mapInArrow(
        run, "doc_id long, start long, length long, source_id long, source_start long") \
        .withColumnRenamed("doc_id", id_column)


def _first_texts(plain: DataFrame) -> DataFrame:
    return plain.groupBy("doc_id").agg(F.min("text").alias("text"))


def _repeats(plain: DataFrame) -> bool:
    """Whether an id stands in several rows."""
    return bool(plain.groupBy("doc_id").count().where("count > 1").head(1))


def cut(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the matched passages; their earliest copies stay.

    A removed passage takes its words and the blanks before them.  All columns and rows are kept;
    of several texts with one id only the one that sorts first, whose passages they are, is cut.
    """
    columns = docs.columns
    name, spans, first = free_names(docs, "id", "spans", "first")
    ids = F.col(id_column).cast("long")
    cuts = found.groupBy(F.col(id_column).cast("long").alias(name)).agg(
        F.collect_set(F.struct("start", "length")).alias(spans))
    plain = docs.select(ids.alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    if _repeats(plain):
        owners = _first_texts(plain).select(F.col("doc_id").alias(name), F.col("text").alias(first))
        paired = docs.join(cuts.join(owners, name), (ids == F.col(name)) & (F.col(text) == F.col(first)), "left")
    else:
        paired = docs.join(cuts, ids == F.col(name), "left")
    paired = paired.select(*columns, spans)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            cuts_of = batch[spans].to_pylist()
            if not any(cuts_of):
                yield batch.select(columns)
                continue
            words = words_of(batch[text], BLANKS)
            begin = words.first()
            values = []
            for row, value in enumerate(batch[text].to_pylist()):
                if not cuts_of[row] or value is None:
                    values.append(value)
                    continue
                data, origin, done, parts = value.encode(), int(words.offsets[row]), 0, []
                for span in sorted((s["start"], s["start"] + s["length"]) for s in cuts_of[row]):
                    first, last = begin[row] + span[0], begin[row] + span[1] - 1
                    start = int(words.end[first - 1]) - origin if span[0] else 0
                    parts.append(data[done:max(done, start)])
                    done = max(done, int(words.end[last]) - origin)
                values.append((b"".join(parts) + data[done:]).decode())
            place = columns.index(text)
            yield batch.select(columns).set_column(place, text, pa.array(values, pa.string()))

    return paired.mapInArrow(run, schema)
