"""Greedy packing of the ordered texts of a group into segments.

Packing is a left-to-right fold: whether a part opens a new segment depends on
how full the current one is.  Only the sizes of the parts matter for it, so the
texts stay out of it until the segments are numbered.  Sizes are range-sorted by
group and order and cut into chunks of bounded row count.  A group inside one
chunk, the common case, is folded at once.  A larger one is run as a scan:

1. every chunk works out, for every possible fill level at its start, the level
   at its end and the number of segments it opens.  Neighbouring levels mostly
   lead to the same outcome, so a chunk is described by a few runs;
2. the runs of a thousand chunks are put together to the runs of a block, the
   blocks of a group, a millionth of its rows, are chained in order, and then the
   chunks inside each block, which gives every chunk its true start;
3. every chunk numbers its own parts from there.

The result equals the plain fold for any group size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import checkpointed
from .joins import lookup_join
from .ordering import CHUNK_ROWS, block_of, joined, with_ordinal

MARKER = "###"
# Chunks that are put together to one block.
BLOCK_CHUNKS = 1000


@dataclass(frozen=True)
class Rule:
    """How parts fill segments.

    ``step(levels, size)`` takes an array of fill levels and the size of one part
    and returns the new levels and whether the part opens a new segment.  Levels
    run from 0 to ``top``; a group starts at ``initial``.
    """

    top: int
    initial: int
    step: Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def by_chars(limit: int = 3000, separator_size: int = len(MARKER)) -> Rule:
    """A part opens a segment when level + part + separator exceeds the limit.

    The test also holds for an empty segment, so an oversized first part leaves
    an empty segment behind.
    """

    def step(levels: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        opens = levels + size + separator_size > limit
        grown = np.where(levels > 0, levels + separator_size, 0) + size
        return np.minimum(np.where(opens, size, grown), limit), opens

    return Rule(limit, 0, step)


def by_words(limit: int = 3000) -> Rule:
    """A part opens a segment at the marker before it once the limit is reached.

    The marker word counts for the segment it starts.  Level ``limit + 1`` stands
    for a group without any part yet: its first part has no marker before it.
    """
    nothing_yet = limit + 1

    def step(levels: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        fresh = levels == nothing_yet
        opens = (levels >= limit) & ~fresh
        before = np.where(fresh, 0, np.where(opens, 1, levels + 1))
        return np.minimum(before + size, limit), opens

    return Rule(nothing_yet, nothing_yet, step)


def outcome_runs(rule: Rule, sizes: np.ndarray) -> pd.DataFrame:
    """Outcome of a chunk for every start level, as runs of start levels.

    In a run the end level is the same for all start levels or, with ``moves``,
    rises one to one with them; the number of opened segments is the same.
    """
    levels = np.arange(rule.top + 1, dtype=np.int64)
    opened = np.zeros(rule.top + 1, dtype=np.int64)
    owner = np.arange(rule.top + 1)
    for i, size in enumerate(sizes):
        levels, opens = rule.step(levels, int(size))
        opened = opened + opens
        if i % 4 == 0 and len(levels) > 16:
            # Start levels that have met stay together; carry them once.
            met, back = np.unique(opened * (rule.top + 1) + levels, return_inverse=True)
            opened, levels = np.divmod(met, rule.top + 1)
            owner = back[owner]
    return _as_runs(levels[owner], opened[owner])


def chained_runs(rule: Rule, chunks: Sequence[pd.DataFrame]) -> pd.DataFrame:
    """Outcome runs of consecutive chunks taken together."""
    levels = np.arange(rule.top + 1, dtype=np.int64)
    opened = np.zeros(rule.top + 1, dtype=np.int64)
    for runs in chunks:
        levels, more = after_chunk(levels, runs)
        opened = opened + more
    return _as_runs(levels, opened)


def _as_runs(end: np.ndarray, count: np.ndarray) -> pd.DataFrame:
    top = len(end) - 1
    same_count = np.diff(count) == 0
    flat = same_count & (np.diff(end) == 0)
    rising = same_count & (np.diff(end) == 1)
    head, lows, moves = 0, [], []
    while head <= top:
        moving = head < top and bool(rising[head])
        lows.append(head)
        moves.append(moving)
        stop = np.flatnonzero(~(rising if moving else flat)[head:])
        head = head + int(stop[0]) + 1 if len(stop) else top + 1
    return pd.DataFrame({"low": lows, "end_level": end[lows], "opened": count[lows],
                         "moves": moves})


def after_chunk(levels, runs: pd.DataFrame):
    """End levels and opened segments of a chunk entered at the given levels."""
    low = runs["low"].to_numpy()
    at = np.searchsorted(low, levels, side="right") - 1
    shift = np.where(runs["moves"].to_numpy()[at], levels - low[at], 0)
    return runs["end_level"].to_numpy()[at] + shift, runs["opened"].to_numpy()[at]


def number_segments(parts: DataFrame, keys: Sequence[str], order: Sequence[str], size: str,
                    rule: Rule, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the segments of ordered parts of groups.

    Result: keys, order, ``seg_no`` from 0, ``is_first`` for the first part of a
    group and ``last_seg``.  A segment that is left empty by an oversized first
    part is one more row, whose last order column is -1.
    """
    keys, order, chunk = list(keys), list(order), "chunk"
    key_fields = [parts.schema[k] for k in keys]
    # Written down before the sort, whose sampling would cut the texts once more.
    narrow = checkpointed(parts.select(*keys, *order, size))
    if narrow.groupBy(*keys, *order).count().where("count > 1").head(1):
        raise ValueError(f"the order must be unique within {keys}")
    sorted_sizes = with_ordinal(narrow, [*keys, *order], "ordinal")
    sizes = sorted_sizes.select(*keys, *order, size, block_of("ordinal", chunk_rows).alias(chunk))
    spans = sizes.groupBy(*keys).agg(F.min(chunk).alias("low"), F.max(chunk).alias("high"))
    large = spans.where(F.col("low") < F.col("high")).select(*keys, F.lit(True).alias("is_large"))
    # Marked without dealing the rows by group, so that no task gets all chunks of a large one.
    of_large = lookup_join(sizes, large, keys, "inner", order).drop("is_large")

    def keyed(frame: pd.DataFrame, group: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        for name in reversed(names):
            frame.insert(0, name, group[name].iloc[0])
        return frame

    def schema(*columns: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*key_fields, *[T.StructField(n, t) for n, t in columns]])

    def chunks_of(group: pd.DataFrame, unit: str):
        return group.sort_values([unit, "low"]).groupby(unit, sort=True)

    number_, flag = T.LongType(), T.BooleanType()
    outcome = (("low", number_), ("end_level", number_), ("opened", number_), ("moves", flag))
    entry = (("level", number_), ("base", number_), ("starts_group", flag), ("last_seg", number_))

    def describe(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(order)[size].to_numpy()
        return keyed(outcome_runs(rule, ordered), group, [*keys, "block", chunk])

    runs = (of_large.withColumn("block", block_of(chunk, BLOCK_CHUNKS))
                 .groupBy(*keys, "block", chunk)
                 .applyInPandas(describe, schema(("block", number_), (chunk, number_), *outcome)))

    def describe_block(group: pd.DataFrame) -> pd.DataFrame:
        together = chained_runs(rule, [r for _, r in chunks_of(group, chunk)])
        return keyed(together, group, [*keys, "block"])

    blocks = runs.groupBy(*keys, "block").applyInPandas(
        describe_block, schema(("block", number_), *outcome))

    def chain(units: pd.DataFrame, unit: str, level: int, base: int, starts: bool) -> pd.DataFrame:
        rows = []
        for at, (number, unit_runs) in enumerate(chunks_of(units, unit)):
            rows.append((number, level, base, starts and at == 0))
            level, opened = (int(x) for x in after_chunk(level, unit_runs))
            base += opened
        return pd.DataFrame(rows, columns=[unit, "level", "base", "starts_group"]).assign(last_seg=base)

    def chain_blocks(group: pd.DataFrame) -> pd.DataFrame:
        return keyed(chain(group, "block", rule.initial, 0, True), group, keys)

    block_starts = blocks.groupBy(*keys).applyInPandas(
        chain_blocks, schema(("block", number_), *entry))

    def chain_chunks(group: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        first = start.iloc[0]
        inside = chain(group, chunk, int(first["level"]), int(first["base"]), bool(first["starts_group"]))
        return keyed(inside.assign(last_seg=first["last_seg"]), group, keys)

    starts = (runs.groupBy(*keys, "block").cogroup(block_starts.groupBy(*keys, "block"))
                  .applyInPandas(chain_chunks, schema((chunk, number_), *entry)))

    def number(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order)
        whole = bool(pd.isna(group["level"].iloc[0]))
        starts_group = whole or bool(group["starts_group"].iloc[0])
        level = np.array([rule.initial if whole else int(group["level"].iloc[0])])
        seg = 0 if whole else int(group["base"].iloc[0])
        numbers = []
        for part_size in group[size]:
            level, opens = rule.step(level, int(part_size))
            seg += int(opens[0])
            numbers.append(seg)
        group["seg_no"] = numbers
        group["is_first"] = np.arange(len(group)) == (0 if starts_group else -1)
        if whole:
            group["last_seg"] = seg
        if starts_group and numbers[0] > 0:
            # The first part left an empty segment behind.
            empty = group.iloc[[0]].assign(seg_no=0, is_first=False, **{order[-1]: -1})
            group = pd.concat([empty, group])
        return group[out.fieldNames()]

    out = T.StructType([*key_fields, *[parts.schema[o] for o in order], T.StructField("seg_no", number_),
                        T.StructField("is_first", flag), T.StructField("last_seg", number_)])
    return (sizes.join(starts, [*keys, chunk], "left")
                 .groupBy(*keys, chunk).applyInPandas(number, out))


PLACE = ["part_order", "part_pos"]


def _cut(df: DataFrame, keys: Sequence[str], order: str, text: str, pieces: Column) -> DataFrame:
    """Parts of the non-null texts of groups that have a key."""
    for name in (*keys, text):
        df = df.where(F.col(name).isNotNull())
    return df.select(*keys, F.col(order).alias("part_order"),
                     F.posexplode(pieces).alias("part_pos", "part"))


def pack_by_chars(df: DataFrame, keys: Sequence[str], order: str, text: str, limit: int = 3000,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Pack the texts of a group, joined by ``###``, into segments of at most ``limit`` characters.

    Result: keys, ``seg_no`` from 1, ``segment``.  Null texts are skipped; markers
    inside a text separate parts as well.  An oversized part forms a segment of
    its own, after an empty one when it comes first.
    """
    parts = _cut(df, keys, order, text, F.split(F.col(text), MARKER))
    numbered = number_segments(parts.withColumn("size", F.length("part")), keys, PLACE, "size",
                               by_chars(limit), chunk_rows)
    filled = numbered.join(parts, [*keys, *PLACE], "left").groupBy(*keys, "seg_no").agg(
        F.coalesce(joined(F.col("part"), F.struct(*PLACE), MARKER), F.lit("")).alias("segment"),
        F.max("last_seg").alias("last_seg"))
    # Empty parts at the start of a segment leave no separator.
    filled = filled.withColumn("segment", F.regexp_replace("segment", f"^({MARKER})+", ""))
    kept = filled.where((F.col("segment") != "") | (F.col("seg_no") < F.col("last_seg")))
    return kept.select(*keys, (F.col("seg_no") + 1).alias("seg_no"), "segment")


def pack_by_words(df: DataFrame, keys: Sequence[str], order: str, text: str, limit: int = 3000,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Pack the texts of a group, joined by `` ### ``, into segments that end at a marker
    once they hold ``limit`` words.

    Result: keys, ``seg_no`` from 1, ``segment`` with words joined by one blank.
    """
    # Every word gets blanks of its own, so that neighbouring markers separate too.
    spaced = F.concat(F.lit(" "), F.array_join(tx.blank_tokens(F.col(text)), "  "), F.lit(" "))
    pieces = F.transform(F.split(spaced, f" {MARKER} "),
                         lambda p: F.array_join(tx.blank_tokens(p), " "))
    parts = _cut(df, keys, order, text, pieces)
    sized = parts.withColumn("size", F.size(tx.blank_tokens(F.col("part"))))
    numbered = number_segments(sized, keys, PLACE, "size", by_words(limit), chunk_rows)
    marked = F.when(F.col("is_first"), F.nullif("part", F.lit(""))).otherwise(
        F.concat_ws(" ", F.lit(MARKER), F.nullif("part", F.lit(""))))
    segments = (numbered.join(parts, [*keys, *PLACE], "left").withColumn("part", marked)
                        .groupBy(*keys, "seg_no").agg(F.coalesce(
                            joined(F.col("part"), F.struct(*PLACE), " "), F.lit("")).alias("segment")))
    return segments.where(F.col("segment") != "").withColumn("seg_no", F.col("seg_no") + 1)
