"""Joins against side tables whose keys may be hot or whose size is unknown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

# Rows up to which a side table, narrow by nature, is sent to every task.
BROADCAST_ROWS = 50_000
# A key is hot when it holds more than one in HOT_SHARE rows.  Fewer than
# HOT_SHARE keys can do so whatever the data, which bounds their broadcast.
HOT_SHARE = 1000
# Tasks over which the rows of one hot key are spread.
SALTS = 64


def is_small(side: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``rows`` rows.  Runs a job that stops counting there."""
    return side.limit(rows + 1).count() <= rows


def lookup_join(facts: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left",
                spread_by: Sequence[str] | None = None,
                key_rows: DataFrame | None = None) -> DataFrame:
    """Join facts with a side table that has few rows per key, whatever its size.

    The side's rows are counted first.  A small side is broadcast, and the facts
    stay where they are.  A larger one is shuffled with the facts, and the rows
    of hot keys are spread over tasks, see :func:`spread_join`.
    """
    if is_small(side):
        return facts.join(F.broadcast(side), list(on), how)
    return spread_join(facts, side, on, how, spread_by, key_rows)


def spread_join(facts: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left",
                spread_by: Sequence[str] | None = None,
                key_rows: DataFrame | None = None) -> DataFrame:
    """Shuffle join in which no hot key ends up in one task.

    The fact rows of a hot key are spread over ``SALTS`` tasks by a hash of
    ``spread_by`` (default: the whole row) and its side rows are repeated that
    often; all other keys join as usual.  Only the hot keys themselves, fewer than
    ``HOT_SHARE``, are broadcast.  ``key_rows`` may pass in known counts per key
    (keys and ``key_rows``); otherwise they take one pass over the key columns.
    """
    on = list(on)
    if key_rows is None:
        key_rows = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("key_rows"))
    limit = key_rows.agg((F.sum("key_rows") / HOT_SHARE).alias("limit"))
    hot = F.broadcast(key_rows.where(F.col("key_rows") > limit.scalar())
                      .select(*on, F.lit(True).alias("is_hot")))
    spread = F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(SALTS)).cast("int")
    salted_facts = facts.join(hot, on, "left").withColumn(
        "salt", F.when(F.col("is_hot"), spread).otherwise(F.lit(0))).drop("is_hot")
    all_salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_side = side.join(hot, on, "left").withColumn(
        "salt", F.explode(F.when(F.col("is_hot"), all_salts).otherwise(F.array(F.lit(0))))
    ).drop("is_hot")
    columns = [*facts.columns, *[c for c in side.columns if c not in on]]
    return salted_facts.join(salted_side, [*on, "salt"], how).select(*columns)


def with_group_values(df: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None = None,
                      **aggregates: Column) -> DataFrame:
    """Repeat per-group aggregates on every row of the group.

    Equals a whole-partition window, but no task receives a whole group: the
    aggregates are combined map-side, written down once, and joined back by
    :func:`lookup_join`.  Rows with a null key get null aggregates.
    """
    keys = list(keys)
    values = checkpointed(df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("key_rows"), *[c.alias(n) for n, c in aggregates.items()]))
    return lookup_join(df, values.drop("key_rows"), keys, "left", spread_by,
                       values.select(*keys, "key_rows"))
