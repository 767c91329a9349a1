"""Order as data: ordinals, first rows per group and ordered concatenation.

Rows of a distributed table have no order, so every operator whose result
depends on one takes an order column.  None of them gathers a whole group in
one task: a hot group may hold a third of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .joins import is_small, lookup_join

# Rows of one group that are put together in one task at most.
CHUNK_ROWS = 1000


def block_of(order: str, rows: int = CHUNK_ROWS) -> Column:
    """Block of ``rows`` consecutive values that an integer order value lies in."""
    return F.expr(f"`{order}` div {rows}")


def with_ordinal(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Add a bigint that rises in the given order, for keys that are no integers.

    A range sort spreads any key over all tasks.  The sorted rows are written to
    the checkpoint folder, because the ordinals depend on the range boundaries
    and those may move when a lost task is computed again.
    """
    return checkpointed(df.orderBy(*order)).withColumn(name, F.monotonically_increasing_id())


def dense_ordinals(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys, order and ``ordinal``: the row's place in the table sorted by keys and order, from 0.

    Places follow each other without gaps, whatever the values of ``order``, which must be unique
    per key.  Only these narrow columns are sorted.  A task's rows are counted, one number per
    task, to know where its places begin.
    """
    narrow = checkpointed(df.select(*keys, order))
    if narrow.groupBy(*keys, order).count().where("count > 1").head(1):
        raise ValueError(f"the order column {order} must be unique within {list(keys)}")
    ordered = checkpointed(narrow.orderBy(*keys, order)).withColumns({
        "_task": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    counts = ordered.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_task", (F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")).alias("_before"))
    return ordered.join(F.broadcast(before), "_task").select(
        *keys, order, (F.col("_before") + F.col("_place")).alias("ordinal"))


def with_pages(df: DataFrame, keys: Sequence[str], order: str, rows: int = CHUNK_ROWS,
               name: str = "page_no") -> DataFrame:
    """Number pages of ``rows`` rows that follow each other in their group, from 0."""
    placed = dense_ordinals(df, keys, order)
    starts = checkpointed(placed.groupBy(*keys).agg(F.min("ordinal").alias("_start")))
    paged = lookup_join(placed, starts, keys, "inner", [order]).select(
        *keys, order, F.expr(f"(ordinal - _start) div {rows}").alias(name))
    return df.join(paged, [*keys, order])


def first_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the first row per key; ``order`` must be unique per key.

    The winners are found on the narrow columns with a map-side combined
    minimum, written down and counted.  When they are few, the wide rows are
    filtered where they lie; else they are joined by key and order, which is
    unique.  Rows with a null key are dropped.
    """
    present = df.where(_all_present(keys))
    winners = checkpointed(present.groupBy(*keys).agg(F.min(order).alias(order)))
    if is_small(winners):
        winners = F.broadcast(winners)
    return present.join(winners, [*keys, order], "left_semi")


def first_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 order: str) -> DataFrame:
    """First non-null value of each column per key, in the given order.

    One aggregation with partial combine; a group without any value gives null.
    """
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.where(_all_present(keys)).groupBy(*keys).agg(*picks)


def ordered_text(df: DataFrame, keys: Sequence[str], order: str, text: str, separator: str,
                 name: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Join the non-null texts of a group in order, in pages of bounded size.

    Result: keys, ``page_no`` and the joined text.  A page covers ``chunk_rows``
    rows that follow each other in the group, so no task ever holds more rows of a
    group than that; joining a group's pages in page order with the separator
    gives the whole text.  A page without text gives the empty string.  A
    ``chunk_rows`` of at least the largest group gives one row per group.
    """
    present = df.where(_all_present(keys)).select(*keys, order, text)
    return (with_pages(present, keys, order, chunk_rows)
              .groupBy(*keys, "page_no")
              .agg(F.coalesce(joined(F.col(text), F.col(order), separator), F.lit("")).alias(name)))


def digests(pages: DataFrame, keys: Sequence[str], order: str, text: str) -> DataFrame:
    """Length and MD5 of texts given in pages: keys, ``n_chars``, ``md5``.

    The pages of a text pass in order through one task, as MD5 reads a text from start to end,
    but are never put together: the task holds a batch of them.
    """
    keys = list(keys)
    schema = T.StructType([*[pages.schema[k] for k in keys], T.StructField("n_chars", T.LongType()),
                           T.StructField("md5", T.StringType())])
    in_order = pages.repartition(*keys).sortWithinPartitions(*keys, order).select(
        *keys, F.length(text).cast("bigint"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, types, size, digest = None, None, 0, None

        def finished() -> pa.RecordBatch:
            values = [*now, size, digest.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], schema.fieldNames())

        for batch in batches:
            types = [*batch.schema.types[:len(keys)], pa.int64(), pa.string()]
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            for *key, length, part in zip(*columns, batch.columns[-1]):
                if key != now:
                    if now is not None:
                        yield finished()
                    now, size, digest = key, 0, hashlib.md5()
                if part.is_valid:
                    size += length
                    digest.update(part.as_buffer())
        if now is not None:
            yield finished()

    return in_order.mapInArrow(run, schema)


def joined(value: Column, order: Column, separator: str) -> Column:
    """Aggregate: join non-null values in order.  For groups of bounded size only."""
    items = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(
        order.alias("o"), value.cast("string").alias("v")))))
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda i: i["v"]), separator))


def joined_together(values: dict[str, Column], order: Column, separator: str) -> list[Column]:
    """Aggregates that join several columns in one common order, so they stay aligned.

    Null values keep their place as empty text.  For groups of bounded size only.
    """
    row = F.struct(order.alias("o"), *[
        F.coalesce(v.cast("string"), F.lit("")).alias(n) for n, v in values.items()])
    rows = F.array_sort(F.collect_list(row))
    return [F.array_join(rows[n], separator).alias(n)
            for n in values]


def _all_present(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
