"""Overlapping token windows of documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.binding import let

# Window size, overlap and the least length of a later window.
SIZE, OVERLAP, LEAST = 512, 50, 128


def window_count(length: Column, size: int = SIZE, overlap: int = OVERLAP,
                 least: int = LEAST) -> Column:
    """How many windows a document of ``length`` tokens has; the first always counts."""
    stride = size - overlap
    return F.greatest(F.floor((length - least) / stride), F.lit(0)).cast("int") + 1


def window_arrays(tokens: Column, size: int = SIZE, overlap: int = OVERLAP,
                  least: int = LEAST, keep_tail: bool = False) -> Column:
    """Array of token windows of a token array, cut inside the row.

    Last tokens too few for a window of their own are left out or, with ``keep_tail``, added to
    the last window.
    """
    stride = size - overlap

    def cut(t: Column, last: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(
            t, k * stride + 1, F.when((k == last) & F.lit(keep_tail), F.size(t)).otherwise(F.lit(size))))

    return let(tokens, lambda t: let(
        window_count(F.size(t), size, overlap, least) - 1, lambda last: cut(t, last)))


def token_windows(df: DataFrame, keys: Sequence[str], text: str = "content", size: int = SIZE,
                  overlap: int = OVERLAP, least: int = LEAST, limit: int | None = None,
                  tokenize: Callable[[Column], Column] = tx.blank_tokens,
                  keep_tail: bool = False) -> DataFrame:
    """One row per window: keys, ``seg_no`` from 1, ``token_len`` of the document, ``tokens``.

    ``keep_tail`` adds last tokens too few for a window to the last one.  Whole
    documents are cut unless ``limit`` names a model's input limit.
    Documents without text have no window.
    """
    tokens = tokenize(F.col(text))
    if limit is not None:
        tokens = F.slice(tokens, 1, limit)
    cut = let(tokens, lambda t: F.struct(
        F.size(t).alias("token_len"), window_arrays(t, size, overlap, least, keep_tail).alias("windows")))
    cut_rows = df.where(F.col(text).isNotNull()).select(*keys, cut.alias("cut"))
    return cut_rows.select(
        *keys, F.col("cut.token_len").cast("bigint").alias("token_len"),
        F.posexplode("cut.windows").alias("seg_no", "tokens"),
    ).withColumn("seg_no", (F.col("seg_no") + 1).cast("bigint"))


def longest_document(df: DataFrame, text: str = "content",
                     tokenize: Callable[[Column], Column] = tx.blank_tokens) -> DataFrame:
    """Greatest token count and the window count it needs, for reporting."""
    return (df.agg(F.max(F.size(tokenize(F.col(text)))).cast("bigint").alias("max_token_len"))
              .withColumn("max_windows", window_count(F.col("max_token_len")).cast("bigint")))
