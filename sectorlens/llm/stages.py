"""Stages written to the shared folder, and the tokenizer files' place."""

from __future__ import annotations

import gc
import importlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

# The folders stored in the innermost open scratch, if one is open.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def _written(df: DataFrame, owner: list[str] | None) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    if owner is not None:
        owner.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored(df: DataFrame) -> DataFrame:
    """Write a stage as Parquet in the checkpoint folder and go on from there.

    Unlike a checkpoint of rows it is compressed and read by column.  It lies in the folder all
    executors share, so it outlives any of them.
    """
    return _written(df, _scratch.get())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stages stored inside the block are removed at its end.

    The block gets a function that stores what outlives it.  What leaves the block must have gone
    through that function: any other DataFrame made inside may read what is removed.
    """
    outer, inner = _scratch.get(), []
    mark = _scratch.set(inner)
    try:
        yield lambda df: _written(df, outer)
    finally:
        _scratch.reset(mark)
        for folder in inner:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        let_go(spark)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let Arrow batches of this session hold at most so many rows.

    Batches are counted in rows, and rows of whole texts are large on both sides of the transfer.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def let_go(spark: SparkSession) -> None:
    """Have the driver look for what nothing refers to: shuffle files of finished jobs go with it.

    Spark removes them when the driver's JVM collects garbage, which a long job of small plans hardly causes.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the table does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    return importlib.import_module("public_tokenizers").path(name)
