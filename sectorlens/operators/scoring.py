"""Scorers: what stands where a hosted or pretrained model answers.

A scorer is either a column function, which stays JVM-side, or a batch function
over an iterator of pandas frames, for models that are loaded once per task.
Column scorers are the deterministic defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric, wordlists
from ..functions import text as tx

ColumnScorer = Callable[[Column], Column]
BatchScorer = Callable[[pd.Series], Iterable]


def score_in_batches(df: DataFrame, inputs: str, output: str, output_type: T.DataType,
                     make_scorer: Callable[[], BatchScorer], batch_size: int = 8,
                     attempts: int = 2) -> DataFrame:
    """Apply a model to a text column, batch by batch.

    ``make_scorer`` runs once per task and returns a function from a batch of
    texts to their results.  Rows with a null text get a null result.  A failing
    batch is tried again, then row by row, so that ``error`` is filled only for
    the rows that fail themselves; every row is kept, with its keys.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, output_type),
                           T.StructField("error", T.StringType())])

    def attempt(scorer: BatchScorer, texts: pd.Series) -> tuple[list | None, str | None]:
        problem = None
        for _ in range(attempts):
            try:
                return list(scorer(texts)), None
            except Exception as failure:  # the row is kept and reported
                problem = f"{type(failure).__name__}: {failure}"
        return None, problem

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            results: list = [None] * len(frame)
            errors: list = [None] * len(frame)
            present = [i for i, t in enumerate(frame[inputs]) if not pd.isna(t)]
            for at in range(0, len(present), batch_size):
                batch = present[at:at + batch_size]
                answers, problem = attempt(scorer, frame[inputs].iloc[batch])
                if problem is None:
                    for i, answer in zip(batch, answers):
                        results[i] = answer
                    continue
                for i in batch:
                    answers, errors[i] = attempt(scorer, frame[inputs].iloc[[i]])
                    results[i] = None if answers is None else answers[0]
            yield frame.assign(**{output: results, "error": errors})

    return df.mapInPandas(run, schema)


def failures(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Failure log of :func:`score_in_batches`."""
    return scored.where(F.col("error").isNotNull()).select(*keys, "error")


def lexicon_polarity(text: Column, positive: Sequence[str] = wordlists.POSITIVE_WORDS,
                     negative: Sequence[str] = wordlists.NEGATIVE_WORDS,
                     scale: float = 10.0) -> Column:
    """Deterministic sentiment in [-1, 1] from the shares of lexicon words.

    The shares, scaled, are the logits of positive and negative beside a neutral
    logit of one; the score follows the model contract: probability of positive
    minus probability of negative, three decimals.
    """
    tokens = F.transform(tx.words(text), F.lower)
    hits = F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("up"), F.lit(0).alias("down")),
        lambda s, w: F.struct((s["n"] + 1).alias("n"),
                              (s["up"] + w.isin(*positive).cast("int")).alias("up"),
                              (s["down"] + w.isin(*negative).cast("int")).alias("down")),
        lambda s: F.when(s["n"] > 0, numeric.polarity(
            s["down"] * scale / s["n"], F.lit(1.0), s["up"] * scale / s["n"])).otherwise(0.0))
    return F.when(text.isNotNull(), hits)
