"""Dense vectors: nearest neighbours of a question table, similarity of neighbours in order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cosine
from ..session import checkpointed
from . import cells
from .cells import SCORES, best, unit
from .ordering import dense_ordinals

# Question vectors that are sent to every task; more are compared by cells.
QUESTION_BLOCK = 4096


def nearest(corpus: DataFrame, questions: DataFrame, n: int = 10, decimals: int = 6) -> DataFrame:
    """The n corpus vectors of greatest cosine per question vector, exactly.

    ``corpus`` has (vec_id, embedding), ``questions`` (query_id, embedding).
    Scores are matrix products inside tasks; a task hands on only its n best per
    question.  Up to ``QUESTION_BLOCK`` questions, counted first, travel to the
    tasks and the corpus is not shuffled.  More questions are compared by cells
    (``cells.nearest``).  Rows without a vector have no match.
    """
    corpus = corpus.where(F.col("embedding").isNotNull())
    questions = questions.where(F.col("embedding").isNotNull())
    head = questions.limit(QUESTION_BLOCK + 1).select("query_id", "embedding").toPandas()
    if len(head) > QUESTION_BLOCK:
        return cells.nearest(corpus, questions, n, decimals).rows
    return cells.top(_against_few(corpus, head, n, decimals), n)


def _against_few(corpus: DataFrame, questions: pd.DataFrame, n: int, decimals: int) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast((
        questions["query_id"].to_numpy(),
        unit(questions["embedding"]) if len(questions) else np.zeros((0, 1))))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked_ids, asked = shared.value
        kept = None
        for frame in frames:
            if not len(frame) or not len(asked):
                continue
            scores = asked @ unit(frame["embedding"]).T
            found = best(asked_ids, frame["vec_id"].to_numpy(), scores, n, decimals)
            kept = found if kept is None else pd.concat([kept, found])
            kept = kept.sort_values(["score", "vec_id"], ascending=[False, True],
                                    kind="stable").groupby("query_id").head(n)
        if kept is not None:
            yield kept

    return corpus.select("vec_id", "embedding").mapInPandas(compare, SCORES)


def neighbour_similarity(df: DataFrame, keys: Sequence[str], order: str,
                         vector: str = "embedding") -> DataFrame:
    """Cosine of each vector with the next one of its group; the last one has none.

    ``order`` must be unique per key.  Rows get places without gaps, on their narrow columns; a
    row's successor stands one place further, and its vector is fetched by key and order.  Every
    join key is unique, so no task gets a whole group.
    """
    keys = list(keys)
    placed = checkpointed(dense_ordinals(df, keys, order))
    after = placed.select(*keys, F.col(order).alias("next_id"), (F.col("ordinal") - 1).alias("ordinal"))
    pairs = placed.join(after, [*keys, "ordinal"], "left").drop("ordinal")
    own = df.select(*keys, order, vector)
    following = df.select(*keys, F.col(order).alias("next_id"), F.col(vector).alias("next_vector"))
    joined = own.join(pairs, [*keys, order]).join(following, [*keys, "next_id"], "left")
    return joined.select(*keys, order, "next_id", cosine(F.col(vector), F.col("next_vector")).alias("similarity"))
