"""Segmentation of one text by the similarity of its sentences."""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

THRESHOLD = 0.9
Embedder = Callable[[list[str]], np.ndarray]


def hashed_counts(texts: list[str], width: int = 256) -> np.ndarray:
    """An additive embedder of fixed width: counts of hashed words, so the vector of a joined text is the sum."""
    vectors = np.zeros((len(texts), width))
    for row, text in enumerate(texts):
        for word in text.lower().split():
            vectors[row, zlib.crc32(word.strip(".,;:!?").encode()) % width] += 1
    return vectors


def _cosine(left: np.ndarray, right: np.ndarray) -> float:
    norm = np.linalg.norm(left) * np.linalg.norm(right)
    return float(left @ right / norm) if norm > 0 else 0.0


class ExactCounts:
    """Likeness of paragraphs by their exact word counts; a joined paragraph's counts are the sums."""

    def measures(self, sentences: list[str]) -> list[tuple[Counter, int]]:
        counts = [Counter(w.strip(".,;:!?") for w in s.lower().split()) for s in sentences]
        return [(c, sum(n * n for n in c.values())) for c in counts]

    @staticmethod
    def _dot(left: Counter, right: Counter) -> int:
        small, large = (left, right) if len(left) <= len(right) else (right, left)
        return sum(n * large[w] for w, n in small.items() if w in large)

    def likeness(self, left: tuple[Counter, int], right: tuple[Counter, int]) -> float:
        norm = math.sqrt(left[1]) * math.sqrt(right[1])
        return self._dot(left[0], right[0]) / norm if norm > 0 else 0.0

    def joined(self, left: tuple[Counter, int], right: tuple[Counter, int], sentences: list[str],
               begin: int, end: int) -> tuple[Counter, int]:
        square = left[1] + right[1] + 2 * self._dot(left[0], right[0])
        large, small = (left[0], right[0]) if len(left[0]) >= len(right[0]) else (right[0], left[0])
        large.update(small)
        return large, square


class Embedded:
    """Likeness by an embedder's vectors; additive ones are summed, others embed the joined text."""

    def __init__(self, embed: Embedder, additive: bool):
        self.embed, self.additive = embed, additive

    def measures(self, sentences: list[str]) -> list[np.ndarray]:
        return list(self.embed(sentences))

    def likeness(self, left: np.ndarray, right: np.ndarray) -> float:
        return _cosine(left, right)

    def joined(self, left: np.ndarray, right: np.ndarray, sentences: list[str], begin: int,
               end: int) -> np.ndarray:
        return left + right if self.additive else self.embed([" ".join(sentences[begin:end])])[0]


def split_paragraphs(sentences: list[str], wanted: int, threshold: float, embed: Embedder | None = None,
                     additive: bool = False) -> list[str]:
    """Paragraphs of neighbouring alike sentences, merged down to ``wanted``.

    With no more sentences than wanted, the whole text is repeated ``wanted`` times.  Without an
    embedder, paragraphs are compared by exact word counts.  The most similar neighbours, the
    first of equally similar ones, come from a heap over a linked list: a merge asks for the
    likeness of two pairs only, and outdated entries are passed over.
    """
    if len(sentences) <= wanted:
        return [" ".join(sentences)] * wanted
    by = ExactCounts() if embed is None else Embedded(embed, additive)
    begin: list[int] = []
    measure: list = []
    for at, one in enumerate(by.measures(sentences)):
        if begin and by.likeness(measure[-1], one) >= threshold:
            measure[-1] = by.joined(measure[-1], one, sentences, begin[-1], at + 1)
        else:
            begin.append(at)
            measure.append(one)
    count = len(begin)
    end = [*begin[1:], len(sentences)]
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    # A pair is current while its version, counted at its left paragraph, is.
    version, gone = [0] * count, [False] * count

    def entry(left: int) -> tuple[float, int, int]:
        # Pairs without any likeness are merged from the front.
        return -max(by.likeness(measure[left], measure[after[left]]), 0.0), left, version[left]

    heap = [entry(i) for i in range(count - 1)]
    heapq.heapify(heap)
    while count > wanted:
        _, left, seen = heapq.heappop(heap)
        if gone[left] or version[left] != seen:
            continue
        right = after[left]
        measure[left] = by.joined(measure[left], measure[right], sentences, begin[left], end[right])
        measure[right], gone[right] = None, True
        end[left], after[left] = end[right], after[right]
        count -= 1
        version[left] += 1
        if after[left] < len(begin):
            before[after[left]] = left
            heapq.heappush(heap, entry(left))
        if before[left] >= 0:
            version[before[left]] += 1
            heapq.heappush(heap, entry(before[left]))
    return [" ".join(sentences[b:e]) for b, e, out in zip(begin, end, gone) if not out]


def semantic_segments(df: DataFrame, text: str = "text", images: str = "images",
                      threshold: float = THRESHOLD, make_embedder: Callable[[], Embedder] | None = None
                      ) -> DataFrame:
    """Cut each text into at most ``images`` + 1 paragraphs: adds ``seg_no`` and ``segment``.

    Sentences are split JVM-side; a row's text is folded inside its own row, so
    there is no shuffle and no group.  ``make_embedder`` loads a model once per task;
    without it sentences are compared by exact word counts.
    """
    columns = [c for c in df.columns if c != text]
    ready = df.select(*columns, tx.sentences(F.col(text)).alias("sentences"))
    schema = T.StructType([*[df.schema[c] for c in columns],
                           T.StructField("segments", T.ArrayType(T.StringType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = None if make_embedder is None else make_embedder()
        for frame in frames:
            cut = [split_paragraphs(list(s), int(i) + 1, threshold, embed)
                   for s, i in zip(frame["sentences"], frame[images].fillna(0))]
            yield frame[columns].assign(segments=cut)

    rows = ready.where(F.col("sentences").isNotNull()).mapInPandas(run, schema)
    return rows.select(*columns, F.posexplode("segments").alias("seg_no", "segment")) \
               .withColumn("seg_no", (F.col("seg_no") + 1).cast("bigint"))
