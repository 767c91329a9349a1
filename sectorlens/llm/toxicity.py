"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled, so token labels come from them: over the labelled sample, words and
word beginnings that are clearly more frequent in toxic documents carry evidence, and in a toxic
document the words with evidence are the toxic ones.  The field has two states; its features are
a word's evidence and that of its neighbours.  Forward-backward runs over all words of a batch at
once: a message is a ratio, a step a fractional linear map, and the maps of a block are composed
before the blocks are chained.  A logistic regression turns a document's marginals into a score.

Everything is fitted on a bounded sample of labelled rows (``Limits``); every document is scored,
where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import stored
from .words import NOT_LETTERS, Words, mixed, slices, words_of


@dataclass(frozen=True)
class Limits:
    """Bounds of the fitted sample: labelled rows, documents of the field and their words."""

    rows: int = 40_000
    documents: int = 600
    words: int = 5000


BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 8)
LEAST_TOXIC, LEAST_LIFT = 6, 20.0


def held_out(id_column: str) -> Column:
    """Rows that are never learned from: the checksum of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def features(words: Words) -> np.ndarray:
    """Buckets of each word and of its first bytes: one row per kind of feature."""
    found = [words.hash]
    total = np.zeros(len(words.hash), np.uint64)
    sizes = words.end - words.start
    for place in range(max(PREFIXES)):
        inside = np.flatnonzero(sizes > place)
        total[inside] = mixed(total[inside] + words.data[words.start[inside] + place] + np.uint64(1))
        if place + 1 in PREFIXES:
            # A shorter word has no beginning of this length and falls back to itself.
            found.append(np.where(sizes > place, mixed(total, place + 1), words.hash))
    return np.stack([(f % np.uint64(BUCKETS)).astype(np.int64) for f in found])


def evidence(words: Words, weights: np.ndarray) -> np.ndarray:
    """Greatest weight of a word's features."""
    return weights[features(words)].max(axis=0) if len(words.hash) else np.zeros(0)


def scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """r[t] = (a + b r[t-1]) / (c + d r[t-1]) for all t, from r[-1] = 0, without a loop over t.

    The steps are laid out in blocks; all blocks are composed at once, chained one by one, and
    then run at once from their first value.
    """
    count = len(a)
    width = max(1, int(np.sqrt(count / 4)))
    height = -(-count // width)
    pad = height * width - count

    def laid(x: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([x, np.full(pad, fill)]).reshape(height, width).T.copy()

    a, b, c, d = laid(a, 0), laid(b, 1), laid(c, 1), laid(d, 0)
    pb, pa_, pd, pc = np.ones(height), np.zeros(height), np.zeros(height), np.ones(height)
    for t in range(width):
        pb, pa_, pd, pc = (b[t] * pb + a[t] * pd, b[t] * pa_ + a[t] * pc,
                           d[t] * pb + c[t] * pd, d[t] * pa_ + c[t] * pc)
        scale = np.maximum(np.maximum(pb, pa_), np.maximum(pd, pc))
        pb, pa_, pd, pc = pb / scale, pa_ / scale, pd / scale, pc / scale
    start, r = np.zeros(height), 0.0
    for row, (xb, xa, xd, xc) in enumerate(zip(pb.tolist(), pa_.tolist(), pd.tolist(), pc.tolist())):
        start[row] = r
        r = (xb * r + xa) / (xd * r + xc)
    result = np.empty((width, height))
    now = start
    for t in range(width):
        now = (a[t] + b[t] * now) / (c[t] + d[t] * now)
        result[t] = now
    return result.T.reshape(-1)[:count]


@dataclass
class Field:
    """Weights of the emission features and of the transitions 0→1, 1→0 and 1→1."""

    emission: np.ndarray
    transition: np.ndarray

    @staticmethod
    def inputs(found: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per word: 1, evidence, whether there is any, and that of the neighbours in its text."""
        before, after = np.roll(found, 1), np.roll(found, -1)
        if len(found):
            before[first], after[-1] = 0, 0
            after[np.flatnonzero(first)[1:] - 1] = 0
        return np.stack([np.ones(len(found)), found, found > 0, before, after], axis=1)

    def messages(self, inputs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward ratio, backward ratio and emission factor of each word."""
        e = np.exp(np.clip(inputs @ self.emission, -30, 30))
        c01, c10, c11 = np.exp(np.clip(self.transition, -10, 10))
        one, go = np.ones(len(e)), ~first
        forward = scan(e * c01, e * c11 * go, one, c10 * go)
        last = np.append(first[1:], True)
        after = np.append(e[1:], 1.0)
        backward = scan(np.where(last, 1.0, c10)[::-1], (c11 * after * ~last)[::-1], one,
                        (c01 * after * ~last)[::-1])[::-1]
        return forward, backward, e

    def marginals(self, inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability that each word is toxic."""
        if not len(inputs):
            return np.zeros(0)
        forward, backward, _ = self.messages(inputs, first)
        both = forward * backward
        return both / (1 + both)

    def expected(self, inputs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected feature and transition counts."""
        forward, backward, e = self.messages(inputs, first)
        c01, c10, c11 = np.exp(np.clip(self.transition, -10, 10))
        prior = np.where(first, 0.0, np.append(0.0, forward[:-1]))
        p00, p01 = np.ones(len(e)), c01 * e * backward
        p10, p11 = prior * c10, prior * c11 * e * backward
        total = p00 + p01 + p10 + p11
        return inputs.T @ ((p01 + p11) / total), np.array(
            [(p01 / total).sum(), (p10 / total).sum(), (p11 / total).sum()])


def fitted_field(inputs: np.ndarray, first: np.ndarray, labels: np.ndarray,
                 steps: int = 60, rate: float = 0.3) -> Field:
    """Maximise the likelihood of the token labels by gradient steps of adapted size."""
    size = inputs.shape[1]
    weights, moment, square = np.zeros(size + 3), np.zeros(size + 3), np.zeros(size + 3)
    weights[0], weights[size:] = -2.0, (-1.0, 0.0, 0.0)
    prior = np.where(first, 0, np.append(0, labels[:-1]))
    seen = np.concatenate([inputs.T @ labels, [
        ((prior == 0) & (labels == 1)).sum(), ((prior == 1) & (labels == 0)).sum(),
        ((prior == 1) & (labels == 1)).sum()]])
    for step in range(1, steps + 1):
        field = Field(weights[:size], weights[size:])
        slope = (seen - np.concatenate(field.expected(inputs, first))) / len(labels) - 1e-4 * weights
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        weights = weights + rate * (moment / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    return Field(weights[:size], weights[size:])


@dataclass
class Model:
    """What scoring needs: evidence per bucket, the field, and the logistic regression."""

    buckets: np.ndarray
    values: np.ndarray
    field: Field
    logistic: np.ndarray

    def weights(self) -> np.ndarray:
        table = np.zeros(BUCKETS)
        table[self.buckets] = self.values
        return table


def _measures(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per text: 1, greatest marginal, logarithm of their sum, and share of toxic words."""
    most, total = np.zeros(n), np.bincount(row, weights=p, minlength=n)
    np.maximum.at(most, row, p)
    return np.stack([np.ones(n), most, np.log1p(total),
                     total / np.maximum(1, np.bincount(row, minlength=n))], axis=1)


def _first(words: Words) -> np.ndarray:
    return np.append(True, words.row[1:] != words.row[:-1])[:len(words.row)]


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          label: str = "toxic", limits: Limits = Limits()) -> Model:
    """Fit on labelled rows that are not held out, at most about ``limits.rows`` of them.

    The sample goes by a hash of the id, so it is the same however the tables are dealt; its ids
    and labels are few enough to be sent to every task, and its texts are read once.  Ids with a
    null label, or with several labels, count with the largest label that is not null.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column)) \
                  .groupBy(id_column).agg(F.max(label).cast("int").alias("y"))
    count = known.count()
    share = min(1.0, limits.rows / max(1, count))
    place = F.pmod(F.xxhash64(F.col(id_column), F.lit(5)), F.lit(1_000_000))
    chosen = known.where(place < int(share * 1_000_000))
    rows = stored(docs.select(id_column, F.col(text).alias("text")).join(
        F.broadcast(chosen), id_column).select("text", "y"))

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], NOT_LETTERS)
            if not len(words.row):
                continue
            y = np.asarray(batch["y"])
            pairs = np.unique((words.row * BUCKETS + features(words)).reshape(-1))
            bucket, toxic = pairs % BUCKETS, y[pairs // BUCKETS] == 1
            np.add.at(a, bucket[toxic], 1)
            np.add.at(b, bucket[~toxic], 1)
        seen = np.flatnonzero(a + b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (seen, a[seen], b[seen])], ["bucket", "a", "b"])

    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)
    lift = ((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1))
    marked = rows.mapInArrow(count_features, "bucket long, a long, b long") \
                 .groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")) \
                 .where((F.col("a") >= LEAST_TOXIC) & (lift >= LEAST_LIFT)) \
                 .select("bucket", F.log(lift).alias("value")).collect()
    buckets = np.array([r["bucket"] for r in marked], np.int64)
    values = np.array([r["value"] for r in marked], np.float64)
    model = Model(buckets, values, Field(np.zeros(5), np.zeros(3)), np.zeros(4))
    if not toxic or not clean:
        # Nothing to tell apart: every text gets the same score.
        model.logistic[0] = 5.0 if toxic else -5.0
        return model
    model.field = _train_field(rows, model, limits)
    model.logistic = _train_logistic(rows, model)
    return model


def _train_field(rows: DataFrame, model: Model, limits: Limits) -> Field:
    buckets, values = model.buckets, model.values

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Model(buckets, values, model.field, model.logistic).weights()
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], NOT_LETTERS)
            found, begin = evidence(words, table), words.first()
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array(
                [found[a:b] for a, b in zip(begin, begin[1:])], pa.list_(pa.float64()))], ["y", "e"])

    half = limits.documents // 2
    short = rows.where(F.size(F.split("text", " ")) <= limits.words)
    key = F.xxhash64("text")
    some = short.where("y = 1").orderBy(key).limit(half).unionAll(
        short.where("y <> 1").orderBy(key).limit(half))
    data = [(r["y"], np.array(r["e"])) for r in some.mapInArrow(sequences, "y int, e array<double>").collect()
            if len(r["e"])]
    if not data:
        return Field(np.array([-3.0, 1, 0, 0, 0]), np.array([-1.0, 0, 0]))
    found = np.concatenate([e for _, e in data])
    first = np.zeros(len(found), bool)
    first[np.cumsum([0, *[len(e) for _, e in data[:-1]]])] = True
    labels = np.concatenate([(e > 0) & (y == 1) for y, e in data]).astype(np.float64)
    return fitted_field(Field.inputs(found, first), first, labels)


def _measured(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.weights()
        for batch in slices(batches, "text"):
            words = words_of(batch["text"], NOT_LETTERS)
            first = _first(words)
            p = model.field.marginals(Field.inputs(evidence(words, table), first), first)
            m = _measures(p, words.row, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch["y"], *[pa.array(m[:, i]) for i in (1, 2, 3)]], ["y", "m1", "m2", "m3"])

    return rows.mapInArrow(run, "y int, m1 double, m2 double, m3 double")


def _train_logistic(rows: DataFrame, model: Model, steps: int = 25) -> np.ndarray:
    """Regularised logistic regression by Newton's method on the sample's three measures."""
    data = _measured(rows, model).toPandas().to_numpy(np.float64)
    y = (data[:, 0] == 1).astype(np.float64)
    x = np.concatenate([np.ones((len(data), 1)), data[:, 1:]], axis=1)
    weights = np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(4)
        weights = weights + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return weights


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text",
           keep: tuple[str, ...] = (), spans: bool = True) -> DataFrame:
    """Score every whole text: the id, ``score`` and, with ``spans``, the offending ``spans``.

    A span is a run of words more likely toxic than not: first character, the one after its last,
    and its greatest marginal.  Null and empty texts have no spans and the score of a text
    without toxic words.  Repeated rows are scored each.  ``keep`` names columns to carry along;
    other columns are ignored.
    """
    carried = [id_column, *keep]
    source = text if text in carried else "_text"
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried) + ", score double"
    schema += ", spans array<struct<start:int,end:int,score:double>>" if spans else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.weights()
        for batch in slices(batches, source):
            words = words_of(batch[source], NOT_LETTERS)
            first = _first(words)
            p = model.field.marginals(Field.inputs(evidence(words, table), first), first)
            m = _measures(p, words.row, len(batch))
            score = 1 / (1 + np.exp(-np.clip(m @ model.logistic, -30, 30)))
            columns, names = [batch[c] for c in carried] + [pa.array(score)], [*carried, "score"]
            if spans:
                columns.append(pa.array(_spans(words, p, first, len(batch)), pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*carried, *[F.col(text).alias(c) for c in [source] if c not in carried]) \
               .mapInArrow(run, schema)


def _spans(words: Words, p: np.ndarray, first: np.ndarray, n: int) -> list[list[dict]]:
    result: list[list[dict]] = [[] for _ in range(n)]
    on = p > 0.5
    begins = np.flatnonzero(on & (first | ~np.append(False, on[:-1])))
    if not len(begins):
        return result
    ends = np.flatnonzero(on & (np.append(first[1:], True) | ~np.append(on[1:], False)))
    # Characters are the bytes that do not continue one.
    before = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    for a, z in zip(begins.tolist(), ends.tolist()):
        row = int(words.row[a])
        origin = int(before[words.offsets[row]])
        result[row].append({"start": int(before[words.start[a]]) - origin,
                            "end": int(before[words.end[z]]) - origin, "score": float(p[a:z + 1].max())})
    return result
