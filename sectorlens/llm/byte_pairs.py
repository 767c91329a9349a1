"""Byte-level BPE: merges folded by Spark's higher-order functions over distinct words.

A text falls into words by the tokenizer's pattern, and each word is merged on its own.  Distinct
words are counted over all documents, and the most frequent ones, at most ``FREQUENT``, are merged
once in column expressions.  There a word is an array of its bytes, every byte as the Latin-1
character of that number, so that parts can be joined and compared as strings.  Ranks are a
literal: maps in an array, found by checksum.  ``aggregate`` folds the merges: each step joins the
leftmost pair of lowest rank.

The table of these words, of bounded size, goes to the tasks that read the texts.  They join the
ids by place, merge rarer words by a queue, once per word while a worker's own table holds it, and
decode ids by joining the pieces' bytes.  So no text is shuffled, and the bound on the table does
not show in the result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import importlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import stored, tokenizer_path
from .words import slices

RANKS = "byte_bpe_50k.tiktoken"
# Words that are merged once for all tasks, rarer ones that a worker keeps, maps that ranks are dealt to.
FREQUENT, TABLE, MAPS = 1 << 17, 300_000, 1 << 16
# Bytes beyond which a word counts as rare: folding takes time with the square of the length.
LONG = 160
_NONE = 2 ** 31 - 1


@functools.lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file: a piece in base64 and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}


def dealt(entries: dict[str, object], maps: int = MAPS) -> list[dict[str, object]]:
    """Entries in maps of a few each, by their key's checksum."""
    maps = min(maps, max(1, len(entries)))
    found: list[dict[str, object]] = [{} for _ in range(maps)]
    for key, value in entries.items():
        found[zlib.crc32(key.encode()) % maps][key] = value
    return found


class Lookup:
    """A literal map; the value of a key, or null."""

    def __init__(self, entries: dict[str, object], value: str):
        maps = dealt(entries)
        self.size, self.maps = len(maps), F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), f"array<map<string,{value}>>")

    def __call__(self, key: Column) -> Column:
        place = (F.crc32(key.cast("binary")) % self.size).cast("int")
        return F.element_at(F.get(self.maps, place), key)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Merges:
    """Expressions that encode words by a rank file."""

    def __init__(self, path: str):
        self.rank = Lookup({piece.decode("latin-1"): rank for piece, rank in ranks_of(path).items()}, "int")

    def _ranks(self, parts: Column, many: Column) -> Column:
        """The rank of each part joined with the next one; the last has none."""
        return F.zip_with(parts, F.slice(parts, 2, many), lambda left, right: F.coalesce(
            self.rank(F.concat(left, right)), F.lit(_NONE)))

    def fold(self, word: Column) -> Column:
        """Ids of a word, given as Latin-1 characters."""
        many, parts = F.length(word), F.split(word, "")

        def joined(state: Column, at: Column) -> Column:
            # The part at ``at`` (from 1) takes in the next one.
            fewer = F.filter(F.transform(state["parts"], lambda part, i: F.when(
                i == at - 1, F.concat(part, F.get(state["parts"], at))).otherwise(part)), lambda part, i: i != at)
            return F.when(F.get(state["ranks"], at - 1) == _NONE, state).otherwise(_let(
                fewer, lambda parts: F.struct(parts.alias("parts"), self._ranks(parts, many).alias("ranks"))))

        def step(state: Column, _: Column) -> Column:
            lowest = F.array_position(state["ranks"], F.array_min(state["ranks"])).cast("int")
            return _let(lowest, lambda at: joined(state, at))

        start = F.struct(parts.alias("parts"), self._ranks(parts, many).alias("ranks"))
        done = F.aggregate(F.sequence(F.lit(2), many), start, step)
        return _let(self.rank(word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(
            F.transform(done["parts"], self.rank)))

    def word_ids(self, word: Column) -> Column:
        """Ids of a word of a text."""
        return _let(F.decode(word.cast("binary"), "ISO-8859-1"), self.fold)


def queued(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word; time grows with its length times its logarithm."""
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    end, before = list(range(1, size + 1)), list(range(-1, size - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < size and (rank := ranks.get(word[a:end[b]])) is not None:
            heapq.heappush(queue, (rank, a, end[b]))

    for place in range(size - 1):
        offer(place)
    while queue:
        rank, a, stop = heapq.heappop(queue)
        b = end[a]
        if b <= 0 or b >= size or end[b] != stop:
            continue
        end[a], end[b] = stop, -1
        if stop < size:
            before[stop] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    found, a = [], 0
    while a < size:
        found.append(ranks[word[a:end[a]]])
        a = end[a]
    return found


def frequent_words(docs: DataFrame, ranks: str, cut: str, most: int) -> dict[str, list[int]]:
    """Ids of the most frequent words of all texts, ``most`` words at most."""
    merges = Merges(ranks)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?U)" + cut), F.lit(0))
    counted = stored(docs.select(F.explode(words).alias("word")).where(F.octet_length("word") <= LONG)
                     .groupBy("word").count().select("word", F.floor(8 * F.log2("count")).cast("int").alias("level")))
    total, lowest = 0, None
    for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > most:
            break
        lowest = row["level"]
    if lowest is None:
        return {}
    chosen = counted.where(F.col("level") >= lowest).select("word", merges.word_ids(F.col("word")).alias("ids"))
    found = chosen.toArrow()
    return dict(zip(found["word"].to_pylist(), found["ids"].to_pylist()))


class WordTable:
    """Ids of words: those handed over, and those that a worker has merged itself, ``size`` at most.

    An entry holds a word's decimal ids joined by spaces, their number, and the bytes they decode to.
    """

    def __init__(self, ranks: dict[bytes, int], cut: str, ready: dict[str, list[int]], size: int = TABLE):
        import regex

        self.ranks, self.pieces = ranks, {rank: piece for piece, rank in ranks.items()}
        self.words_in, self.size = regex.compile(cut).findall, size
        self.ready = {word: self.entry(ids) for word, ids in ready.items()}
        self.known = dict(self.ready)

    def entry(self, ids: list[int]) -> tuple[str, int, bytes]:
        return " ".join(map(str, ids)), len(ids), b"".join([self.pieces[i] for i in ids])

    def encode(self, text: str) -> tuple[str, int, bytes]:
        """The entry of a whole text."""
        words, known = self.words_in(text), self.known
        entries = list(map(known.get, words))
        if None in entries:
            rare = set()
            for place, entry in enumerate(entries):
                if entry is None:
                    word = words[place]
                    if word not in known:
                        rare.add(word)
                        known[word] = self.entry(queued(word.encode(), self.ranks))
                    entries[place] = known[word]
            for word in rare:
                if len(word) > LONG:
                    del known[word]
        if len(self.known) > self.size + len(self.ready):
            self.known = dict(self.ready)
        return " ".join([e[0] for e in entries]), sum([e[1] for e in entries]), b"".join([e[2] for e in entries])


def encoded(docs: DataFrame, id_column: str = "doc_id", text: str = "text", ranks: str | None = None,
            cut: str | None = None, keep: bool = True, frequent: int = FREQUENT) -> DataFrame:
    """Encode whole texts by byte-level BPE and decode the ids again.

    Returns per row: the id, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by spaces,
    ``decoded_sha256`` of the decoded bytes and, with ``keep``, ``ids`` and ``decoded`` themselves.
    Special tokens in a text are ordinary text.  A null text counts as empty: no ids, no bytes.
    Repeated rows and null ids are kept; other columns are ignored; an empty table gives no rows.
    """
    path = ranks or tokenizer_path(RANKS)
    cut = cut or importlib.import_module("public_tokenizers").PATTERN
    plain = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    ready = frequent_words(plain, path, cut, frequent)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, ranks_of(path), cut, ready))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = "id " + kind + ", n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded binary" if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, *own = shared.value
        if name not in _tables:
            _tables.clear()
            _tables[name] = WordTable(*own)
        table = _tables[name]
        for batch in slices(batches, "text"):
            found = [table.encode(value or "") for value in batch["text"].to_pylist()]
            columns = [batch["id"], pa.array([f[1] for f in found], pa.int64()),
                       pa.array([hashlib.sha256(f[0].encode()).hexdigest() for f in found], pa.string()),
                       pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array([[int(i) for i in f[0].split()] for f in found], pa.list_(pa.int32())),
                            pa.array([f[2] for f in found], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_column)


#: The table of this Python worker, kept from task to task.
_tables: dict[str, WordTable] = {}
