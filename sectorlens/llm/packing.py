"""Packing by power-of-two decomposition: no sequence crosses documents.

A document's ids are cut into pieces of the longest length and then, for the rest, into the
powers of two of its binary representation.  Every piece is a sequence of its own, so nothing is
padded, and sequences of equal length share a bucket from which batches are drawn.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import stored, tokenizer_path
from .words import slices

MODEL, END, LONGEST = "word_bpe_49k.json", 2, 4096
# Distinct chunks that a worker's table keeps at most, and the longest one worth keeping.
TABLE, LONGEST_CHUNK = 500_000, 64
# Texts whose words the tokenizer's own pattern, fixed in its file, cuts as follows.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def binary_lengths(total: int, longest: int = LONGEST) -> list[int]:
    """Pieces of ``longest``, then the powers of two of the rest, longest first."""
    rest = total % longest
    powers = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [longest] * (total // longest) + powers


class WordTable:
    """Ids of texts by a tokenizer that splits texts at blanks and then into letters and others.

    Every distinct part of a text is tokenized once while the table holds it, and the ids are
    joined in order.  Texts of printable ASCII and accented Latin letters, for which lower case
    is plain, are cut into the tokenizer's own words; any other text is cut at blanks and line
    ends only, which no word crosses.  Ids are little-endian unsigned 32-bit.
    """

    def __init__(self, path: str, size: int = TABLE):
        from tokenizers import Tokenizer

        self.model, self.size = Tokenizer.from_file(path), size
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.model.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def cut(text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _WORD.findall(text.lower())
        return text.replace("\n", " ").split(" ")

    def together(self, words: list[str]) -> dict[str, bytes]:
        """Ids of many words from one call: the last id of a word carries the end mark."""
        if not words:
            return {}
        ids = np.array(self.model.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return {}
        joined, ends = ids.tobytes(), (4 * ends).tolist()
        return {w: joined[a:b] for w, a, b in zip(words, [0, *ends], ends)}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(text) for text in texts]
        new = [c for c in dict.fromkeys(c for chunks in cut for c in chunks) if c not in self.known]
        if len(self.known) + len(new) > self.size:
            self.known = {"": b""}
            new = list(dict.fromkeys(c for chunks in cut for c in chunks if c))
        known = self.known
        words = [c for c in new if _WORD.fullmatch(c)]
        known.update(self.together(words))
        rest = [c for c in new if c not in known]
        for chunk, one in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False)):
            known[chunk] = np.array(one.ids, "<u4").tobytes()
        joined = [b"".join([known[c] for c in chunks]) for chunks in cut]
        for chunk in new:
            if len(chunk) > LONGEST_CHUNK:
                del known[chunk]
        return joined


_tables: dict[str, WordTable] = {}


def table_of(path: str) -> WordTable:
    """The table of this Python worker, kept from task to task."""
    if path not in _tables:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tables[path] = WordTable(path)
    return _tables[path]


def packed(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
           model: str | None = None, end: int = END, longest: int = LONGEST,
           keep: bool = True) -> DataFrame:
    """Pack whole texts into sequences of at most ``longest`` ids, a power of two.

    Per piece: the id column, ``start`` and ``length`` in the document's ids, ``ids_crc32``,
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (0: a sequence is one piece),
    ``bucket`` (the sequence's length) and, with ``keep``, the ``ids``.  The pieces are stored
    before they are numbered, so that a recomputed task cannot change a number.  A null text
    counts as empty and gives the end id alone; repeated rows are packed each; other columns are
    ignored.  Write the result with ``partitionBy("bucket")`` to draw batches of equal length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    path = model or tokenizer_path(MODEL)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (f"`{id_column}` {kind}, start long, length long, ids_crc32 long, doc_tokens long"
              + (", ids array<int>" if keep else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last = table_of(path), end.to_bytes(4, "little")
        for batch in slices(batches, text):
            rows, starts, lengths, sums, totals = [], [], [], [], []
            texts = [value or "" for value in batch[text].to_pylist()]
            encoded = [found + last for found in table.encode(texts)]
            for row, found in enumerate(encoded):
                total, start = len(found) // 4, 0
                for length in binary_lengths(total, longest):
                    piece = found[4 * start:4 * (start + length)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
                    start += length
            columns = [batch[id_column].take(pa.array(rows, pa.int64())),
                       *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]]
            names = [id_column, "start", "length", "ids_crc32", "doc_tokens"]
            if keep:
                # Pieces follow each other as in the texts.
                ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
                ids = np.frombuffer(b"".join(encoded), "<i4")
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    pieces = stored(docs.select(id_column, F.col(text).alias(text)).mapInArrow(run, schema))
    columns = pieces.columns
    # The number of a stored row is fixed by its file, so it is the same however often it is read.
    place = pieces.select("*", F.monotonically_increasing_id().alias("sequence_id"))
    return place.select(*[c for c in columns if c != "ids"], "sequence_id",
                        F.lit(0).cast("bigint").alias("offset"), F.col("length").alias("bucket"),
                        *[c for c in columns if c == "ids"])
