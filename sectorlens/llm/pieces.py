"""Encoding and decoding by a SentencePiece model through a table of distinct marked words.

White space becomes the marker U+2581.  No piece of the model runs from another character into a
marker, from a letter into a full stop or comma, or over a line end.  So a text falls into chunks
that are segmented independently.  Every task keeps a table of the distinct chunks it has met: a
chunk is segmented once, and its ids are joined back by position.  The table is local to the task
because a global one would shuffle every text: bounded memory and no shuffle at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import tokenizer_path
from .words import slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_CHUNK = re.compile(f"{MARK}*[{_LETTER}]+(?=[{MARK}.,\n]|$)|\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_CROSSING = re.compile(f"[^{MARK}]{MARK}|[{_LETTER}][.,]|\n")
# Chunks that a task's table keeps at most, and the longest one worth keeping.
TABLE, LONGEST = 400_000, 48


class ChunkTable:
    """Segments chunks by a model, each distinct one once while the table holds it.

    Texts are encoded as by the library's ``encode`` and decoded as by its ``decode``.  Models
    with a piece that crosses the cuts are refused.
    """

    def __init__(self, path: str, size: int = TABLE):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(_CROSSING.search(self.model.id_to_piece(i))
               for i in range(self.model.vocab_size())):
            raise ValueError("pieces of this model cross the cuts between chunks")
        self.ahead = self.model.encode("\n")
        self.size = size
        self.known: dict[str, tuple[str, int, str]] = {}

    def learn(self, chunks: list[str]) -> None:
        # A line end ahead isolates a chunk from the marker that the library puts first.
        found = self.model.encode(["\n" + c for c in chunks], num_threads=1)
        ids = [x[len(self.ahead):] for x in found]
        plain = self.model.decode([self.ahead[-1:] + x for x in ids], num_threads=1)
        for chunk, one, text in zip(chunks, ids, plain):
            self.known[chunk] = (",".join(map(str, one)), len(one), text[1:])

    def segment(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """For each text its comma-joined ids, their number, and the decoded text."""
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = [c for c in dict.fromkeys(c for cs in cut for c in cs) if c not in self.known]
        if len(self.known) + len(new) > self.size:
            self.known = {}
            new = list(dict.fromkeys(c for cs in cut for c in cs))
        self.learn(new)
        known, done = self.known, []
        for chunks in cut:
            entries = [known[c] for c in chunks]
            plain = "".join([e[2] for e in entries])
            done.append((",".join([e[0] for e in entries]), sum([e[1] for e in entries]),
                         plain[1:] if plain.startswith(" ") else plain))
        for chunk in new:
            if len(chunk) > LONGEST:
                del known[chunk]
        return done


_tables: dict[str, ChunkTable] = {}


def table_of(path: str) -> ChunkTable:
    """The table of this Python worker, kept from task to task."""
    if path not in _tables:
        _tables[path] = ChunkTable(path)
    return _tables[path]


def encoded(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
            model: str | None = None, keep: bool = True) -> DataFrame:
    """Encode whole texts and decode the ids again.

    Returns per row: the id column, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by
    commas, ``decoded_sha256`` and, with ``keep``, ``ids`` and ``decoded`` themselves.  A null
    text counts as empty: no ids, decoded to the empty text.  Repeated rows and null ids are
    kept; other columns are ignored.
    """
    path = model or tokenizer_path(MODEL)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(path)
        for batch in slices(batches, text):
            counts, hashes, backs, ids, decoded = [], [], [], [], []
            texts = [value or "" for value in batch[text].to_pylist()]
            for joined, total, plain in table.segment(texts):
                counts.append(total)
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                backs.append(hashlib.sha256(plain.encode()).hexdigest())
                if keep:
                    ids.append([int(x) for x in joined.split(",")] if joined else [])
                    decoded.append(plain)
            columns = [batch[id_column], pa.array(counts, pa.int64()),
                       pa.array(hashes, pa.string()), pa.array(backs, pa.string())]
            names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, F.col(text).alias(text)).mapInArrow(run, schema)
