"""Byte-level BPE beside the library that reads the same ranks."""

import hashlib
import random
import sys
import unicodedata

import pytest
import tiktoken
from pyspark.sql import functions as F

from sectorlens.llm import byte_pairs, queries
from sectorlens.llm.stages import tokenizer_path


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_pairs.ranks_of(tokenizer_path(byte_pairs.RANKS)))


def check(rows, texts, library):
    assert len(rows) == len(texts)
    for r in rows:
        expected = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == expected and r.n_tokens == len(expected), repr(texts[r.doc_id])[:200]
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()


@pytest.mark.parametrize("frequent", [0, 500, byte_pairs.FREQUENT])
def test_equals_the_library(spark, library, frequent):
    pick = random.Random(8)
    texts = ["", None, " ", "\n\n  \t x", "don't 'S we'll've", "<|endoftext|> a", "a b  c　", "\x00\x85\x1c\x1f z",
             "İΣ 😀é́ ß²½Ⅷ", "x" * 500, "é" * 3000, "abc" * 700, " " * 400 + "q", "=-" * 300, "ab" * 50_000, "word " * 20_000,
             "".join(pick.choice("etaoinshrdlu") for _ in range(5000))]
    texts += ["".join(pick.choice("abS.,\n ▁'1é²)(\t ştE") for _ in range(pick.randint(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check(byte_pairs.encoded(docs, frequent=frequent).collect(), texts, library)


def test_every_character_falls_into_words_as_in_the_library(spark, library):
    """Runs of 64 characters of Unicode, each beside letters, digits, blanks and signs."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cs", "Co", "Cn")]
    texts = ["".join(f"a{c}1{c} {c}.{c}" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    check(byte_pairs.encoded(docs).collect(), texts, library)


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op12_byte_level_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_handling_of_odd_tables(spark):
    schema = "doc_id string, id int, text string, words int, long string, ids int, decoded string"
    rows = [("x", 1, "one two", 1, "a", 1, "b"), ("x", 1, "one two", 1, "a", 1, "b"), (None, 1, None, 1, "a", 1, "b")]
    found = byte_pairs.encoded(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.decoded)) for r in found) == [
        ("None", 0, b""), ("x", 2, b"one two"), ("x", 2, b"one two")]
    assert byte_pairs.encoded(spark.createDataFrame([], schema)).collect() == []
    assert byte_pairs.encoded(spark.createDataFrame(rows, schema).where(F.col("text").isNull())).collect()[0].ids == []
