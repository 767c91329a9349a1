"""Operators beside a plain version in Python, a library or held-out labels."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sectorlens.llm import (components, jaccard, licenses, neighbours, packing, pieces, queries, secrets,
                            suffixes, toxicity, words)

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def odd_texts(count=400):
    pick = random.Random(5)
    return ["", " ", "a ", "▁a", "<s> x</s>", "<|endoftext|> b", "don't 'S\r\n\x0b", "İΣ ς", "\x00😀 é́"] + [
        "".join(pick.choice("abS.,\n ▁'1é²)(\t") for _ in range(pick.randint(1, 40))) for _ in range(count)]


def test_words_match_a_regular_expression():
    texts = [*odd_texts(), None]
    found = words.words_of(pa.array(texts))
    again = [found.data[a:z].tobytes().decode() for a, z in zip(found.start, found.end)]
    assert again == [w for t in texts for w in cut(t)]
    by_word = collections.defaultdict(set)
    for word, number in zip(again, found.hash.tolist()):
        by_word[word].add(number)
    assert all(len(x) == 1 for x in by_word.values())
    assert len({min(x) for x in by_word.values()}) == len(by_word)


def test_pieces_equal_the_library(docs):
    table = pieces.table_of(pieces.tokenizer_path(pieces.MODEL))
    texts = odd_texts() + [r.text for r in docs.limit(200).collect()]
    for text, (ids, count, plain) in zip(texts, table.segment(texts)):
        expected = table.model.encode(text)
        assert (ids, count, plain) == (",".join(map(str, expected)), len(expected), table.model.decode(expected))


def test_tokens_equal_the_library(docs):
    table = packing.WordTable(packing.tokenizer_path(packing.MODEL), size=2000)
    texts = odd_texts() + [r.text for r in docs.limit(200).collect()]
    found = [x for i in range(0, len(texts), 50) for x in table.encode(texts[i:i + 50])]
    expected = table.model.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [e.ids for e in expected]


def test_pieces_of_a_document_are_powers_of_two_and_join_again(docs):
    got = collections.defaultdict(list)
    for r in packing.packed(docs).collect():
        assert r.length == r.bucket == len(r.ids) and r.length & (r.length - 1) == 0 and r.length <= 4096
        got[r.doc_id].append(r)
    table = packing.table_of(packing.tokenizer_path(packing.MODEL))
    for r in docs.collect():
        parts = sorted(got[r.doc_id], key=lambda p: p.start)
        ids = np.frombuffer(table.encode([r.text or ""])[0], "<u4").tolist() + [packing.END]
        assert [i for p in parts for i in p.ids] == ids and parts[0].doc_tokens == len(ids)


def test_scan_and_marginals_equal_a_plain_recursion():
    rng = np.random.default_rng(3)
    a, b, c, d = rng.random((4, 777))
    r, plain = 0.0, []
    for t in range(777):
        r = (a[t] + b[t] * r) / (c[t] + d[t] * r)
        plain.append(r)
    assert np.allclose(toxicity.scan(a, b, c, d), plain)
    field = toxicity.Field(np.array([-0.5, 1.0, 0.3, 0.2, -0.1]), np.array([-1.0, 0.4, 0.7]))
    first = np.zeros(9, bool)
    first[[0, 4]] = True
    inputs = field.inputs(np.array([0, 1.0, 0, 2, 1, 0, 0, 3, 0]), first)
    marginals = field.marginals(inputs, first)
    for begin, end in ((0, 4), (4, 9)):
        total = np.zeros(end - begin)
        weight = 0.0
        for states in np.ndindex(*[2] * (end - begin)):
            score, before = 0.0, 0
            for at, state in enumerate(states):
                score += state * float(inputs[begin + at] @ field.emission)
                score += {(0, 0): 0, (0, 1): -1.0, (1, 0): 0.4, (1, 1): 0.7}[before, state]
                before = state
            total += np.exp(score) * np.array(states)
            weight += np.exp(score)
        assert np.allclose(marginals[begin:end], total / weight)


def test_toxicity_finds_held_out_documents_and_their_words(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.scored(docs, model, keep=("text",)).join(labels, "doc_id") \
                   .where(toxicity.held_out("doc_id")).collect()
    flagged = [r for r in rows if r.score >= 0.7]
    assert sum(r.toxic for r in flagged) / len(flagged) > 0.9
    assert sum(r.toxic for r in flagged) / sum(r.toxic for r in rows) > 0.85
    spans = [r.text[s.start:s.end] for r in flagged for s in r.spans]
    assert spans and all(s == s.strip() for s in spans)


def plain_components(texts, size, percent):
    sets = {}
    for key, text in texts.items():
        w = cut(text)
        sets[key] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    label = {k: k for k in texts}
    keys = sorted(texts)
    for i, x in enumerate(keys):
        for y in keys[i + 1:]:
            shared = len(sets[x] & sets[y])
            if shared and 100 * shared >= percent * len(sets[x] | sets[y]) and label[x] != label[y]:
                low, high = sorted((label[x], label[y]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {k: (len(sets[k]), label[k]) for k in texts}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_jaccard_in_a_crowd_of_near_copies(spark, monkeypatch, size, percent):
    """Groups around the threshold, buckets beyond the limit, and blocks of few members."""
    pick = random.Random(size)
    texts = {}
    for group in range(3):
        base = [f"w{pick.randint(0, 10 ** 6)}" for _ in range(60 + 90 * group)]
        for member in range(40):
            copy = list(base)
            for _ in range(pick.randint(0, len(base) // 25)):
                copy[pick.randrange(len(copy))] = f"x{pick.randint(0, 10 ** 6)}"
            texts[len(texts) * 7 + 1] = " ".join(copy)
    passage = " ".join(f"p{i}" for i in range(30))
    for member in range(60):
        texts[len(texts) * 7 + 1] = passage + " " + " ".join(
            f"y{pick.randint(0, 10 ** 6)}" for _ in range(pick.choice([1, 2, 3, 60])))
    monkeypatch.setattr(jaccard, "RARE", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.joined(docs, size=size, percent=percent).collect()}
    assert found == plain_components(texts, size, percent)


def test_components_of_a_long_chain(spark):
    edges = spark.range(40).selectExpr("id AS a", "id + 1 AS b").unionAll(
        spark.createDataFrame([(100, 90), (90, 95), (7, 7)], "a long, b long"))
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_repeated_passages_beside_all_windows(docs):
    found = suffixes.matches(docs)
    rows = found.collect()
    text = {r.doc_id: cut(r.text) for r in docs.collect()}
    got, seen, expected = collections.defaultdict(set), set(), collections.defaultdict(set)
    for r in rows:
        here = text[r.doc_id][r.start:r.start + r.length]
        assert r.length >= 50 and here == text[r.source_id][r.source_start:r.source_start + r.length]
        assert (r.source_id, r.source_start) < (r.doc_id, r.start)
        got[r.doc_id].update(range(r.start, r.start + r.length))
    for key in sorted(text):
        for at in range(len(text[key]) - 49):
            window = tuple(text[key][at:at + 50])
            if window in seen:
                expected[key].update(range(at, at + 50))
            seen.add(window)
    missed = sum(len(expected[k] - got[k]) for k in expected)
    # Neighbours in the suffix order may hide a longer match with another copy.
    assert missed <= 0.001 * sum(map(len, expected.values()))
    assert all(got[k] <= expected[k] for k in got) and {k for k in expected if expected[k]} == set(got)
    for r in suffixes.cut(docs, found).collect():
        assert cut(r.text) == [w for i, w in enumerate(text[r.doc_id]) if i not in got[r.doc_id]]


def test_secrets_are_found_and_masked(docs):
    scored = secrets.scanned(docs, queries.finding_label())
    rows = [r for r in scored.collect() if r.score >= 0.5]
    text = {r.doc_id: r.text for r in docs.collect()}
    real = {(k, m.start(1)) for k, t in text.items()
            for m in re.finditer(r'(?i)token\s*=\s*"([0-9a-f]{40})"', t)}
    assert {(r.doc_id, r.start) for r in rows} == real
    clean = {r.doc_id: r.text for r in secrets.masked(docs, scored).collect()}
    hit = {k for k, _ in real}
    assert all((clean[k] == text[k]) == (k not in hit) for k in text)
    assert sum(t.count("[SECRET]") for t in clean.values()) == len(real)


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = collections.defaultdict(set)
    for r in neighbours.nearest(vectors, F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    frame = vectors.toPandas()
    ids, points = frame["vec_id"].to_numpy(), np.stack(frame["embedding"].to_numpy()).astype(float)
    hits = 0
    for at in np.flatnonzero(ids % 100 == 0):
        far = ((points - points[at]) ** 2).sum(axis=1)
        far[at] = np.inf
        hits += len(found[ids[at]] & set(ids[np.argsort(far)[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_index_finds_every_code_in_reach():
    codes = np.random.default_rng(2).integers(0, 256, (500, 4), np.uint8)
    index = neighbours.Index(codes)
    for radius in range(0, 33):
        apart = np.unpackbits(codes ^ codes[7], axis=1).sum(axis=1)
        assert index.within(codes[7], radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_license_notice_with_changed_words(spark):
    rows = [(1, "x\nlicensed under apache LICENSE version 2.0\ny"), (2, "the apache version"),
            (3, "see cc by, cc by and the MIT license")]
    found = {r.doc_id: r for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].labels, found[1].score, found[1].matches[0].block) == ("apache", 1.0, 1)
    assert (found[2].labels, found[2].score) == ("", 0.0)
    assert (found[3].n_base, found[3].first_word, found[3].last_word, found[3].labels) == (3, 1, 7, "cc-by,mit")
