"""Periodic runs beside a plain search of all periods."""

import hashlib
import random
import zlib

import pytest

from sectorlens.llm import periods, queries


def plain_runs(words):
    """All maximal stretches of smallest period q, found period by period."""
    n, seen, found = len(words), set(), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                found.append((i, j + q - i, q))
            i = j
    return sorted(found)


def plain_row(text):
    words = (text or "").encode().split()
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return runs, best, b" ".join(w for i, w in enumerate(words) if i not in dropped)


def texts():
    pick = random.Random(4)
    found = ["", None, " \t\n ", "a " * 11, "a " * 12, "a b " * 6, "a a b " * 100, "x " + "a b c d e f " * 2, "é " * 500]
    for _ in range(150):
        letters = "abcdefghijklmnop"[:pick.choice([1, 2, 3, 16])]
        words = [pick.choice(letters) + pick.choice(["", "", "Z"]) for _ in range(pick.randint(0, 120))]
        for _ in range(pick.randint(0, 3)):
            unit = [pick.choice(letters) for _ in range(pick.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100]))]
            whole = unit * pick.randint(1, 7)
            at = pick.randint(0, len(words))
            words[at:at] = whole[:len(whole) - pick.randint(0, len(unit) - 1)]
        found.append(" ".join(words))
    return found


@pytest.mark.parametrize("long, tile", [(periods.LONG, periods.TILE), (40, 16), (0, 64)])
def test_runs_equal_a_plain_search(spark, long, tile):
    cases = texts()
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in periods.found(docs, long=long, tile=tile).collect()}
    assert len(rows) == len(cases)
    for i, text in enumerate(cases):
        runs, best, collapsed = plain_row(text)
        r = rows[i]
        assert [tuple(x) for x in r.runs] == runs and r.n_runs == len(runs), text
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best[1] * 1000 // best[2] if best else None)
        assert r.collapsed == collapsed.decode()


def test_query_equals_a_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words = (doc.text or "").encode().split()
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, best, collapsed = plain_row(b" ".join(words).decode())
        r = rows[doc.doc_id]
        listing = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (
            len(runs), hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
        assert (r.start, r.length, r.period) == (best or (None, None, None))


def test_handling_of_odd_tables(spark):
    schema = "doc_id string, key int, text string, runs int, id int, period string"
    rows = [("x", 1, "a b " * 20, 1, 2, "p"), ("x", 1, "a b " * 20, 1, 2, "p"), (None, 1, None, None, None, None),
            (None, 1, "a", None, None, None), ("y", 2, "w " * 50_000, 1, 1, "")]
    found = periods.found(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), r.n_runs, r.length, r.collapsed) for r in found) == [
        ("None", 0, None, ""), ("None", 0, None, "a"), ("x", 1, 40, "a b"), ("x", 1, 40, "a b"), ("y", 1, 50_000, "w")]
    assert periods.found(spark.createDataFrame([], schema)).collect() == []
