"""Batches of word lists stay in Arrow while keywords are chosen."""

import tracemalloc

import pyarrow as pa

from sectorlens.operators import keywords


def test_one_list_at_a_time_becomes_python_objects():
    batch = pa.array([[f"word{i}of{j}" for j in range(50)] for i in range(1000)])
    tracemalloc.start()
    got = keywords.chosen_lists(batch, 1, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The batch as Python strings takes over 3 MB.
    assert len(got) == 1000 and peak < 1_000_000


def test_null_and_empty_lists(spark):
    rows = spark.createDataFrame([(1, ["sun", "sun", "wind"]), (2, None), (3, [])], "id long, words array<string>")
    got = {r["id"]: r["k"] for r in rows.select("id", keywords.select_diverse(rows["words"], 2, 3).alias("k")).collect()}
    assert got[2] is None and got[3] == []
    assert [(p["keyword"], p["rel"]) for p in got[1]] == keywords.choose(keywords.candidates(["sun", "sun", "wind"], 2), 3)
