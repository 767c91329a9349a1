"""Prompts of whole groups come in pages and give what one text per group gives."""

import hashlib
import random

from pyspark.sql import functions as F

from sectorlens.operators import ordering, rollup


def test_pages_are_the_text_in_pieces(spark):
    """Several levels, also pages of one part, lone final texts, numbers that are missing."""
    rows = [(g, no + 1, g == "lone", f"{g}{no}") for g, count in (
        ("lone", 1), ("single", 1), ("few", 3), ("page", 27), ("more", 28), ("levels", 82), ("gaps", 91))
        for no in range(count) if g != "gaps" or no % 4]
    random.Random(1).shuffle(rows)
    segments = spark.createDataFrame(rows, "g string, seg_no long, is_final boolean, summary string")

    def final(text):
        return F.concat(F.lit("<"), F.col("g"), F.lit("> "), text)

    whole = {r.g: r.summary for r in rollup.merge_summaries(segments, ["g"], final, 3).collect()}
    pages = rollup.merge_summaries(segments, ["g"], final, 3, in_pages=True)
    found = {}
    for r in pages.orderBy("g", "page_no").collect():
        found.setdefault(r.g, []).append(r.summary)
    assert {g: "".join(p) for g, p in found.items()} == whole
    # No row holds more than a segment and what stands before it.
    assert max(len(p) for parts in found.values() for p in parts) < 60 and len(whole["levels"]) > 800
    digests = {r.g: (r.n_chars, r.md5) for r in ordering.digests(pages, ["g"], "page_no", "summary").collect()}
    assert digests == {g: (len(t), hashlib.md5(t.encode()).hexdigest()) for g, t in whole.items()}


def test_digests_of_texts_beyond_one_batch(spark):
    rows = [(y, None if y == 2 else "s", no, None if no == 7 else f"é{no}😀" * (no % 5))
            for y in range(4) for no in range(50)]
    random.Random(2).shuffle(rows)
    pages = spark.createDataFrame(rows, "year long, sector string, no int, text string")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        found = {(r.year, r.sector): (r.n_chars, r.md5) for r in
                 ordering.digests(pages, ["year", "sector"], "no", "text").collect()}
    finally:
        spark.conf.set(name, before)
    whole = {}
    for year, sector, _, text in sorted(rows, key=lambda r: (r[0], r[2])):
        whole[year, sector] = whole.get((year, sector), "") + (text or "")
    assert found == {k: (len(t), hashlib.md5(t.encode()).hexdigest()) for k, t in whole.items()}
    assert ordering.digests(pages.limit(0), ["year", "sector"], "no", "text").collect() == []
