"""License notices across lines, look-alikes, and all windows by brute force."""

import random
import re

from sectorlens.llm import licenses


def scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in licenses.scanned(docs, **options).orderBy("doc_id").collect()]


def test_look_alikes_and_broken_lines(spark):
    gpl = " ".join(licenses.TEMPLATES["gpl"][1].split())
    found = scan(spark, [
        "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.",
        "the rights of all citizens are reserved", "Code is licensed under\nCC BY-NC\n4.0 since May.",
        "# " + "\n# ".join(gpl.split(" ")), "Licensed under CC BY-NC-SA 4.0",
        "Licensed under the Apache License, Version 2.0. All rights\nreserved."])
    assert [r.labels for r in found] == [
        "cc-by", "cc-by,cc-by-nc", "", "cc-by,cc-by-nc", "gpl", "cc-by,cc-by-nc,cc-by-sa", "apache,reserved"]
    assert found[2].score == 0.0
    assert [(m.block, m.label) for m in found[6].matches] == [(0, "apache"), (0, "reserved")]
    assert found[3].matches[0].first_word == 2 and found[3].matches[0].n_words == 7


def words(text):
    return re.findall(r"[a-z0-9]+", text.lower())


def plain(text, templates, threshold):
    """Labels by all windows of every template."""
    w, blocks = words(text), []
    for label, wordings in templates.items():
        for which, wording in enumerate(wordings):
            t = words(wording)
            own = []
            for a in range(len(w)):
                part = w[a:a + len(t)]
                hits = [i for i, x in enumerate(part) if x in t]
                share = len(set(part) & set(t)) / len(set(t))
                if w[a] in t and share >= threshold - 1e-9:
                    own.append((a, a + hits[-1], share))
            for a, z, share in own:
                if not any(x <= z and a <= y and (s > share or s == share and x < a) for x, y, s in own):
                    blocks.append((a, z, share, len(t), label))
    return sorted({b[4] for b in blocks if not any(
        o[4] != b[4] and o[0] <= b[1] and b[0] <= o[1] and (o[2], o[3]) > (b[2], b[3]) for o in blocks)})


def test_all_windows(spark):
    rng = random.Random(8)
    templates = {"x": ("a b c d e", "f g"), "y": ("a b c d h i",), "z": ("i j a b",)}
    texts = ["\n".join(" ".join(rng.choice("aabbcdefghijkl") for _ in range(rng.randint(1, 9)))
                       for _ in range(rng.randint(1, 12))) for _ in range(300)]
    found = scan(spark, texts, templates=templates, phrases={}, threshold=0.8)
    wanted = [",".join(plain(t, templates, 0.8)) for t in texts]
    assert [r.labels for r in found] == wanted and len(set(wanted)) > 4
