import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.operators import cells, keywords, retrieval, segments, vectors


def mmr_by_hand(rated, top_n, diversity):
    """The rule with every score worked out in every step."""
    def grams(k):
        return {k[i:i + 3] for i in range(max(len(k) - 2, 1))}

    picked, left = [], list(range(len(rated)))
    while left and len(picked) < top_n:
        def score(i):
            a = grams(rated[i][0])
            near = max((len(a & grams(rated[j][0])) / len(a | grams(rated[j][0])) for j in picked), default=0.0)
            return (1 - diversity) * rated[i][1] - diversity * near
        best = max(left, key=lambda i: (score(i), -i))
        picked.append(best)
        left.remove(best)
    return [rated[i] for i in picked]


@pytest.mark.parametrize("longest", [1, 2])
def test_lazy_choice_equals_full_choice(longest):
    rng = random.Random(longest)
    for _ in range(30):
        terms = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(0, 60))]
        rated = keywords.candidates(terms, longest)
        assert keywords.choose(rated, 10, 0.7) == mmr_by_hand(rated, 10, 0.7)
        assert len({k for k, _ in rated}) == len(rated)


def test_company_keywords_drop_names_and_year(spark):
    text = "Linde linde solar solar 2020 growth plant energy turbine hydrogen"
    df = spark.createDataFrame([("Linde", "Solar", 2020, text), ("X", "Y", 2020, None), ("X", "Y", 2020, "the")],
                               "company_name string, sector_name string, year int, summary_result string")
    got = [r.keywords for r in keywords.company_keywords(df).collect()]
    assert len(got) == 5 and not {"linde", "solar", "2020"} & set(got)


def test_sector_keywords_drop_containing(spark):
    df = spark.createDataFrame([("Solar", 2020, "solar panel panel price rise 2020 record")],
                               "sector_name string, year int, sector_summary string")
    got = [r.keywords for r in keywords.sector_keywords(df).collect()]
    assert got and not any("solar" in k or "2020" in k for k in got)


DOCS = [(1, "alpha beta beta"), (2, "beta gamma"), (3, "alpha alpha delta"), (4, "epsilon")]


def scores_by_hand(query):
    n = len(DOCS)
    bags = {d: {w: t.split().count(w) for w in t.split()} for d, t in DOCS}
    df = {w: sum(w in b for b in bags.values()) for b in bags.values() for w in b}
    idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}

    def vector(bag):
        v = {w: c * idf[w] for w, c in bag.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}
    q = vector({w: query.split().count(w) for w in query.split()})
    return {d: round(sum(x * vector(b).get(w, 0) for w, x in q.items()), 6) for d, b in bags.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_retrieval_equals_matrix_product(spark, monkeypatch, broadcast):
    monkeypatch.setattr(retrieval, "BROADCAST_TERMS", 1000 if broadcast else 0)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "unknown")], "query_id long, query string")
    top = retrieval.retrieve(asked, docs, "query_id", "doc_id", 2, pad_zero=True)
    got = [(r.query_id, r.doc_id, r.score, r.rank) for r in top.orderBy("query_id", "rank").collect()]
    want = sorted(scores_by_hand("alpha beta").items(), key=lambda s: (-s[1], -s[0]))[:2]
    assert got == [(1, *want[0], 1), (1, *want[1], 2), (2, 4, 0.0, 1), (2, 3, 0.0, 2)]
    plain = retrieval.retrieve(asked, docs, "query_id", "doc_id", 2)
    assert plain.where("query_id = 2").count() == 0


def test_answer_prompts_route_by_source(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "delta?", "Local"), (2, "hello", "Online")],
                                  "query_id long, query string, source string")
    top = retrieval.retrieve(asked, docs, "query_id", "doc_id", 2)
    got = {r.query_id: r.prompt for r in
           retrieval.answer_prompts(asked, top, docs, "query_id", "doc_id").collect()}
    assert got[2] == "hello"
    assert got[1].endswith("\n\n'delta?'\n\nRelevant document excerpts:\nArticle 1\nalpha alpha delta\n")


@pytest.mark.parametrize("few", [True, False])
def test_nearest_is_exact(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(vectors, "QUESTION_BLOCK", 3)
        monkeypatch.setattr(cells, "PART_ROWS", 4)
        monkeypatch.setattr(cells, "SHARE_ROWS", 2)
    rng = np.random.default_rng(0)
    pool, asked = rng.normal(size=(90, 8)), rng.normal(size=(7, 8))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pool)], "vec_id long, embedding array<double>")
    questions = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    want = np.argsort(-(unit(asked) @ unit(pool).T), axis=1)[:, :5]
    got = vectors.nearest(corpus, questions, 5).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == want.reshape(-1).tolist()


def test_rows_without_a_vector_have_no_match(spark):
    schema = "vec_id long, embedding array<double>"
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], schema)
    asked = corpus.withColumnRenamed("vec_id", "query_id")
    got = {(r.query_id, r.vec_id) for r in vectors.nearest(corpus, asked, 2).collect()}
    assert got == {(1, 1), (1, 3), (3, 1), (3, 3)}


@pytest.mark.parametrize("factor", [1, 5000])
def test_neighbours_follow_each_other_however_sparse_the_ids(spark, factor):
    rng = np.random.default_rng(1)
    ids = sorted((factor * rng.choice(100, 40, replace=False)).tolist())
    pool = {i: rng.normal(size=4) for i in ids}
    df = spark.createDataFrame([("g", i, pool[i].tolist()) for i in ids], "g string, id long, embedding array<double>")
    got = {r.id: (r.next_id, r.similarity) for r in
           vectors.neighbour_similarity(df, ["g"], "id").collect()}
    for a, b in zip(ids, ids[1:]):
        want = pool[a] @ pool[b] / np.linalg.norm(pool[a]) / np.linalg.norm(pool[b])
        assert got[a][0] == b and abs(got[a][1] - want) < 1e-12
    assert got[ids[-1]] == (None, None)


def test_semantic_segments(spark):
    rows = [(1, "One two. Three four.", 2), (2, "Same words here. Same words here. Other thing now. Same words here.", 1),
            (3, "A b. C d. E f. G h.", 1)]
    df = spark.createDataFrame(rows, "id long, text string, images int")
    df = df.unionAll(df.limit(1).selectExpr("4", "text", "CAST(NULL AS INT)"))
    got = {}
    for r in segments.semantic_segments(df).orderBy("id", "seg_no").collect():
        got.setdefault(r.id, []).append(r.segment)
    assert got[1] == ["One two. Three four."] * 3
    assert got[4] == ["One two. Three four."]
    assert got[2][0].startswith("Same words here. Same words here.") and len(got[2]) == 2
    assert " ".join(got[3]) == "A b. C d. E f. G h." and len(got[3]) == 2


def test_merge_recomputes_like_the_full_search():
    rng = random.Random(4)
    for _ in range(20):
        sentences = [" ".join(rng.choice("abcde") * 3 for _ in range(4)) + "." for _ in range(12)]
        got = segments.split_paragraphs(list(sentences), 3, 2.0, segments.hashed_counts, True)
        parts = list(sentences)
        while len(parts) > 3:
            v = segments.hashed_counts(parts)
            sims = [segments._cosine(a, b) for a, b in zip(v, v[1:])]
            at = int(np.argmax(sims)) if max(sims) > 0 else 0
            parts[at:at + 2] = [parts[at] + " " + parts[at + 1]]
        assert got == parts


def test_exact_counts_merge_like_the_full_search():
    rng = random.Random(6)
    for case in range(30):
        sentences = [" ".join(rng.choice("abcdef") * 2 for _ in range(rng.randint(1, 6))) + "."
                     for _ in range(rng.randint(4, 25))]
        threshold = rng.choice([0.7, 0.9, 2.0])

        def like(left, right):
            left, right = ([w.strip(".") for w in x.split()] for x in (left, right))
            dot = sum(right.count(w) for w in left)
            return dot / (math.sqrt(sum(map(left.count, left))) * math.sqrt(sum(map(right.count, right))))

        parts = []
        for s in sentences:
            if parts and like(parts[-1], s) >= threshold:
                parts[-1] += " " + s
            else:
                parts.append(s)
        while len(parts) > 3:
            sims = [like(a, b) for a, b in zip(parts, parts[1:])]
            at = sims.index(max(sims))
            parts[at:at + 2] = [parts[at] + " " + parts[at + 1]]
        assert segments.split_paragraphs(sentences, 3, threshold) == parts


def test_a_text_of_100000_sentences_is_cut(spark):
    words = [f"w{i * 7919 % 5003} w{i % 11} w{i % 3}." for i in range(100_000)]
    df = spark.createDataFrame([(1, " ".join(words), 4)], "id long, text string, images int")
    got = [r.segment for r in segments.semantic_segments(df).orderBy("seg_no").collect()]
    assert len(got) == 5 and " ".join(got) == " ".join(words)
