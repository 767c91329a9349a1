from pyspark.sql import functions as F

from sectorlens.plans import news, questions


def articles(spark):
    rows = [(i, 2020 + i % 2, f"C{i % 3}", f"Company news {i} grew strongly. More text {i}.") for i in range(12)]
    return spark.createDataFrame(rows, "doc_id long, year int, company_name string, content string")


def mapping(spark):
    return spark.createDataFrame([(0, "Solar", "C0"), (1, "Wind", "C1"), (2, "Gas", "C1")],
                                 "sector_ord int, sector_name string, company_name string")


def test_report(spark):
    made = news.report(articles(spark), mapping(spark), "doc_id")
    rows = made.final.orderBy("company_name", "year").collect()
    assert [(r.company_name, r.sector_name) for r in rows] == [
        ("C0", "Solar"), ("C0", "Solar"), ("C1", "Gas"), ("C1", "Gas"), ("C2", ""), ("C2", "")]
    first = rows[0]
    assert first.company_summary == "Company news 0 grew strongly."
    lists = [first.company_keywords, first.company_keywords_score, first.company_keywords_sentiment]
    assert len({len(x.split("; ")) for x in lists}) == 1
    # The default scorer sees the summaries, not the wording of the prompt.
    assert first.sector_trend.startswith("Summary in 2020: Company news")
    assert made.sectors.count() == 6 and made.trends.count() == 3


def test_report_with_judge(spark):
    made = news.report(articles(spark), mapping(spark), "doc_id",
                       judge=lambda p: F.when(F.contains(p, F.lit("news 0 ")), "No.").otherwise("Yes"))
    texts = {(r.company_name, r.year): r.summary_result for r in made.companies.collect()}
    assert texts["C0", 2020] == "Company news 6 grew strongly."


def test_questions(spark, tmp_path):
    final = spark.createDataFrame(
        [(1, 2020, "Solar", "panels got cheap", "sun sector text", "sun trend"),
         (2, 2020, "Wind", "turbines got large", "wind sector text", "wind trend")],
        "seq long, year int, sector_name string, company_summary string, sector_summary string, "
        "sector_trend string")
    index = questions.build(final)
    index.save(str(tmp_path / "index"))
    loaded = questions.Index.load(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, "cheap panels?", "Local"), (2, "hi", "Online")],
                                  "query_id long, query string, source string")
    got = {r.query_id: r.prompt for r in questions.answer(asked, loaded, 2).collect()}
    assert got[2] == "hi"
    assert "Article 1\npanels got cheap\n" in got[1] and "Article 2\nwind trend\n" in got[1]
