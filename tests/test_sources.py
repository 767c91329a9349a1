import json

import pytest
from pyspark.sql import functions as F

from sectorlens import schemas
from sectorlens.operators import retrieval
from sectorlens.sources import readers, writers


def test_yearly_csv(spark, tmp_path):
    (tmp_path / "2008.csv").write_text(
        'company_name,success,content_or_error\nA,1,"line one\nline ""two"""\nB,0,\n', encoding="utf-8-sig")
    (tmp_path / "2010.csv").write_text("company_name,success,content_or_error\nC,1,NA\n")
    df = readers.read_yearly_csv(spark, str(tmp_path), schemas.RAW_NEWS, range(2008, 2012))
    assert sorted((r.year, r.company_name, r.success, r.content_or_error) for r in df.collect()) == [
        (2008, "A", 1, 'line one\nline "two"'), (2008, "B", 0, None), (2010, "C", 1, "NA")]
    assert readers.read_yearly_csv(spark, str(tmp_path), schemas.RAW_NEWS, [2009]).count() == 0


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        readers.require_columns(spark.range(1), ["keywords"])


def test_json_maps_and_records(spark, tmp_path):
    companies = tmp_path / "c.json"
    companies.write_text(json.dumps({"Z": ["b", "a", "b"], "A": ["a"]}))
    got = [tuple(r) for r in readers.read_sector_companies(spark, str(companies)).collect()]
    assert got == [(0, "Z", "b"), (0, "Z", "a"), (1, "A", "a")]
    assert readers.read_sector_companies(spark, str(companies), distinct=False).count() == 4
    words = tmp_path / "k.json"
    words.write_text(json.dumps({"Z": [""], "A": ["x", "y"]}))
    assert [tuple(r) for r in readers.read_sector_keywords(spark, str(words)).collect()] == [
        ("Z", [""]), ("A", ["x", "y"])]
    urls = tmp_path / "urls"
    urls.mkdir()
    (urls / "2009.json").write_text(json.dumps([{"company_name": "A", "sector_keyword": "k", "count": 1, "urls": ["u"]}]))
    record = readers.read_search_records(spark, str(urls)).collect()[0]
    assert (record.year, record.company_name, record.urls) == (2009, "A", ["u"])


def test_sites_round_trip(spark, tmp_path):
    sites = tmp_path / "s.json"
    sites.write_text(json.dumps({"A": "https://www.a.com/"}))
    df = readers.read_company_sites(spark, str(sites)).withColumn("root_domain", F.lit("a.com"))
    writers.export_sites(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text) == {"A": ["https://www.a.com/", "a.com"]}


def test_statistics_and_coordinates(spark, tmp_path):
    stats = tmp_path / "t.csv"
    stats.write_text('REF_DATE,GEO,"Supply and disposition",UOM,VALUE\n2016-01,Canada,"Coal, received",t,1.5\n'
                     '2016-02-01,Canada,Exports,t,..\n', encoding="utf-8-sig")
    df = readers.read_statistics(spark, str(stats), "Supply and disposition")
    assert [(str(r.ref_date), r.geo, r.label, r.value) for r in df.collect()] == [
        ("2016-01-01", "Canada", "Coal, received", 1.5), ("2016-02-01", "Canada", "Exports", None)]
    geo = tmp_path / "g.csv"
    geo.write_text("GEO,Latitude,Longitude\nCanada,62.4,-96.8\n", encoding="utf-8-sig")
    assert [tuple(r) for r in readers.read_coordinates(spark, str(geo)).collect()] == [("Canada", 62.4, -96.8)]


def test_year_sink_replaces_present_years_only(spark, tmp_path):
    folder = str(tmp_path / "t")
    writers.write_years(spark.createDataFrame([(1, 2008), (2, 2009)], "x int, year int"), folder)
    writers.write_years(spark.createDataFrame([(3, 2009)], "x int, year int"), folder)
    assert sorted(tuple(r) for r in readers.read_yearly_tables(spark, folder).collect()) == [(1, 2008), (3, 2009)]
    pruned = readers.read_yearly_tables(spark, folder, [2009])
    assert [r.x for r in pruned.collect()] == [3]


def test_exports_and_side_output(spark, tmp_path):
    df = spark.createDataFrame([(2, 'b "q"\nline'), (1, "a")], "id int, t string")
    writers.export_csv(df, str(tmp_path / "csv"), ["id"])
    back = readers.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, 'b "q"\nline')]
    writers.write_with_side_output(df, F.col("id") == 2, str(tmp_path / "a"), str(tmp_path / "b"), ["id"])
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    assert [r.id for r in spark.read.parquet(str(tmp_path / "b")).collect()] == [2]
    writers.export_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_saved_index_answers_the_same(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma"), (3, "delta")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "beta alpha")], "query_id long, query string")
    terms, postings = retrieval.build_index(docs, "doc_id")
    writers.save_index(docs, terms, postings, str(tmp_path / "i"))
    _, terms2, postings2 = readers.load_index(spark, str(tmp_path / "i"))
    fresh = retrieval.retrieve(asked, docs, "query_id", "doc_id").collect()
    saved = retrieval.retrieve(asked, docs, "query_id", "doc_id", index=(terms2, postings2)).collect()
    assert sorted(fresh) == sorted(saved)
