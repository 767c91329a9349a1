"""Schemas of the tables that are read and written.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, NUMBER = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TEXTS = T.ArrayType(TEXT)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


SECTOR_MAP = T.MapType(TEXT, TEXTS)
SITE_MAP = T.MapType(TEXT, TEXT)
SEARCH_RECORDS = _table(company_name=TEXT, sector_keyword=TEXT, count=INT, urls=TEXTS)
RAW_NEWS = _table(company_name=TEXT, success=INT, content_or_error=TEXT)
ARTICLES = _table(company_name=TEXT, success=INT, content_or_error=TEXT, summary=TEXT)
COMPANIES = _table(company_name=TEXT, summary=TEXT, sector_name=TEXT, summary_result=TEXT)
SECTORS = _table(sector_name=TEXT, sector_summary=TEXT)
SECTOR_TREND = _table(sector_name=TEXT, sector_trend=TEXT)
COMPANY_KEYWORDS = _table(company_name=TEXT, sector_name=TEXT, summary_result=TEXT, keywords=TEXT,
                          keywords_score=NUMBER)
COORDINATES = _table(geo=TEXT, latitude=NUMBER, longitude=NUMBER)
QUESTIONS = _table(query_id=LONG, query=TEXT, sector=TEXT, source=TEXT, images=TEXTS)
