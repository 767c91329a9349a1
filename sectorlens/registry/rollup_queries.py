"""Queries that roll texts up by company, sector and year, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, prompts
from ..functions import text as tx
from ..operators import joins, keywords, ordering, packing, retrieval, rollup, scoring
from ..plans import news
from ..session import checkpointed
from ..sources.readers import spread
from . import sql
from .roles import articles, table
from .text_queries import DOWN_WORDS, LAST_WINS, UP_WORDS, sector_mapping

GROUP = ["company_name", "sector_name"]


def summarized(spark, folder):
    """Articles with their richest sentence as summary; failed ones have none."""
    return articles(spark, folder).withColumn(
        "summary", F.when(F.col("success") == 1, tx.richest_sentence(F.col("content"))))


def company_text_rollup(spark, folder):
    texts = rollup.company_texts(summarized(spark, folder))
    return texts.select(*GROUP, "page_no", F.length("summary").cast("bigint").alias("n_chars"),
                        F.md5("summary").alias("summary_md5"))


def sector_text_rollup(spark, folder):
    texts = rollup.sector_texts(summarized(spark, folder), "doc_id", "summary")
    return texts.select("year", "sector_name", "page_no",
                        F.length("sector_content").cast("bigint").alias("n_chars"),
                        F.md5("sector_content").alias("content_md5"))


def pack_by_chars(spark, folder):
    packed = packing.pack_by_chars(spread(articles(spark, folder)), ["company_name"], "doc_id", "content")
    return packed.select("company_name", "seg_no", F.length("segment").cast("bigint").alias("n_chars"),
                         F.md5("segment").alias("segment_md5"))


def pack_by_words(spark, folder):
    packed = packing.pack_by_words(spread(articles(spark, folder)), ["company_name"], "doc_id", "content")
    return packed.select("company_name", "seg_no", F.length("segment").cast("bigint").alias("n_chars"),
                         F.md5("segment").alias("segment_md5"))


def company_summaries(spark, folder):
    return rollup.summarize_companies(spread(articles(spark, folder)), text="content", keys=GROUP)


def sector_summaries(spark, folder):
    return rollup.summarize_sectors(spread(articles(spark, folder)), "doc_id", text="content",
                                    keys=["year", "sector_name"])


def company_prompts(spark, folder):
    """What a model would be asked: the scorer gives the prompt itself as its answer."""
    asked = rollup.summarize_companies(spread(articles(spark, folder)), text="content", keys=GROUP,
                                       scorer=lambda t: t, with_prompts=True, in_pages=True)
    return ordering.digests(asked, GROUP, "page_no", "summary_result").withColumnRenamed("md5", "prompt_md5")


def sector_prompts(spark, folder):
    asked = rollup.summarize_sectors(spread(articles(spark, folder)), "doc_id", text="content",
                                     keys=["year", "sector_name"], scorer=lambda t: t, with_prompts=True,
                                     in_pages=True)
    return ordering.digests(asked, ["year", "sector_name"], "page_no", "sector_summary").withColumnRenamed(
        "md5", "prompt_md5")


def keyword_lists(spark, folder):
    rows = articles(spark, folder).select(
        "year", "company_name", "doc_id",
        F.array_max(tx.content_words(F.col("content"))).alias("keywords"),
        numeric.plain_number(F.length("content") / 1000).alias("keywords_score"),
        numeric.plain_number(F.col("success"), 1).alias("keywords_sentiment"))
    return rollup.keyword_lists(rows, ["year", "company_name"], "doc_id")


def first_non_null(spark, folder):
    labels = table(spark, folder, "labels")
    rows = articles(spark, folder).join(labels, "doc_id", "left").withColumn(
        "short_text", F.when(F.col("quality") == 1, F.col("content")))
    return ordering.first_values(rows, GROUP, ["quality", "toxic", "short_text"], "doc_id").select(
        *GROUP, F.col("quality").cast("string").alias("quality"),
        F.col("toxic").cast("string").alias("toxic"), F.md5("short_text").alias("short_md5"))


def group_mean_broadcast(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return joins.with_group_values(events, ["event_type"], ["event_id"],
                                   mean_value=F.round(F.avg("value"), 4))


def dedupe_first(spark, folder):
    return ordering.first_rows(articles(spark, folder), ["company_name", "year"], "doc_id").select(
        "company_name", "year", "doc_id", F.md5("content").alias("content_md5"))


def trend_prompts(spark, folder):
    rows = articles(spark, folder).select(
        F.col("company_name").alias("sector_name"), "year", "doc_id",
        tx.richest_sentence(F.col("content")).alias("sector_summary"))
    return rollup.trend_prompts(rows, "doc_id").select("sector_name", "prompt")


def keyword_sentiments(spark, folder):
    found = keywords.company_keywords(spread(articles(spark, folder)), "content", top_n=10).select(
        "doc_id", "company_name", "year", "kw_no", "keywords")
    scored = found.withColumn("keywords_sentiment", scoring.lexicon_polarity(
        F.col("keywords"), UP_WORDS, DOWN_WORDS))
    return joins.with_group_values(
        checkpointed(scored), ["company_name", "year"], ["doc_id", "kw_no"],
        company_sentiment=F.round(F.avg("keywords_sentiment"), 9))


def corpus_rows(spark, folder):
    """Rows shaped like the final table, for the corpus; labels say which texts are missing."""
    return summarized(spark, folder).join(table(spark, folder, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("seq"), "year", "sector_name",
        F.col("summary").alias("company_summary"),
        F.when(F.col("quality") == 1, F.col("content")).alias("sector_summary"),
        F.when(F.col("toxic") == 0, F.col("content")).alias("sector_trend"))


def build_corpus(spark, folder):
    corpus = retrieval.build_corpus(corpus_rows(spark, folder))
    return corpus.select(
        F.col("doc_ord.kind").cast("bigint").alias("kind"), F.col("doc_ord.year").alias("year"),
        F.col("doc_ord.sector").alias("sector"), F.col("doc_ord.seq").alias("seq"),
        F.md5("text").alias("text_md5"))


def final_dataset(spark, folder):
    tables = news.report(
        spread(articles(spark, folder)), sector_mapping(spark, folder), order="doc_id",
        polarity=lambda t: scoring.lexicon_polarity(t, UP_WORDS, DOWN_WORDS))
    # Means of scores with three decimals are compared well beyond their own digits.
    return tables.final.withColumns({
        c: F.round(c, 9) for c in ("company_sentiment", "sector_sentiment")})


def _final_sql() -> str:
    placed = f"""(SELECT a.* REPLACE (coalesce(m.sector_name, '') AS sector_name)
        FROM {sql.article_summaries()} a LEFT JOIN {LAST_WINS} m USING (company_name))"""
    own = "lower(keyword) NOT IN (lower(company_name), lower(sector_name), CAST(year AS VARCHAR))"
    none = ("NOT contains(keyword, CAST(year AS VARCHAR)) AND "
            "NOT contains(lower(keyword), lower(sector_name))")
    ckeys, skeys = ["year", "company_name", "sector_name"], ["year", "sector_name"]
    polarity = sql.lexicon_polarity("keywords", UP_WORDS, DOWN_WORDS)
    ckw = sql.keyword_rows("companies", ckeys, "summary_result", 1, 10, own)
    skw = sql.keyword_rows("sectors", skeys, "sector_summary", 2, 7, none)

    def lists(prefix: str, relation: str, keys: list[str]) -> str:
        return f"""(SELECT {', '.join(keys)},
          string_agg(keywords, '; ' ORDER BY kw_no) AS {prefix}_keywords,
          string_agg(CAST(CAST(keywords_score AS DECIMAL(38, 4)) AS VARCHAR), '; ' ORDER BY kw_no)
            AS {prefix}_keywords_score,
          string_agg(CAST(CAST(s AS DECIMAL(38, 4)) AS VARCHAR), '; ' ORDER BY kw_no)
            AS {prefix}_keywords_sentiment,
          round(avg(s), 9) AS {prefix}_sentiment
          FROM (SELECT *, {polarity} AS s FROM {relation} k) q GROUP BY {', '.join(keys)})"""

    trend_line = "'Summary in ' || CAST(year AS VARCHAR) || ': ' || sector_summary"
    lines = f"string_agg({trend_line}, {sql.NEWLINE} ORDER BY year)"
    trend = sql.richest_sentence("lines")
    return f"""WITH placed AS MATERIALIZED {placed},
      companies AS MATERIALIZED {sql.company_summaries('placed', ckeys, 'doc_id')},
      sectors AS MATERIALIZED {sql.sector_summaries(
          "(SELECT * FROM companies WHERE sector_name IS NOT NULL)", skeys, 'company_name', 'summary_result')},
      trends AS (SELECT sector_name, {trend} AS sector_trend FROM
        (SELECT sector_name, {lines} AS lines FROM sectors GROUP BY sector_name) q),
      c AS {lists('company', ckw, ckeys)},
      s AS {lists('sector', skw, skeys)}
    SELECT c.*, companies.summary_result AS company_summary, s.sector_keywords, s.sector_keywords_score,
      s.sector_keywords_sentiment, s.sector_sentiment,
      CASE WHEN s.sector_keywords IS NOT NULL THEN sectors.sector_summary END AS sector_summary, sector_trend
    FROM c JOIN companies USING (year, company_name, sector_name)
      LEFT JOIN s USING (year, sector_name) LEFT JOIN sectors USING (year, sector_name)
      LEFT JOIN trends USING (sector_name)"""


_SUMMARIZED = f"""(SELECT *, CASE WHEN success = 1 THEN {sql.richest_sentence('content')} END AS summary
    FROM {sql.ARTICLES} b)"""

_CORPUS = f"""(SELECT doc_id AS seq, year, sector_name, summary AS company_summary,
    CASE WHEN quality = 1 THEN content END AS sector_summary,
    CASE WHEN toxic = 0 THEN content END AS sector_trend FROM {_SUMMARIZED} s LEFT JOIN labels USING (doc_id))"""


def _paged(keys: str) -> str:
    return f"""(SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY doc_id) - 1) // 1000 AS page_no
        FROM {_SUMMARIZED} s)"""


ORACLES = {
    "company_text_rollup": f"""SELECT company_name, sector_name, page_no, length(t) AS n_chars,
          md5(t) AS summary_md5 FROM (SELECT company_name, sector_name, page_no,
            coalesce(string_agg(nullif(summary, ''), '###' ORDER BY doc_id), '') AS t
          FROM {_paged('company_name, sector_name')} s GROUP BY ALL)""",
    "sector_text_rollup": f"""SELECT year, sector_name, page_no, length(t) AS n_chars,
          md5(t) AS content_md5 FROM (SELECT year, sector_name, page_no,
            coalesce(string_agg(summary, ' ### ' ORDER BY doc_id), '') AS t
          FROM {_paged('year, sector_name')} s GROUP BY ALL)""",
    "pack_by_chars": f"""SELECT company_name, seg_no, length(segment) AS n_chars, md5(segment) AS segment_md5
        FROM {sql.pack_chars(sql.ARTICLES, ['company_name'], 'doc_id', 'content')} p""",
    "pack_by_words": f"""SELECT company_name, seg_no, length(segment) AS n_chars, md5(segment) AS segment_md5
        FROM {sql.pack_words(sql.ARTICLES, ['company_name'], 'doc_id', 'content')} p""",
    "company_summaries": f"SELECT * FROM {sql.company_summaries(sql.ARTICLES, GROUP, 'doc_id', 'content')} c",
    "sector_summaries": f"""SELECT * FROM {sql.sector_summaries(
        sql.ARTICLES, ['year', 'sector_name'], 'doc_id', 'content')} c""",
    "company_prompts": f"""SELECT company_name, sector_name, length(summary_result) AS n_chars,
        md5(summary_result) AS prompt_md5 FROM {sql.company_summaries(
            sql.ARTICLES, GROUP, 'doc_id', 'content',
            lambda x: sql.fill(prompts.COMPANY_SEGMENT, text=x),
            lambda x: sql.fill(prompts.COMPANY_FINAL, text=x))} c""",
    "sector_prompts": f"""SELECT year, sector_name, length(sector_summary) AS n_chars,
        md5(sector_summary) AS prompt_md5 FROM {sql.sector_summaries(
            sql.ARTICLES, ['year', 'sector_name'], 'doc_id', 'content',
            lambda x: sql.fill(prompts.SECTOR_PART, sector='sector_name', number='seg_no', text=sql.fill(
                prompts.SECTOR_SEGMENT, sector='sector_name', text=x)),
            lambda x: sql.fill(prompts.SECTOR_FINAL, sector='sector_name', year='year', text=x))} c""",
    "keyword_lists": f"""SELECT year, company_name, page_no,
          string_agg(coalesce(k, ''), '; ' ORDER BY doc_id) AS keywords,
          string_agg(CAST(CAST(n / CAST(1000 AS DOUBLE) AS DECIMAL(38, 4)) AS VARCHAR), '; ' ORDER BY doc_id)
            AS keywords_score,
          string_agg(CAST(CAST(success AS DECIMAL(38, 1)) AS VARCHAR), '; ' ORDER BY doc_id)
            AS keywords_sentiment
        FROM (SELECT *, list_max({sql.content_words('content')}) AS k, length(content) AS n,
          (row_number() OVER (PARTITION BY year, company_name ORDER BY doc_id) - 1) // 1000 AS page_no
          FROM {sql.ARTICLES} a)
        GROUP BY year, company_name, page_no""",
    "first_non_null": f"""SELECT company_name, sector_name,
          CAST(arg_min(quality, doc_id) FILTER (WHERE quality IS NOT NULL) AS VARCHAR) AS quality,
          CAST(arg_min(toxic, doc_id) FILTER (WHERE toxic IS NOT NULL) AS VARCHAR) AS toxic,
          md5(arg_min(content, doc_id) FILTER (WHERE quality = 1)) AS short_md5
        FROM {sql.ARTICLES} a LEFT JOIN labels USING (doc_id) GROUP BY company_name, sector_name""",
    "group_mean_broadcast": """SELECT event_id, event_type, value,
          round(avg(value) OVER (PARTITION BY event_type), 4) AS mean_value FROM events""",
    "dedupe_first": f"""SELECT company_name, year, doc_id, md5(content) AS content_md5 FROM {sql.ARTICLES} a
        QUALIFY row_number() OVER (PARTITION BY company_name, year ORDER BY doc_id) = 1""",
    "trend_prompts": f"""WITH f AS (SELECT company_name AS sector_name, year,
            {sql.richest_sentence('content')} AS s FROM {sql.ARTICLES} a
            QUALIFY row_number() OVER (PARTITION BY company_name, year ORDER BY doc_id) = 1)
        SELECT sector_name, 'Provide a comprehensive analysis on ' || sector_name || ' sector trends. Include '
          || 'developments, challenges, and achievements. Focus on technology, market dynamics, regulatory '
          || 'changes, and milestones. Highlight the main challenges and forces hindering the sector''s '
          || 'development, offering a balanced view.' || E'\\n\\n'
          || string_agg('Summary in ' || CAST(year AS VARCHAR) || ': ' || s, {sql.NEWLINE} ORDER BY year)
          AS prompt FROM f GROUP BY sector_name""",
    "keyword_sentiments": f"""WITH k AS (SELECT doc_id, company_name, year, kw_no, keywords,
            {sql.lexicon_polarity('keywords', UP_WORDS, DOWN_WORDS)} AS keywords_sentiment
          FROM {sql.keyword_rows(sql.ARTICLES, ['doc_id'], 'content', 1, 10,
              "lower(keyword) NOT IN (lower(company_name), lower(sector_name), CAST(year AS VARCHAR))",
              ['company_name', 'year'])} r)
        SELECT *, round(avg(keywords_sentiment) OVER (PARTITION BY company_name, year), 9)
          AS company_sentiment FROM k""",
    "build_corpus": f"""WITH f AS {_CORPUS}
        SELECT CAST(1 AS BIGINT) AS kind, CAST(0 AS BIGINT) AS year, '' AS sector, seq,
          md5(company_summary) AS text_md5 FROM f
        UNION ALL SELECT 2, year, sector_name, 0,
          md5(arg_min(sector_summary, seq) FILTER (WHERE sector_summary IS NOT NULL))
          FROM f GROUP BY year, sector_name
        UNION ALL SELECT 3, 0, sector_name, 0,
          md5(arg_min(sector_trend, seq) FILTER (WHERE sector_trend IS NOT NULL))
          FROM f GROUP BY sector_name""",
    "final_dataset": _final_sql(),
}

QUERIES = {f.__name__: f for f in (
    company_text_rollup, sector_text_rollup, pack_by_chars, pack_by_words, company_summaries,
    sector_summaries, company_prompts, sector_prompts, keyword_lists, first_non_null, group_mean_broadcast, dedupe_first,
    trend_prompts, keyword_sentiments, build_corpus, final_dataset)}
