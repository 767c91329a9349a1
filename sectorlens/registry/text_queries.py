"""Queries on single texts, pages and URLs, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts, web, wordlists
from ..functions import text as tx
from ..operators import cleaning, keywords, lookup, rollup, scoring, segments, windows
from ..sources.readers import spread
from . import sql
from .roles import articles, table

MARKERS = ("license", "share", "rights")
ENERGY_TYPES = ("ECONOMY", "PROMO")
UP_WORDS, DOWN_WORDS = ("is", "est", "ist", "es", "the"), ("no", "un", "und", "of")
KEYWORDS = {"en": ["energy", "power"], "fr": ["énergie"], "de": [""]}
SEARCH_YEARS = (2022, 2023)


def proj_article_columns(spark, folder):
    return articles(spark, folder).select("sector_name", "company_name", "doc_id")


def explode_urls(spark, folder):
    pages = table(spark, folder, "pages").select(
        "page_id", "url", F.regexp_extract("url", "//[^/]+/([a-z]+)", 1).alias("company_name"),
        F.regexp_extract("url", "^([a-z]+):", 1).alias("sector_keyword"))
    records = lookup.search_records(pages, ["company_name", "sector_keyword"], "page_id", "url", 12)
    return lookup.explode_urls(records)


def rejected_articles(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    judged = articles(spark, folder).join(labels, "doc_id", "left").select(
        "doc_id", "year", "success", tx.richest_sentence(F.col("content")).alias("summary"),
        F.when(F.col("quality") == 0, "No, it is not.")
         .when(F.col("quality") == 1, "yes: nothing against it").alias("answer"))
    done = cleaning.reject_irrelevant(judged)
    return done.select("doc_id", "year", "success", F.md5("summary").alias("summary_md5"),
                       F.md5("rejected_text").alias("rejected_md5"))


def null_failed_text(spark, folder):
    return cleaning.null_failed_text(articles(spark, folder)).select(
        "doc_id", "success", F.md5("content").alias("content_md5"))


def length_filter(spark, folder):
    return cleaning.filter_length(articles(spark, folder)).select(
        "doc_id", F.col("success").cast("bigint").alias("success"),
        F.md5("content").alias("content_md5"))


def collapse_newlines(spark, folder):
    spread = articles(spark, folder).withColumn(
        "content", F.replace("content", F.lit(". "), F.lit(".\n\n\n")))
    return cleaning.collapse_blank_lines(spread).select(
        "doc_id", F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("content_md5"))


def strip_boilerplate(spark, folder):
    return cleaning.strip_boilerplate(spread(articles(spark, folder)), markers=MARKERS).select(
        "doc_id", F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("content_md5"))


def sentence_split(spark, folder):
    return cleaning.split_sentences(spread(articles(spark, folder)), ["doc_id"]).select(
        "doc_id", "pos", F.md5("sentence").alias("sentence_md5"))


def verb_line_filter(spark, folder):
    return cleaning.keep_verb_lines(spread(articles(spark, folder)), language="sector_name").select(
        "doc_id", F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("content_md5"))


def page_text(spark, folder):
    return cleaning.parse_pages(spread(table(spark, folder, "pages"))).select(
        "page_id", F.col("success").cast("bigint").alias("success"),
        F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("content_md5"))


def preprocess_tokens(spark, folder):
    kept = tx.content_words(F.col("content"))
    return spread(articles(spark, folder)).select("doc_id", kept.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def root_domain(spark, folder):
    return lookup.root_domains(table(spark, folder, "pages").select("page_id", "url"))


def trigram_mismatch(spark, folder):
    sites = lookup.root_domains(table(spark, folder, "pages").select(
        "page_id", "url",
        F.lower(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("company_name")))
    return lookup.name_mismatches(sites)


def last_token(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", web.last_part(F.col("url"), "/").alias("last_token"))


def sector_class(spark, folder):
    kind = F.col("p_type")
    return table(spark, folder, "part").select(
        "p_partkey", lookup.report_family(kind, "nationwide", ENERGY_TYPES).alias("nationwide"),
        lookup.report_family(kind, "provinces", ENERGY_TYPES).alias("provinces"),
        lookup.report_family(kind, "sectorSentiment", ENERGY_TYPES).alias("other"))


def sector_mapping(spark, folder):
    """(sector_ord, sector_name, company_name): sectors with a fifth of a company's articles or more."""
    docs = table(spark, folder, "documents")
    order = docs.groupBy("lang").agg(F.min("doc_id").alias("sector_ord"))
    counts = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    whole = docs.groupBy("source").agg(F.count(F.lit(1)).alias("all"))
    pairs = counts.join(whole, "source").where(F.col("n") * 5 >= F.col("all"))
    return pairs.join(order, "lang").select(
        "sector_ord", F.col("lang").alias("sector_name"), F.col("source").alias("company_name"))


def lookup_last_wins(spark, folder):
    found = lookup.add_sector(articles(spark, folder).select("doc_id", "company_name"),
                              sector_mapping(spark, folder), ["doc_id"])
    return found.select("doc_id", "company_name", "sector_name")


def search_terms(spark, folder):
    mapping = articles(spark, folder).select("sector_name", "company_name").distinct()
    words = spark.createDataFrame(list(KEYWORDS.items()), "sector_name string, keywords array<string>")
    found = lookup.search_terms(mapping, words, SEARCH_YEARS)
    return found.withColumn("year", F.col("year").cast("bigint"))


def token_windows(spark, folder):
    return windows.token_windows(spread(articles(spark, folder)), ["doc_id"]).select(
        "doc_id", "seg_no", "token_len", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


def token_window_limits(spark, folder):
    return windows.longest_document(articles(spark, folder))


def segment_summaries(spark, folder):
    return rollup.summarize_articles(spread(articles(spark, folder))).select(
        "doc_id", F.length("summary").cast("bigint").alias("n_chars"),
        F.md5("summary").alias("summary_md5"))


def relevance_prompts(spark, folder):
    prompt = prompts.fill(prompts.RELEVANCE, sector=F.col("sector_name"),
                          text=tx.richest_sentence(F.col("content")))
    return articles(spark, folder).select("doc_id", prompt.alias("prompt"))


def mmr_select(spark, folder):
    picked = keywords.select_diverse(keywords.keyword_terms(F.col("content")), 1, 10)
    return spread(articles(spark, folder)).select("doc_id", F.posexplode(picked).alias("at", "p")).select(
        "doc_id", (F.col("at") + 1).cast("bigint").alias("pick_no"), F.col("p.keyword").alias("keyword"),
        F.round("p.rel", 6).alias("rel"))


def keywords_company(spark, folder):
    return keywords.company_keywords(spread(articles(spark, folder)), "content").select(
        "doc_id", "kw_no", "keywords", "keywords_score")


def keywords_sector(spark, folder):
    return keywords.sector_keywords(spread(articles(spark, folder)), "content").select(
        "doc_id", "kw_no", "keywords", "keywords_score")


def sentiment_scores(spark, folder):
    score = scoring.lexicon_polarity(F.col("content"), UP_WORDS, DOWN_WORDS)
    return spread(articles(spark, folder)).select("doc_id", score.alias("sentiment"))


def semantic_segments(spark, folder):
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", "text",
        F.when(F.col("role") == "user", 2).otherwise(1).alias("images"))
    return segments.semantic_segments(turns)


_VERB_KEPT = "text"
for _code in sorted(wordlists.VERB_WORDS):
    _pattern = tx.verb_pattern(wordlists.VERB_WORDS[_code], wordlists.VERB_SUFFIXES[_code]).replace("(?iu)", "(?i)")
    _VERB_KEPT = f"""CASE WHEN lang = '{_code}' THEN array_to_string(list_filter(
        string_split(text, {sql.NEWLINE}), lambda line: len(list_filter({sql.sentences('line')},
        lambda s: NOT regexp_matches(s, '{_pattern}'))) = 0), {sql.NEWLINE}) ELSE {_VERB_KEPT} END"""

_BODY = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
for _tag in web.DROPPED_BLOCKS:
    _BODY = f"regexp_replace({_BODY}, '(?is)<{_tag}(\\s[^>]*)?>.*?</{_tag}>', '', 'g')"
_PLAIN = "regexp_replace(p, '(?s)<[^>]*>', ' ', 'g')"
for _reference, _character in web.CHARACTER_REFERENCES:
    _PLAIN = "replace({}, '{}', '{}')".format(_PLAIN, _reference, _character.replace("'", "''"))
_PLAIN = sql.trim(f"regexp_replace({_PLAIN}, '[ \\t\\r\\n]+', ' ', 'g')")

_DOMAIN = """split_part(CASE WHEN contains(url, 'www.') THEN substr(url, instr(url, 'www.') + 4)
    WHEN contains(url, '//') THEN substr(url, instr(url, '//') + 2) ELSE url END, '/', 1)"""

MAPPING = """(SELECT o.sector_ord, p.lang AS sector_name, p.source AS company_name
    FROM (SELECT lang, source FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) a
      JOIN (SELECT source, count(*) AS every FROM documents GROUP BY ALL) b USING (source)
      WHERE n * 5 >= every) p
    JOIN (SELECT lang, min(doc_id) AS sector_ord FROM documents GROUP BY lang) o USING (lang))"""

LAST_WINS = f"""(SELECT company_name, arg_max(sector_name, sector_ord) AS sector_name
    FROM {MAPPING} m GROUP BY company_name)"""

_OWN_NAME = "lower(keyword) NOT IN (lower(company_name), lower(sector_name), CAST(year AS VARCHAR))"
_NO_NAME = ("NOT contains(keyword, CAST(year AS VARCHAR)) AND "
            "NOT contains(lower(keyword), lower(sector_name))")

ORACLES = {
    "proj_article_columns": f"SELECT sector_name, company_name, doc_id FROM {sql.ARTICLES} a",
    "explode_urls": """WITH p AS (SELECT page_id, url,
          regexp_extract(url, '//[^/]+/([a-z]+)', 1) AS company_name,
          regexp_extract(url, '^([a-z]+):', 1) AS sector_keyword FROM pages),
        r AS (SELECT *, row_number() OVER (PARTITION BY company_name, sector_keyword ORDER BY page_id)
          AS url_no FROM p)
        SELECT company_name, sector_keyword, count(*) OVER (PARTITION BY company_name, sector_keyword)
          AS count, url_no, url FROM r WHERE url_no <= 10""",
    "rejected_articles": f"""SELECT doc_id, year,
          CASE WHEN quality = 0 AND s <> '' THEN -2 ELSE success END AS success,
          md5(CASE WHEN quality = 0 THEN '' ELSE s END) AS summary_md5,
          CASE WHEN quality = 0 AND s <> '' THEN md5(s) END AS rejected_md5
        FROM (SELECT doc_id, year, success, {sql.richest_sentence('content')} AS s, quality
          FROM {sql.ARTICLES} a LEFT JOIN labels USING (doc_id))""",
    "null_failed_text": f"""SELECT doc_id, success,
          CASE WHEN success <> 0 THEN md5(content) END AS content_md5 FROM {sql.ARTICLES} a""",
    "length_filter": f"""SELECT doc_id,
          CASE WHEN length(content) BETWEEN 200 AND 30000 THEN success ELSE -1 END AS success,
          CASE WHEN length(content) BETWEEN 200 AND 30000 THEN md5(content) END AS content_md5
        FROM {sql.ARTICLES} a""",
    "collapse_newlines": f"""SELECT doc_id, length(t) AS n_chars, md5(t) AS content_md5 FROM
        (SELECT doc_id, regexp_replace(replace(text, '. ', E'.\\n\\n\\n'), '\\n+', {sql.NEWLINE}, 'g') AS t
         FROM documents)""",
    "strip_boilerplate": f"""WITH RECURSIVE m AS (SELECT {list(MARKERS)} AS l),
        r AS (SELECT doc_id, 1 AS i, text AS t FROM documents
          UNION ALL
          SELECT doc_id, CASE WHEN hit = 0 THEN i + 1 ELSE i END,
            CASE WHEN hit = 0 THEN t ELSE substr(t, 1, hit - 1) ||
              CASE WHEN instr(substr(t, hit), {sql.NEWLINE}) = 0 THEN ''
                ELSE substr(t, hit + instr(substr(t, hit), {sql.NEWLINE})) END END
          FROM (SELECT doc_id, i, t, instr(lower(t), l[i]) AS hit FROM r, m WHERE i <= 3) s)
        SELECT doc_id, length(t) AS n_chars, md5(t) AS content_md5 FROM r WHERE i = 4""",
    "sentence_split": f"""SELECT doc_id, CAST(generate_subscripts(s, 1) AS BIGINT) AS pos,
          md5(unnest(s)) AS sentence_md5
        FROM (SELECT doc_id, {sql.sentences('text')} AS s FROM documents)""",
    "verb_line_filter": f"""SELECT doc_id, length(t) AS n_chars, md5(t) AS content_md5
        FROM (SELECT doc_id, {_VERB_KEPT} AS t FROM documents)""",
    "page_text": f"""WITH b AS (SELECT page_id, {_BODY} AS body FROM pages),
        f AS (SELECT page_id, regexp_extract_all(
            regexp_replace(body, '(?i)<p(\\s[^>]*)?>', '</p><p>', 'g') || '</p>',
            '(?is)<p>(.*?)</p>', 1) AS found FROM b),
        t AS (SELECT page_id, array_to_string(list_filter(list_transform(found, lambda p: {_PLAIN}),
            lambda p: p <> ''), E'\\n\\n') AS txt FROM f),
        c AS (SELECT page_id, CAST(length(txt) > 0 AS BIGINT) AS success,
          CASE WHEN length(txt) > 0 THEN txt ELSE 'no article text' END AS content FROM t)
        SELECT page_id, success, length(content) AS n_chars, md5(content) AS content_md5 FROM c""",
    "preprocess_tokens": f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
        FROM (SELECT doc_id, {sql.content_words('text')} AS t FROM documents)""",
    "root_domain": f"SELECT page_id, url, {_DOMAIN} AS root_domain FROM pages",
    "trigram_mismatch": f"""SELECT * FROM (SELECT page_id, url,
          lower(regexp_extract(html, '<title>([^<]*)', 1)) AS company_name, {_DOMAIN} AS root_domain FROM pages)
        WHERE len(list_filter(range(1, greatest(length(company_name) - 1, 1)),
          lambda i: contains(root_domain, substr(company_name, i, 3)))) = 0""",
    "last_token": "SELECT page_id, string_split(url, '/')[-1] AS last_token FROM pages",
    "sector_class": """SELECT p_partkey,
          CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'nationwideEnergy' ELSE 'nationwideUtil' END AS nationwide,
          CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'provincesEnergyMap' ELSE 'provincesUtilMap' END AS provinces,
          'sectorSentiment' AS other FROM part""",
    "lookup_last_wins": f"""SELECT doc_id, source AS company_name, coalesce(m.sector_name, '') AS sector_name
        FROM documents d LEFT JOIN {LAST_WINS} m ON d.source = m.company_name""",
    "search_terms": """WITH k AS (SELECT * FROM (VALUES ('en', ['energy', 'power']), ('fr', ['énergie']),
          ('de', [''])) v(lang, l)),
        t AS (SELECT lang AS sector_name, source AS company_name, unnest(coalesce(l, [''])) AS keyword
          FROM (SELECT DISTINCT lang, source FROM documents) d LEFT JOIN k USING (lang))
        SELECT sector_name, company_name, keyword, CAST(y AS BIGINT) AS year,
          company_name || ' ' || keyword AS query, make_date(y, 1, 1) AS date_from,
          make_date(y, 12, 31) AS date_to
        FROM t, (VALUES (2022), (2023)) v(y)""",
    "token_windows": f"""WITH d AS (SELECT doc_id, {sql.blank_tokens('text')} AS t FROM documents),
        w AS (SELECT doc_id, t, unnest(range(0, CASE WHEN len(t) < 590 THEN 1
            ELSE CAST(floor((len(t) - 128) / 462.0) AS BIGINT) + 1 END)) AS k FROM d),
        c AS (SELECT doc_id, k + 1 AS seg_no, len(t) AS token_len, t[462 * k + 1 : 462 * k + 512] AS s FROM w)
        SELECT doc_id, seg_no, token_len, len(s) AS n_tokens, md5(array_to_string(s, ' ')) AS tokens_md5
        FROM c""",
    "token_window_limits": f"""SELECT m AS max_token_len,
          greatest(CAST(floor((m - 128) / 462.0) AS BIGINT), 0) + 1 AS max_windows
        FROM (SELECT max(len({sql.blank_tokens('text')})) AS m FROM documents)""",
    "segment_summaries": f"""SELECT doc_id, length(summary) AS n_chars, md5(summary) AS summary_md5
        FROM {sql.article_summaries()} s""",
    "relevance_prompts": f"""SELECT doc_id, 'Is this article related to financial news or related to ' || lang ||
          ' industry? Answer ''yes'' or ''no'': ' || {sql.richest_sentence('text')} AS prompt FROM documents""",
    "mmr_select": f"""SELECT doc_id, pick_no, keyword, round(rel, 6) AS rel
        FROM {sql.picks(sql.ARTICLES, ['doc_id'], 'content', 1, 10)} p""",
    "keywords_company": f"""SELECT doc_id, kw_no, keywords, keywords_score
        FROM {sql.keyword_rows(sql.ARTICLES, ['doc_id'], 'content', 1, 10, _OWN_NAME)} k""",
    "keywords_sector": f"""SELECT doc_id, kw_no, keywords, keywords_score
        FROM {sql.keyword_rows(sql.ARTICLES, ['doc_id'], 'content', 2, 7, _NO_NAME)} k""",
    "sentiment_scores": f"""SELECT doc_id,
          {sql.lexicon_polarity('text', UP_WORDS, DOWN_WORDS)} AS sentiment FROM documents""",
}

def _likeness(a: str, b: str) -> str:
    """Cosine of the counts of two word lists."""
    def dot(x: str, y: str) -> str:
        return f"coalesce(list_sum(list_transform({x}, lambda u: len(list_filter({y}, lambda v: v = u)))), 0)"

    norm = f"(sqrt({dot(a, a)}) * sqrt({dot(b, b)}))"
    return f"CASE WHEN {norm} > 0 THEN {dot(a, b)} / {norm} ELSE 0 END"


# One recursion joins sentences to paragraphs, the other merges paragraphs, one a step.
ORACLES["semantic_segments"] = rf"""WITH RECURSIVE
    t AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 2 ELSE 1 END AS images,
            {sql.sentences('text')} AS s FROM conversations WHERE text IS NOT NULL),
    long AS (SELECT *, list_transform(s, lambda x: list_transform(list_filter(
            string_split_regex(lower(x), '\s+'), lambda y: y <> ''), lambda y: trim(y, '.,;:!?'))) AS w
        FROM t WHERE len(s) > images + 1),
    grown AS (
        SELECT conv_id, turn, 1 AS i, [w[1]] AS parts, [s[1]] AS texts FROM long
        UNION ALL
        SELECT conv_id, turn, i + 1,
          CASE WHEN alike THEN list_append(parts[1:-2], list_concat(parts[-1], w[i + 1])) ELSE list_append(parts, w[i + 1]) END,
          CASE WHEN alike THEN list_append(texts[1:-2], texts[-1] || ' ' || s[i + 1]) ELSE list_append(texts, s[i + 1]) END
        FROM (SELECT g.*, s, w, {_likeness('parts[-1]', 'w[i + 1]')} >= {segments.THRESHOLD} AS alike
              FROM grown g JOIN long USING (conv_id, turn) WHERE i < len(s))),
    merged AS (
        SELECT conv_id, turn, images, parts, texts FROM grown JOIN long USING (conv_id, turn) WHERE i = len(s)
        UNION ALL
        SELECT conv_id, turn, images,
          list_concat(list_append(parts[1:best - 1], list_concat(parts[best], parts[best + 1])), parts[best + 2:]),
          list_concat(list_append(texts[1:best - 1], texts[best] || ' ' || texts[best + 1]), texts[best + 2:])
        FROM (SELECT *, list_position(likes, list_max(likes)) AS best
              FROM (SELECT *, list_transform(range(1, len(parts)), lambda k: {_likeness('parts[k]', 'parts[k + 1]')}) AS likes
                    FROM merged WHERE len(parts) > images + 1))),
    done AS (SELECT conv_id, turn, images, texts FROM merged WHERE len(parts) <= images + 1
        UNION ALL
        SELECT conv_id, turn, images, list_transform(range(images + 1), lambda k: array_to_string(s, ' '))
        FROM t WHERE len(s) <= images + 1)
    SELECT conv_id, turn, images, CAST(unnest(range(1, len(texts) + 1)) AS BIGINT) AS seg_no, unnest(texts) AS segment
    FROM done"""

QUERIES = {f.__name__: f for f in (
    proj_article_columns, explode_urls, rejected_articles, null_failed_text, length_filter,
    collapse_newlines, strip_boilerplate, sentence_split, verb_line_filter, page_text,
    preprocess_tokens, root_domain, trigram_mismatch, last_token, sector_class, lookup_last_wins,
    search_terms, token_windows, token_window_limits, segment_summaries, relevance_prompts,
    mmr_select, keywords_company, keywords_sector, sentiment_scores, semantic_segments)}
