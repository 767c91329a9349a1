"""The operators applied to the whole test tables, with the SQL that DuckDB can run beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_pairs, jaccard, licenses, negatives, neighbours, packing, periods, pieces, quality, secrets,
               suffixes, toxicity, urls)

QUERIES, ORACLES = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), keep=False)


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(table(spark, folder, "documents"), keep=False)


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    base = quality.measured(docs.select("doc_id", "text")).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    first = quality.Rule("base", "base_failed")
    judged = quality.cascade(base, [first, *quality.ordered(docs, prepare=quality.measured)])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed",
                         F.col("rejected_by").isNull().alias("kept"))


ORACLES["op8_quality_rules"] = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM cut
), windows AS (
  SELECT r, i, list_slice(w, i, i + 4) AS g
  FROM words, unnest(range(1, len(w) - 3)) AS u(i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + s) AS n FROM twice, range(5) AS f(s) GROUP BY r
), measures AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper_chars
  FROM words LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 10 > n_words * 3
            OR n_dup_lines * 10 > n_lines * 3 OR word_chars < n_words * 2 OR word_chars > n_words * 15
            OR upper_chars * 2 > word_chars) AS kept
FROM measures"""


RULES = (("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/"),
         ("block", "example.org/en/1"), ("block", "com/de/"))


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    # The pages of advertisers, casinos and the like make the list.
    form, host = urls.canonical(F.col("url")), urls.host_of(F.col("url"))
    suspect = pages.where(host.rlike("(^|[.])(ads|casino|spam|free|click)-")).select(form.alias("canonical"))
    return urls.judged(pages, RULES, suspect)


ORACLES["op6_url_filters"] = r"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), forms AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') AS form
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM forms
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN host <> '' AND form IN (SELECT form FROM forms
         WHERE regexp_matches(host, '(^|[.])(ads|casino|spam|free|click)-')) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled"""


@query
def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents"), keep=False)


def _license_sql() -> str:
    notice = ", ".join(f"('{label}', '{text}')" for label, texts in licenses.TEMPLATES.items() for text in texts)
    phrase = ", ".join(f"('{text}', '{label}')" for text, label in licenses.PHRASES.items())
    letters = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH notices AS (
  SELECT notice, label, len(w) AS length, len(list_distinct(w)) AS size, unnest(list_distinct(w)) AS word
  FROM (SELECT notice, label, regexp_extract_all({lower.format('notice')}, '{letters}') AS w
        FROM (VALUES {notice}) AS t(label, notice))
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {lower.format("coalesce(text, '')")} AS t FROM documents
), cut AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{letters}') AS w FROM docs
), places AS (
  SELECT r, label, i FROM cut, (VALUES {phrase}) AS p(phrase, label),
         unnest(range(1, len(w) + 1)) AS u(i)
  WHERE array_to_string(list_slice(w, i, i + len(string_split(phrase, ' ')) - 1), ' ') = phrase
), base AS (
  SELECT r, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, list(DISTINCT label) AS l FROM places GROUP BY r
), hits AS (
  SELECT r, i, word, notice, label, length, size
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM cut) JOIN notices USING (word)
), blocks AS (
  SELECT h.r, h.notice, h.label, h.length, h.i AS a, max(g.i) AS z, count(DISTINCT g.word) / h.size AS share
  FROM hits h JOIN hits g ON h.r = g.r AND h.notice = g.notice AND g.i >= h.i AND g.i < h.i + h.length
  GROUP BY h.r, h.notice, h.label, h.length, h.i, h.size
  HAVING count(DISTINCT g.word) / h.size >= {licenses.THRESHOLD} - 1e-9
), best AS (
  SELECT * FROM blocks b WHERE NOT EXISTS (
    SELECT 1 FROM blocks o WHERE o.r = b.r AND o.notice = b.notice AND o.a <= b.z AND b.a <= o.z
      AND (o.share > b.share OR o.share = b.share AND o.a < b.a))
), met AS (
  SELECT r, list(DISTINCT label) AS l, max(share) AS share FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM best o WHERE o.r = b.r AND o.label <> b.label AND o.a <= b.z AND b.a <= o.z
      AND (o.share > b.share OR o.share = b.share AND o.length > b.length))
  GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
       coalesce(array_to_string(list_sort(base.l), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_concat(coalesce(base.l, []), coalesce(met.l, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM cut LEFT JOIN base USING (r) LEFT JOIN met USING (r)"""


ORACLES["op9_license_scans"] = _license_sql()


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scores = toxicity.scored(docs, model, spans=False)
    return scores.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.joined(table(spark, folder, "documents"))


ORACLES["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
         lambda x: x <> '') AS w
  FROM documents
), tokens AS (
  SELECT DISTINCT r, list_slice(w, i, i + 2) AS t
  FROM docs, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS u(i)
), sizes AS (
  SELECT r, count(*) AS n FROM tokens GROUP BY r
), pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS shared FROM tokens a JOIN tokens b ON a.t = b.t AND a.r <> b.r
  GROUP BY ALL
), links AS (
  SELECT dx.doc_id AS x, dy.doc_id AS y FROM pairs
  JOIN sizes sx ON sx.r = x JOIN sizes sy ON sy.r = y JOIN docs dx ON dx.r = x JOIN docs dy ON dy.r = y
  WHERE 100 * shared >= 90 * (sx.n + sy.n - shared)
), reach AS (
  SELECT x, x AS y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), lowest AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN lowest USING (doc_id)"""


@query
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.matches(table(spark, folder, "documents"))


#: Secrets that their issuer's prefix and length give away.
ISSUED = ("(AKIA|ASIA)[A-Z0-9]{16}", "gh[opsur]_[A-Za-z0-9]{36,}", "github_pat_[A-Za-z0-9_]{22,}",
          "glpat-[A-Za-z0-9_-]{20,}", "[rs]k_(live|test)_[A-Za-z0-9]{16,}", "xox[abeoprs]-[A-Za-z0-9-]{10,}",
          "AIza[A-Za-z0-9_-]{35}", "sk-[A-Za-z0-9_-]{20,}", "npm_[A-Za-z0-9]{36}", "hf_[A-Za-z0-9]{30,}")
_PIECE = "([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})"


def finding_form():
    """1 for candidates that are secrets by their form, 0 for those that are clearly none, else null.

    Secrets have an issuer's prefix, or stand in an assignment, quoted or not: as hexadecimal keys
    of a usual length in quotes, or to a name like key, token, secret or password with letters and
    digits mixed and many different ones.  Words, digits alone and paths are none, unless such a
    name stands before them.
    """
    # A value may follow its name without a blank; then both are in the candidate.
    inner = "^[A-Za-z_][A-Za-z0-9_-]*=(?=[^=])"
    value = F.regexp_replace("candidate", inner, "")
    before = F.concat("before", F.regexp_extract("candidate", inner, 0))
    issued = value.rlike("^(" + "|".join(ISSUED) + ")$")
    assigned = before.rlike("""[A-Za-z0-9_][\"']?\\s*(=|:|:=|=>)\\s*[\"']?$""")
    named = before.rlike("""(?i)(key|token|secret|passw|pwd|auth|credential)[a-z0-9_.-]*["']?\\s*(=|:|:=|=>)"""
                         """\\s*((bearer|basic)\\s+)?["']?$""")
    quoted = before.rlike("""["']$""") & F.col("after").rlike("""^["']""")
    hexadecimal = value.rlike("^([0-9a-f]+|[0-9A-F]+)$") & value.rlike("[A-Fa-f]") & value.rlike("[0-9]") \
        & F.length(value).isin(32, 40, 48, 56, 64, 96, 128)
    mixed = value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (F.length(value) >= 16) \
        & (F.size(F.array_distinct(F.split(value, ""))) >= 10) \
        & ~value.rlike(f"^[/_+=-]*{_PIECE}([/_+=-]+{_PIECE})*[/_+=-]*$")
    secret = issued | (hexadecimal & assigned & quoted) | (named & (hexadecimal | mixed))
    plain = F.col("candidate").rlike(f"^[/_+=-]*{_PIECE}([/_+=-]+{_PIECE})*[/_+=-]*$") \
        | F.col("candidate").rlike("^[0-9/_+=-]+$")
    return F.when(secret, 1).when(plain & ~named, 0)


def finding_label(fold: str = "doc_id"):
    """Labels for candidates of two thirds of the documents, by a check of their form.

    No table holds labelled findings.  What :func:`finding_form` leaves open is not labelled.
    """
    return F.when(~toxicity.held_out(fold), finding_form())


@query
def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(table(spark, folder, "documents"), finding_label())
    return found.where("score >= 0.5").select(
        "doc_id", "start", F.length("candidate").alias("length"), "candidate", "score")


def _looped(docs: DataFrame) -> DataFrame:
    """Every tenth document by the checksum of its id repeats a stretch to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"),
                       F.floor(h / 10).cast("long").alias("g"))
    n = F.size("w")
    placed = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    placed = placed.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    looped = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, w[cast(a + (i - a) % p AS int)])), ' ')")
    return placed.select("doc_id", F.when(n > 0, looped).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.found(_looped(table(spark, folder, "documents")), keep=False)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise("")).cast("binary"), 256)
        .alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op11_hard_negatives"] = """
WITH points AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM points a JOIN points b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


@query
def op12_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_pairs.encoded(table(spark, folder, "documents"), keep=False)
