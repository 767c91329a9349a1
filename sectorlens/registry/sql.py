"""Pieces of the SQL twins.  Each returns a relation in parentheses or an expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from ..functions import wordlists

BLANKS = r"E' \n\r\t'"
NEWLINE = r"E'\n'"

ARTICLES = """(SELECT doc_id, source AS company_name, lang AS sector_name,
    CAST(2008 + doc_id % 16 AS BIGINT) AS year,
    CAST(CASE WHEN contains(text, '.') THEN 1 ELSE 0 END AS BIGINT) AS success,
    text AS content FROM documents)"""

STATISTICS = """(SELECT l_orderkey AS seq, CAST(l_shipdate AS DATE) AS ref_date, n_name AS geo,
    l_returnflag || '-' || l_linestatus AS label, l_returnflag,
    CASE WHEN l_linestatus = 'F' THEN 'Cubic metres' ELSE 'Barrels' END AS uom, l_quantity AS value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

PLACES = """(SELECT n_name AS geo, n_nationkey * 2.0::DOUBLE - 20 AS latitude,
    n_nationkey * 5.0::DOUBLE - 100 AS longitude FROM nation)"""

ORDER_FACTS = """(SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS ref_date,
    o_orderpriority AS geo, o_orderstatus AS label, o_totalprice AS value FROM orders)"""

REGION = """CASE WHEN geo IN ('NATION_0', 'NATION_5', 'NATION_10') THEN 'North'
    WHEN geo IN ('NATION_1', 'NATION_6', 'NATION_11') THEN 'East' ELSE geo END"""


def quoted(words: Sequence[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = quoted(wordlists.STOP_WORDS_EN)


def trim(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def first_sentence(x: str) -> str:
    return trim(f"regexp_extract({x}, '^[^.!?]*[.!?]*', 0)")


def sentences(x: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({x}, '[^.!?]+[.!?]*'), "
            f"lambda q: {trim('q')}), lambda q: q <> '')")


def richest_sentence(x: str) -> str:
    rated = f"list_transform({sentences(x)}, lambda s: len(list_distinct({index_terms('s')})))"
    return (f"CASE WHEN {x} IS NOT NULL THEN coalesce(({sentences(x)})[list_position({rated}, "
            f"list_max({rated}))], '') END")


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def blank_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[ \\t\\r\\n\\f]+'), lambda w: w <> '')"


def content_words(x: str) -> str:
    return f"list_filter({words(x)}, lambda w: w NOT IN ({STOP}))"


def index_terms(x: str) -> str:
    return (f"list_filter(list_transform({content_words(x)}, lambda w: lower(w)), "
            f"lambda w: length(w) >= 2)")


def keyword_terms(x: str) -> str:
    return (f"list_filter(list_transform({words(x)}, lambda w: lower(w)), "
            f"lambda w: length(w) >= 2 AND w NOT IN ({STOP}))")


def article_summaries(relation: str = ARTICLES) -> str:
    """Articles with the summary of their token windows."""
    return f"""(WITH tokens AS (SELECT *, {blank_tokens('content')} AS t FROM {relation} a),
      cut AS (SELECT * EXCLUDE (t), list_transform(
          range(0, greatest(CAST(floor((len(t) - 128) / 462.0) AS BIGINT), 0) + 1),
          lambda k: array_to_string(t[462 * k + 1 : CASE WHEN k = greatest(CAST(
            floor((len(t) - 128) / 462.0) AS BIGINT), 0) THEN len(t) ELSE 462 * k + 512 END], ' ')) AS w FROM tokens)
    SELECT * EXCLUDE (w), array_to_string(list_transform(w, lambda x: {richest_sentence('x')}), ' ')
        AS summary FROM cut)"""


def pack_chars(relation: str, keys: Sequence[str], order: str, text: str, limit: int = 3000) -> str:
    """keys, seg_no, segment: greedy packing of '###' parts as a fold over the joined text."""
    k = ", ".join(keys)
    state = "{'p': '', 'done': CAST([] AS VARCHAR[]), 'cur': ''}"
    return f"""(WITH whole AS (SELECT {k}, string_agg({text}, '###' ORDER BY {order}) AS txt
        FROM {relation} r WHERE {text} IS NOT NULL GROUP BY {k}),
      folded AS (SELECT {k}, list_reduce(
          list_transform(string_split(txt, '###'),
            lambda p: {{'p': p, 'done': CAST([] AS VARCHAR[]), 'cur': ''}}),
          lambda s, e: CASE WHEN length(s.cur) + length(e.p) + 3 > {limit}
            THEN {{'p': '', 'done': list_append(s.done, s.cur), 'cur': e.p}}
            WHEN s.cur <> '' THEN {{'p': '', 'done': s.done, 'cur': s.cur || '###' || e.p}}
            ELSE {{'p': '', 'done': s.done, 'cur': e.p}} END, {state}) AS f FROM whole),
      listed AS (SELECT {k}, CASE WHEN f.cur <> '' THEN list_append(f.done, f.cur) ELSE f.done END AS l
        FROM folded)
    SELECT {k}, CAST(generate_subscripts(l, 1) AS BIGINT) AS seg_no, unnest(l) AS segment FROM listed)"""


def pack_words(relation: str, keys: Sequence[str], order: str, text: str, limit: int = 3000) -> str:
    """keys, seg_no, segment: jump from cut to cut over the numbered words of the joined text."""
    k = ", ".join(keys)
    on = " AND ".join(f"c.{x} = m.{x}" for x in keys)
    ck = ", ".join(f"c.{x}" for x in keys)
    return f"""(WITH RECURSIVE whole AS (SELECT {k}, {blank_tokens(
        f"string_agg({text}, ' ### ' ORDER BY {order})")} AS w
        FROM {relation} r WHERE {text} IS NOT NULL GROUP BY {k}),
      marks AS (SELECT {k}, pos FROM (SELECT {k}, unnest(w) AS word,
          generate_subscripts(w, 1) - 1 AS pos FROM whole) u WHERE word = '###'),
      cuts AS (SELECT {k}, CAST(1 AS BIGINT) AS seg_no, CAST(0 AS BIGINT) AS start FROM whole
        UNION ALL
        SELECT {ck}, c.seg_no + 1, min(m.pos) FROM cuts c JOIN marks m
          ON {on} AND m.pos >= c.start + {limit} GROUP BY {ck}, c.seg_no, c.start),
      spans AS (SELECT *, lead(start) OVER (PARTITION BY {k} ORDER BY seg_no) AS stop FROM cuts)
    SELECT {', '.join(f's.{x}' for x in keys)}, seg_no,
        array_to_string(w[start + 1 : coalesce(stop, len(w))], ' ') AS segment
    FROM spans s JOIN whole h USING ({k}) WHERE len(w) > 0)"""


def fill(template: str, **parts: str) -> str:
    """A template's literal pieces joined with SQL expressions."""
    pieces, rest = [], template
    while rest:
        before, _, tail = rest.partition("{")
        if before:
            escaped = before.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n")
            pieces.append(f"E'{escaped}'")
        name, _, rest = tail.partition("}")
        if name:
            pieces.append(f"CAST({parts[name]} AS VARCHAR)")
    return f"({' || '.join(pieces)})"


def company_summaries(relation: str, keys: Sequence[str], order: str, text: str = "summary",
                      first: Callable[[str], str] = richest_sentence,
                      final: Callable[[str], str] = richest_sentence) -> str:
    """keys, summary_result: short texts at once, long ones by segments."""
    k = ", ".join(keys)
    filled = f"(SELECT * REPLACE (nullif({text}, '') AS {text}) FROM {relation} q)"
    return f"""(WITH size AS (SELECT {k}, coalesce(string_agg({text}, '###' ORDER BY {order}), '') AS txt
        FROM {filled} r GROUP BY {k}),
      parts AS (SELECT {k}, string_agg({first('segment')}, ' ' ORDER BY seg_no) AS joined
        FROM {pack_chars(filled, keys, order, text)} p GROUP BY {k})
    SELECT {k}, CASE WHEN length(txt) > 3000 THEN {final('joined')}
        ELSE {first('txt')} END AS summary_result FROM size LEFT JOIN parts USING ({k}))"""


def sector_summaries(relation: str, keys: Sequence[str], order: str, text: str,
                     first: Callable[[str], str] = richest_sentence,
                     final: Callable[[str], str] = richest_sentence) -> str:
    """keys, sector_summary."""
    k = ", ".join(keys)
    parts = pack_words(relation, keys, order, text)
    joined = f"string_agg({first('segment')}, ' ' ORDER BY seg_no)"
    return (f"(SELECT {k}, {final('j')} AS sector_summary FROM "
            f"(SELECT {k}, {joined} AS j FROM {parts} p GROUP BY {k}) q)")


def picks(relation: str, keys: Sequence[str], text: str, longest: int, top_n: int) -> str:
    """keys, pick_no, keyword, rel: greedy choice of diverse candidates, step by step."""
    k = ", ".join(keys)
    grams = ("list_distinct(list_transform(range(1, greatest(length(keyword) - 2, 1) + 1), "
             "lambda i: substr(keyword, i, 3)))")
    pairs = "" if longest == 1 else f"""UNION ALL
      SELECT {', '.join(f'p.{x}' for x in keys)}, p.a || ' ' || p.b, CASE WHEN p.a = p.b THEN ta.tf / n.norm
          ELSE (ta.tf + tb.tf) / (n.norm * sqrt(CAST(2 AS DOUBLE))) END
      FROM (SELECT DISTINCT {k}, t[i] AS a, t[i + 1] AS b FROM
            (SELECT {k}, t, unnest(range(1, len(t))) AS i FROM terms) u) p
      JOIN tf ta ON {' AND '.join(f'p.{x} = ta.{x}' for x in keys)} AND p.a = ta.term
      JOIN tf tb ON {' AND '.join(f'p.{x} = tb.{x}' for x in keys)} AND p.b = tb.term
      JOIN norms n ON {' AND '.join(f'p.{x} = n.{x}' for x in keys)}"""
    shared = "len(list_intersect(grams, won))"
    return f"""(WITH RECURSIVE terms AS (SELECT {k}, {keyword_terms(f"coalesce({text}, '')")} AS t
        FROM {relation} r),
      tf AS (SELECT {k}, term, CAST(count(*) AS DOUBLE) AS tf FROM
        (SELECT {k}, unnest(t) AS term FROM terms) u GROUP BY {k}, term),
      norms AS (SELECT {k}, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY {k}),
      cand AS (SELECT {k}, term AS keyword, tf / norm AS rel FROM tf JOIN norms USING ({k}) {pairs}),
      steps AS (
        SELECT {k}, CAST(0 AS BIGINT) AS pick_no, keyword, rel, {grams} AS grams,
          CAST(0 AS DOUBLE) AS near, false AS is_pick FROM cand
        UNION ALL
        SELECT {k}, pick_no + 1, keyword, rel, grams,
          greatest(near, {shared} / (len(grams) + len(won) - {shared})), keyword = winner
        FROM (SELECT *, first_value(keyword) OVER best AS winner, first_value(grams) OVER best AS won
          FROM (SELECT *, CAST('0.30000000000000004' AS DOUBLE) * rel - CAST('0.7' AS DOUBLE) * near
              AS score FROM steps WHERE NOT is_pick AND pick_no < {top_n}) q
          WINDOW best AS (PARTITION BY {k} ORDER BY score DESC, rel DESC, keyword)) v)
    SELECT {k}, pick_no, keyword, rel FROM steps WHERE is_pick)"""


def keyword_rows(relation: str, keys: Sequence[str], text: str, longest: int, top_n: int,
                 condition: str, extra: Sequence[str] = ()) -> str:
    """keys, extra, kw_no, keywords, keywords_score: at most five kept picks, best first."""
    k = ", ".join(keys)
    e = "".join(f", {x}" for x in extra)
    return f"""(SELECT {k}{e}, row_number() OVER (PARTITION BY {k} ORDER BY rel DESC, keyword) AS kw_no,
        keyword AS keywords, round(rel, 4) AS keywords_score
      FROM {picks(relation, keys, text, longest, top_n)} p JOIN {relation} d USING ({k})
      WHERE {condition} QUALIFY kw_no <= 5)"""


def lexicon_polarity(text: str, positive: Sequence[str], negative: Sequence[str]) -> str:
    """Softmax of lexicon shares, positive minus negative."""
    tokens = f"list_transform({words(text)}, lambda w: lower(w))"
    up = f"len(list_filter({tokens}, lambda w: w IN ({quoted(positive)})))"
    down = f"len(list_filter({tokens}, lambda w: w IN ({quoted(negative)})))"
    n = f"len({tokens})"
    a, b = (f"exp({x} * CAST(10 AS DOUBLE) / {n})" for x in (up, down))
    return (f"CASE WHEN {text} IS NULL THEN NULL WHEN {n} = 0 THEN CAST(0 AS DOUBLE) "
            f"ELSE round(({a} - {b}) / ({a} + {b} + exp(CAST(1 AS DOUBLE))), 3) END")


def tfidf(docs: str = "(SELECT doc_id AS id, text FROM documents)") -> str:
    """CTEs terms and postings of a corpus with columns id and text."""
    return f"""tokens AS (SELECT id, unnest({index_terms('text')}) AS term FROM {docs} d),
      tf AS (SELECT id, term, count(*) AS tf FROM tokens GROUP BY id, term),
      terms AS (SELECT term, count(*) AS df,
        ln((1 + (SELECT count(*) FROM {docs} c)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
        FROM tf GROUP BY term),
      raw AS (SELECT id, term, tf, tf * idf AS r FROM tf JOIN terms USING (term)),
      postings AS (SELECT id, term, tf, r / sqrt(sum(r * r) OVER (PARTITION BY id)) AS weight FROM raw)"""


def tfidf_scores() -> str:
    """CTE scores (query_id, id, score) of the benchmark's questions, after :func:`tfidf`."""
    return f"""qtf AS (SELECT query_id, term, count(*) AS tf FROM
        (SELECT item_id AS query_id, unnest({index_terms('text')}) AS term FROM benchmark) u
        GROUP BY query_id, term),
      qraw AS (SELECT query_id, term, qtf.tf * idf AS r FROM qtf JOIN terms USING (term)),
      q AS (SELECT query_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY query_id)) AS w FROM qraw),
      scores AS (SELECT query_id, id, round(sum(w * weight), 6) AS score
        FROM q JOIN postings USING (term) GROUP BY query_id, id),
      top AS (SELECT query_id, id, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id DESC) AS rank
        FROM scores QUALIFY rank <= 10)"""
