"""DuckDB SQL that states each query independently of the Spark code.

Only the driver tables are registered in DuckDB, so every oracle starts with the adapter CTEs
(the same rows ``murmur.sources.adapter`` builds). Flat names in the CTE ``items``:
sentiment_type, positive, negative, neutral, mixed, content_type, confidence, p_informative,
p_emotional, post_date.
"""

from __future__ import annotations

ADAPTER = r"""
posts AS (
  SELECT 'post' AS type, concat('p', cast(d.doc_id AS varchar)) AS id, cast(NULL AS varchar) AS post_id,
    replace(d.text, chr(10), ' ') AS title, d.text AS selftext, cast(NULL AS varchar) AS body,
    CASE WHEN d.doc_id % 2 = 0 THEN concat('https://example.com/', d.source, '/', cast(d.doc_id AS varchar))
         ELSE concat('/r/', d.source, '/', cast(d.doc_id AS varchar)) END AS url,
    d.source AS subreddit, epoch_us(e.ts) AS created_us, cast(epoch_us(e.ts) AS double) / 1000000 AS created_utc,
    cast(floor(e.value) AS bigint) AS score,
    CASE WHEN l.toxic = 1 THEN 'NEGATIVE' WHEN l.quality = 1 THEN 'POSITIVE' WHEN l.quality = 0 THEN 'NEUTRAL' END AS sentiment_type,
    cast(d.doc_id % 101 AS double) / 100 AS positive, cast((d.doc_id * 7) % 101 AS double) / 100 AS negative,
    CASE WHEN d.doc_id % 10 = 0 THEN 'UNKNOWN' WHEN d.doc_id % 10 = 1 THEN 'DISABLED'
         WHEN d.n_chars >= 1500 THEN 'INFORMATIVE' ELSE 'EMOTIONAL' END AS content_type,
    cast(50 + d.doc_id % 50 AS double) / 100 AS confidence
  FROM documents d JOIN events e ON e.event_id = d.doc_id * 5 LEFT JOIN labels l ON l.doc_id = d.doc_id),
comments AS (
  SELECT 'comment' AS type, concat('c', cast(v.conv_id AS varchar), '_', cast(v.turn AS varchar)) AS id, p.id AS post_id,
    cast(NULL AS varchar) AS title, cast(NULL AS varchar) AS selftext, v.text AS body,
    concat(p.url, '/', cast(v.turn AS varchar)) AS url, p.subreddit,
    p.created_us + 60000000 * (v.turn + 1) AS created_us,
    cast(p.created_us + 60000000 * (v.turn + 1) AS double) / 1000000 AS created_utc,
    cast(length(v.text) % 40 AS bigint) AS score,
    CASE v.role WHEN 'user' THEN 'NEGATIVE' WHEN 'assistant' THEN 'POSITIVE' ELSE 'MIXED' END AS sentiment_type,
    cast(length(v.text) % 101 AS double) / 100 AS positive, cast((length(v.text) * 7) % 101 AS double) / 100 AS negative,
    CASE WHEN v.role = 'system' THEN 'DISABLED' WHEN length(v.text) >= 400 THEN 'INFORMATIVE' ELSE 'EMOTIONAL' END AS content_type,
    cast(50 + v.turn * 5 AS double) / 100 AS confidence
  FROM conversations v JOIN posts p ON p.id = concat('p', cast(v.conv_id AS varchar))),
items AS (
  SELECT *, greatest(0.0, 1.0 - positive - negative) AS neutral, cast(0.0 AS double) AS mixed,
    CASE content_type WHEN 'INFORMATIVE' THEN confidence WHEN 'EMOTIONAL' THEN 1.0 - confidence END AS p_informative,
    CASE content_type WHEN 'INFORMATIVE' THEN 1.0 - confidence WHEN 'EMOTIONAL' THEN confidence END AS p_emotional,
    cast(make_timestamp(created_us) AS date) AS post_date
  FROM (SELECT * FROM posts UNION ALL SELECT * FROM comments))
"""

# Python's whitespace set as one class (same text as murmur.params.PY_WHITESPACE_CLASS).
WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def with_items(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([ADAPTER.strip(), *[c.strip() for c in extra_ctes]])
    return f"WITH {ctes}\n{body.strip()}"


def r6(expr: str, places: int = 6) -> str:
    """Two-step HALF_UP rounding, the same as ``aggregations.r6``."""
    return f"cast(round(cast(round({expr}, 9) AS decimal(38,9)), {places}) AS double)"


def py_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def py_collapse(expr: str) -> str:
    return py_strip(f"regexp_replace({expr}, '{WS}+', ' ', 'g')")


def clean_text(expr: str, n: int = 1000) -> str:
    c = py_collapse(expr)
    return f"(CASE WHEN length({c}) > {n} THEN concat(substr({c}, 1, {n}), '...') ELSE {c} END)"


def contains_any(expr: str, words) -> str:
    ws = [w for w in words if w]
    if not ws:
        return "false"
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in ws) + ")"


def lit_list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def count_in(tokens_expr: str, words) -> str:
    return f"cast(len(list_filter({tokens_expr}, lambda x: x IN ({lit_list(words)}))) AS bigint)"


def tokens(expr: str) -> str:
    return f"regexp_split_to_array(lower({expr}), '[^a-z]+')"


def scored_cte(name: str, source: str, text_sql: str, where: str = "TRUE", lexicon=None, cues=None) -> str:
    """CTE adding the lexicon sentiment (s_*) and cue-word content type (pi, c_*) of ``text_sql``;
    unscorable (null / blank) text gets null sentiment and the UNKNOWN fallback."""
    from murmur.plans import fixtures as X
    lexicon = lexicon or X.LEXICON
    inf, emo = cues or X.CUES
    ok = f"(txt IS NOT NULL AND trim(txt) <> '')"
    return f"""{name} AS (
  SELECT *,
    CASE WHEN txt IS NOT NULL THEN CASE WHEN pp = best THEN 'POSITIVE' WHEN nn = best THEN 'NEGATIVE' WHEN mx = best THEN 'MIXED' ELSE 'NEUTRAL' END END AS s_label,
    CASE WHEN {ok} THEN CASE WHEN pi >= 1.0 - pi THEN 'INFORMATIVE' ELSE 'EMOTIONAL' END ELSE 'UNKNOWN' END AS c_label,
    CASE WHEN {ok} THEN greatest(pi, 1.0 - pi) ELSE 0.0 END AS c_conf,
    {ok} AS scorable
  FROM (SELECT *, greatest(pp, nn, mx, nu) AS best FROM (
    SELECT *, cast(p - least(p, n) AS double) / (p + n + 1) AS pp, cast(n - least(p, n) AS double) / (p + n + 1) AS nn,
      cast(2 * least(p, n) AS double) / (p + n + 1) AS mx, 1.0 / (p + n + 1) AS nu,
      (cast(ci AS double) + 0.5) / cast(ci + ce + 1 AS double) AS pi
    FROM (SELECT *, {count_in('tk', lexicon.positive)} AS p, {count_in('tk', lexicon.negative)} AS n,
                 {count_in('tk', inf)} AS ci, {count_in('tk', emo)} AS ce
          FROM (SELECT *, {text_sql} AS txt, {tokens(text_sql)} AS tk FROM {source} WHERE {where})))))"""
