"""Registered queries for predicates, projections, rollups, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.functions.text import py_strip
from murmur.operators import aggregations as A
from murmur.operators import filters as flt
from murmur.operators import joins as J
from murmur.operators import labeling as L
from murmur.operators import projections as PR
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import (clean_text, contains_any, count_in, lit_list, py_strip as sql_strip, r6,
                                     tokens, with_items)
from murmur.sources import adapter
from murmur.sources.tables import table

ING = X.INGEST
SRCH = X.SEARCH
LEX = X.LEXICON


def items(spark, sf):
    return adapter.items(spark, sf)


def posts(spark, sf):
    return adapter.items(spark, sf).filter(F.col("type") == "post")


def comments(spark, sf):
    return adapter.items(spark, sf).filter(F.col("type") == "comment")


def enriched(spark, sf):
    return adapter.enriched(spark, sf)


POST_TEXT_SQL = "lower(concat(coalesce(title, ''), ' ', coalesce(selftext, '')))"

# ---------------------------------------------------------------- 2.2 predicates


@query("flt_hwm", with_items(f"SELECT id, created_utc FROM items WHERE type = 'post' AND created_utc >= {ING.mark}"))
def q_flt_hwm(spark, sf):
    return flt.flt_hwm(posts(spark, sf), ING.mark).select("id", "created_utc")


@query("flt_keyword_any", with_items(
    f"SELECT id FROM items WHERE type = 'post' AND {contains_any(POST_TEXT_SQL, ING.keywords)}"))
def q_flt_keyword_any(spark, sf):
    return flt.flt_keyword_any(posts(spark, sf), ING.keywords).select("id")


def letters_sql(number: str, n: int) -> str:
    """``n`` capital letters that spell a number."""
    return " || ".join(f"chr(cast(65 + ({number} // {26 ** k}) % 26 AS integer))" for k in range(n))


def letters(number, n: int):
    return F.concat(*[F.char(65 + F.floor(number / 26 ** k) % 26) for k in range(n)])


#: A word for each order: thousands at the smallest scales, in the list of five letters.
WORD_NUMBER = "(o_orderkey * 104729 + o_custkey * 31) % 11881376"


@query("flt_keyword_table", with_items(
    f"SELECT DISTINCT id FROM (SELECT id, {POST_TEXT_SQL} AS t FROM items WHERE type = 'post') "
    f"JOIN (SELECT DISTINCT lower({letters_sql(WORD_NUMBER, 5)}) AS word FROM orders) ON contains(t, word)"))
def q_flt_keyword_table(spark, sf):
    """Posts that hold any word of a table."""
    words = table(spark, sf, "orders").select(letters(F.expr(WORD_NUMBER), 5).alias("word"))
    return flt.flt_keyword_table(posts(spark, sf), words).select("id")


@query("flt_ignore_any", with_items(
    f"SELECT id FROM items WHERE type = 'post' AND NOT {contains_any(POST_TEXT_SQL, ING.ignore_keywords)}"))
def q_flt_ignore_any(spark, sf):
    return flt.flt_ignore_any(posts(spark, sf), ING.ignore_keywords).select("id")


@query("flt_post_score", with_items("SELECT id, score FROM items WHERE type = 'post' AND score >= 10"))
def q_flt_post_score(spark, sf):
    return flt.flt_post_score(posts(spark, sf), P.INGEST_MIN_POST_SCORE).select("id", "score")


@query("flt_post_length", with_items(
    "SELECT id, cast(length(selftext) AS bigint) AS n_chars FROM items WHERE type = 'post' AND length(selftext) >= 200"))
def q_flt_post_length(spark, sf):
    return (flt.flt_post_length(posts(spark, sf), P.INGEST_MIN_POST_LENGTH)
            .select("id", F.length("selftext").cast("bigint").alias("n_chars")))


@query("flt_comment_quality", with_items(
    "SELECT id, post_id FROM items WHERE type = 'comment' AND score >= 5 AND length(body) >= 50"))
def q_flt_comment_quality(spark, sf):
    return flt.flt_comment_quality(comments(spark, sf)).select("id", "post_id")


RELEVANT_SQL = (f"(length(concat(coalesce(title, ''), coalesce(selftext, ''))) >= {P.RELEVANCE_MIN_CHARS} AND "
                + contains_any("lower(concat(coalesce(title, ''), ' ', coalesce(selftext, '')))", ING.relevance_terms) + ")")


@query("flt_relevance", with_items(f"SELECT id FROM items WHERE type = 'post' AND {RELEVANT_SQL}"))
def q_flt_relevance(spark, sf):
    return flt.flt_relevance(posts(spark, sf), True, ING.relevance_terms).select("id")


@query("flt_required_fields", with_items(
    "SELECT id, type FROM items WHERE type IS NOT NULL AND id IS NOT NULL AND subreddit IS NOT NULL "
    "AND created_utc IS NOT NULL AND score IS NOT NULL AND score % 5 <> 0"))
def q_flt_required_fields(spark, sf):
    """Every fifth score has lost its community."""
    lost = items(spark, sf).withColumn("subreddit", F.when(F.col("score") % 5 != 0, F.col("subreddit")))
    return flt.flt_required_fields(lost).select("id", "type")


@query("flt_nonempty_text", with_items(
    "SELECT id, type FROM items WHERE coalesce(CASE WHEN type = 'post' THEN title WHEN type = 'comment' THEN body END, '') <> '' AND score % 4 <> 0"))
def q_flt_nonempty_text(spark, sf):
    """Every fourth score comes without its text."""
    d = items(spark, sf).withColumn("text", F.when(F.col("score") % 4 == 0, F.lit("")).otherwise(PR.pipeline_text()))
    return flt.flt_nonempty_text(d, "text").select("id", "type")


@query("flt_ticker", with_items(
    f"SELECT id, type FROM items WHERE contains(upper(title), '{SRCH.ticker}') OR contains(upper(selftext), '{SRCH.ticker}')"))
def q_flt_ticker(spark, sf):
    return flt.flt_ticker(items(spark, sf), SRCH.ticker).select("id", "type")


COMPANY_TICKER, COMPANY_ALIASES = X.COMPANY
ALIAS_SQL = "(" + " OR ".join(f"contains(upper({c}), '{a}')" for a in COMPANY_ALIASES for c in ("title", "body")) + ")"


@query("flt_company_alias", with_items(f"SELECT id, type FROM items WHERE coalesce({ALIAS_SQL}, false)"))
def q_flt_company_alias(spark, sf):
    return flt.flt_company_alias(items(spark, sf), COMPANY_ALIASES).select("id", "type")


@query("flt_item_type", with_items("SELECT id, post_id FROM items WHERE type = 'comment'"))
def q_flt_item_type(spark, sf):
    return flt.flt_item_type(items(spark, sf), "comments").select("id", "post_id")


TF_HOURS = P.TIMEFRAME_HOURS[SRCH.timeframe]


@query("flt_timeframe", with_items(
    f"SELECT id, type FROM items WHERE created_utc >= {SRCH.as_of} - {TF_HOURS} * 3600"))
def q_flt_timeframe(spark, sf):
    return flt.flt_timeframe(items(spark, sf), TF_HOURS, SRCH.as_of).select("id", "type")


@query("flt_classified", with_items(
    "SELECT id, sentiment_type, content_type FROM items WHERE sentiment_type IS NOT NULL "
    "AND content_type IS NOT NULL AND content_type <> 'DISABLED'"))
def q_flt_classified(spark, sf):
    return flt.flt_classified(enriched(spark, sf)).select(
        "id", F.col("sentiment.Sentiment").alias("sentiment_type"),
        F.col("content_type.Classification").alias("content_type"))


@query("flt_confident", with_items(
    "SELECT id, content_type, confidence FROM items WHERE content_type IN ('INFORMATIVE', 'EMOTIONAL') AND confidence >= 0.7"))
def q_flt_confident(spark, sf):
    return flt.flt_confident(enriched(spark, sf)).select(
        "id", F.col("content_type.Classification").alias("content_type"),
        F.col("content_type.Confidence").alias("confidence"))


EXTRACT_WHERE = ("score >= 10 AND ((type = 'post' AND length(title) >= 100) OR (type = 'comment' AND length(body) >= 100)) "
                 "AND sentiment_type IS NOT NULL")


@query("flt_extraction", with_items(f"SELECT id, type, score FROM items WHERE {EXTRACT_WHERE}"))
def q_flt_extraction(spark, sf):
    return flt.flt_extraction(enriched(spark, sf)).select("id", "type", "score")


TRAIN_TEXT_SQL = "(CASE WHEN type = 'post' THEN coalesce(title, '') ELSE coalesce(body, '') END)"


LABELABLE_N = 400  # more than the extraction's 100 characters


@query("flt_labelable", with_items(
    f"SELECT id, cast(length({sql_strip(TRAIN_TEXT_SQL)}) AS bigint) AS n_chars FROM items "
    f"WHERE {EXTRACT_WHERE} AND length({sql_strip(TRAIN_TEXT_SQL)}) >= {LABELABLE_N}"))
def q_flt_labelable(spark, sf):
    d = L.extraction(enriched(spark, sf))
    return flt.flt_labelable(d, "text", LABELABLE_N).select("id", F.length(py_strip("text")).cast("bigint").alias("n_chars"))


TRAINING_ROWS_SQL = f"""training AS (
  SELECT id, {clean_text(TRAIN_TEXT_SQL)} AS text, subreddit, type, score, created_utc,
    coalesce(nullif(sentiment_type, ''), 'UNKNOWN') AS existing_sentiment,
    '' AS informative_emotional_label, '' AS labeler, '' AS labeling_notes
  FROM items WHERE {EXTRACT_WHERE} AND length({sql_strip(TRAIN_TEXT_SQL)}) >= 50)"""
LABELED_SQL = """labeled AS (
  SELECT t.* EXCLUDE (informative_emotional_label),
    coalesce(CASE WHEN l.quality = 1 THEN 'informative' WHEN l.quality = 0 THEN 'emotional' END, '') AS informative_emotional_label
  FROM training t LEFT JOIN labels l ON t.id = concat('p', cast(l.doc_id AS varchar)))"""


def labeled(spark, sf):
    return L.labeled_table(L.training_rows(enriched(spark, sf)), L.labels_for(spark, sf))


@query("flt_labeled", with_items(
    "SELECT id, informative_emotional_label FROM labeled WHERE informative_emotional_label IN ('informative', 'emotional')",
    TRAINING_ROWS_SQL, LABELED_SQL))
def q_flt_labeled(spark, sf):
    return flt.flt_labeled(labeled(spark, sf)).select("id", "informative_emotional_label")


@query("flt_unlabeled", with_items(
    "SELECT id FROM labeled WHERE coalesce(informative_emotional_label, '') = ''", TRAINING_ROWS_SQL, LABELED_SQL))
def q_flt_unlabeled(spark, sf):
    return flt.flt_unlabeled(labeled(spark, sf)).select("id")


FIRST_WORD_SQL = "split_part(title, ' ', 1)"


def full_upper(expr: str) -> str:
    """Upper case with full case mapping where it changes a letter test: Python and Java map 'ß'
    to 'SS', DuckDB's upper maps it to the capital sharp s."""
    return f"upper(replace({expr}, 'ß', 'ss'))"


@query("flt_ticker_format", with_items(
    f"SELECT id, {FIRST_WORD_SQL} AS requested, "
    f"coalesce(regexp_full_match({full_upper(sql_strip(FIRST_WORD_SQL))}, '[A-Z]{{1,5}}'), false) AS search_valid "
    f"FROM items WHERE type = 'post' AND ({FIRST_WORD_SQL} = '' OR {FIRST_WORD_SQL} = 'ALL' OR "
    f"(length({FIRST_WORD_SQL}) <= 10 AND regexp_full_match({full_upper(FIRST_WORD_SQL)}, '[A-Z]{{1,10}}')))"))
def q_flt_ticker_format(spark, sf):
    """Treat each post title's first word as a requested symbol; keep the ones the dashboard
    accepts and flag the ones the search accepts."""
    d = posts(spark, sf).select("id", F.split("title", " ", 2)[0].alias("requested"))
    return d.filter(flt.api_ticker_ok("requested")).select(
        "id", "requested", flt.search_ticker_ok("requested").alias("search_valid"))


# ---------------------------------------------------------------- 2.3 projections


@query("prj_sanitize", with_items(
    "SELECT id, substr(title, 1, 500) AS title, substr(selftext, 1, 10000) AS selftext, substr(body, 1, 5000) AS body FROM items"))
def q_prj_sanitize(spark, sf):
    return PR.prj_sanitize(items(spark, sf)).select("id", "title", "selftext", "body")


HASH_SQL = ("md5(CASE WHEN type = 'post' THEN concat(coalesce(title, ''), coalesce(selftext, '')) "
            "ELSE coalesce(body, '') END)")


@query("prj_content_hash", with_items(f"SELECT id, {HASH_SQL} AS content_hash FROM items"))
def q_prj_content_hash(spark, sf):
    return PR.prj_content_hash(items(spark, sf)).select("id", "content_hash")


PIPE_TEXT_SQL = "(CASE WHEN type = 'post' THEN title WHEN type = 'comment' THEN body END)"


@query("prj_text_pipeline", with_items(f"SELECT id, {PIPE_TEXT_SQL} AS text FROM items"))
def q_prj_text_pipeline(spark, sf):
    return items(spark, sf).select("id", PR.pipeline_text().alias("text"))


SEARCH_TEXT_SQL = ("(CASE WHEN type = 'post' THEN concat(coalesce(title, ''), ' ', coalesce(selftext, '')) "
                   "WHEN type = 'comment' THEN coalesce(body, '') ELSE '' END)")


@query("prj_text_search", with_items(f"SELECT id, {SEARCH_TEXT_SQL} AS text FROM items"))
def q_prj_text_search(spark, sf):
    return items(spark, sf).select("id", PR.search_text().alias("text"))


@query("prj_display_text", with_items(f"SELECT id, {PIPE_TEXT_SQL} AS display_text FROM items"))
def q_prj_display_text(spark, sf):
    return items(spark, sf).select("id", PR.display_text().alias("display_text"))


@query("prj_post_date", with_items("SELECT id, post_date FROM items"))
def q_prj_post_date(spark, sf):
    return items(spark, sf).select("id", PR.post_date().alias("post_date"))


@query("prj_flatten", with_items(
    "SELECT type, id, subreddit, created_utc, score, sentiment_type, "
    "CASE WHEN sentiment_type IS NOT NULL THEN positive END AS sentiment_positive, "
    "CASE WHEN sentiment_type IS NOT NULL THEN negative END AS sentiment_negative, "
    "CASE WHEN sentiment_type IS NOT NULL THEN neutral END AS sentiment_neutral, "
    "CASE WHEN sentiment_type IS NOT NULL THEN mixed END AS sentiment_mixed, "
    "content_type, confidence AS content_confidence, p_informative AS prob_informative, p_emotional AS prob_emotional "
    "FROM items"))
def q_prj_flatten(spark, sf):
    return PR.prj_flatten(enriched(spark, sf))


COMBINED_SQL = ("CASE WHEN sentiment_type IN ('POSITIVE', 'NEGATIVE', 'NEUTRAL') AND content_type IN ('INFORMATIVE', 'EMOTIONAL') "
                "THEN concat(sentiment_type, '_', content_type) ELSE 'MIXED_OTHER' END")


@query("prj_combined_class", with_items(f"SELECT id, {COMBINED_SQL} AS combined_classification FROM items"))
def q_prj_combined_class(spark, sf):
    return enriched(spark, sf).select("id", PR.combined_class(
        F.col("sentiment.Sentiment"), F.col("content_type.Classification")).alias("combined_classification"))


@query("prj_combined_display", with_items(
    "SELECT id, CASE WHEN coalesce(nullif(content_type, ''), 'N/A') IN ('N/A', 'UNKNOWN', 'DISABLED') "
    "THEN coalesce(nullif(sentiment_type, ''), 'UNKNOWN') "
    "ELSE concat(coalesce(nullif(sentiment_type, ''), 'UNKNOWN'), '_', content_type) END AS combined FROM items"))
def q_prj_combined_display(spark, sf):
    return enriched(spark, sf).select("id", PR.combined_display(
        F.col("sentiment.Sentiment"), F.col("content_type.Classification")).alias("combined"))


TRUNC_SRC = f"coalesce(nullif({PIPE_TEXT_SQL}, ''), nullif(title, ''), 'No content')"


@query("prj_truncate_display", with_items(
    f"SELECT id, CASE WHEN length({TRUNC_SRC}) > 100 THEN concat(substr({TRUNC_SRC}, 1, 100), '...') ELSE {TRUNC_SRC} END AS display FROM items"))
def q_prj_truncate_display(spark, sf):
    return items(spark, sf).select("id", PR.truncate_display(PR.display_text(), F.col("title")).alias("display"))


@query("prj_absolute_url", with_items(
    f"SELECT id, CASE WHEN url IS NULL OR url = '' OR starts_with(url, 'http') THEN url ELSE concat('{P.SITE_HOST}', url) END AS url FROM items"))
def q_prj_absolute_url(spark, sf):
    return items(spark, sf).select("id", PR.absolute_url(F.col("url")).alias("url"))


AGE_DIFF = f"({SRCH.as_of} - created_utc)"


@query("prj_relative_age", with_items(
    f"SELECT id, CASE WHEN floor(floor({AGE_DIFF} / 3600) / 24) > 0 THEN concat(cast(cast(floor(floor({AGE_DIFF} / 3600) / 24) AS bigint) AS varchar), 'd ago') "
    f"WHEN floor({AGE_DIFF} / 3600) > 0 THEN concat(cast(cast(floor({AGE_DIFF} / 3600) AS bigint) AS varchar), 'h ago') "
    f"ELSE concat(cast(cast(floor({AGE_DIFF} / 60) AS bigint) AS varchar), 'm ago') END AS age FROM items"))
def q_prj_relative_age(spark, sf):
    return items(spark, sf).select("id", PR.relative_age(F.col("created_utc"), SRCH.as_of).alias("age"))


@query("prj_clean_text", with_items(f"SELECT id, {clean_text('coalesce(selftext, body)')} AS text FROM items"))
def q_prj_clean_text(spark, sf):
    """The cleaning rule on every whole post / comment text."""
    return items(spark, sf).select("id", PR.clean_text(F.coalesce("selftext", "body")).alias("text"))


@query("prj_training_row", with_items("SELECT * FROM training", TRAINING_ROWS_SQL))
def q_prj_training_row(spark, sf):
    return L.training_rows(enriched(spark, sf))


CT_TOK = tokens(PIPE_TEXT_SQL)
CT_I = count_in("tk", X.INFORMATIVE_CUES)
CT_E = count_in("tk", X.EMOTIONAL_CUES)
CT_PRED_CTE = f"""pred AS (
  SELECT id, {PIPE_TEXT_SQL} AS text, (cast({CT_I} AS double) + 0.5) / cast({CT_I} + {CT_E} + 1 AS double) AS pi
  FROM (SELECT *, {CT_TOK} AS tk FROM items))"""


@query("prj_class_result", with_items(
    "SELECT id, CASE WHEN pi >= 1.0 - pi THEN 'INFORMATIVE' ELSE 'EMOTIONAL' END AS classification, "
    "greatest(pi, 1.0 - pi) AS confidence, pi AS p_informative, 1.0 - pi AS p_emotional FROM pred WHERE text IS NOT NULL",
    CT_PRED_CTE))
def q_prj_class_result(spark, sf):
    d = items(spark, sf).withColumn("text", PR.pipeline_text()).filter(F.col("text").isNotNull())
    d = S.score_columns(d, F.col("text"), prediction_out="_pred", cues=X.CUES)
    r = S.class_result(F.col("_pred"))
    return d.select("id", r["Classification"].alias("classification"), r["Confidence"].alias("confidence"),
                    r["Probabilities"]["Informative"].alias("p_informative"),
                    r["Probabilities"]["Emotional"].alias("p_emotional"))


@query("prj_class_fallback", with_items(
    "SELECT id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'UNKNOWN' WHEN pi >= 1.0 - pi THEN 'INFORMATIVE' ELSE 'EMOTIONAL' END AS classification, "
    "CASE WHEN text IS NULL OR trim(text) = '' THEN 0.0 ELSE greatest(pi, 1.0 - pi) END AS confidence, "
    "CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty text' END AS error FROM pred", CT_PRED_CTE))
def q_prj_class_fallback(spark, sf):
    d = S.score_columns(items(spark, sf).withColumn("_t", PR.pipeline_text()), F.col("_t"), content_out="ct", cues=X.CUES)
    return d.select("id", F.col("ct.Classification").alias("classification"),
                    F.col("ct.Confidence").alias("confidence"), F.col("ct.Error").alias("error"))


TF_CHOICES = list(P.TIMEFRAME_HOURS) + ["90d"]


def timeframe_requests(spark, sf):
    """Search requests re-aimed onto ``events``: each event asks for one timeframe (one of the
    seven known plus an unknown one), chosen by user."""
    from murmur.sources.tables import table
    e = table(spark, sf, "events").select("event_id", "user_id")
    return e.withColumn("timeframe", F.element_at(F.array(*[F.lit(t) for t in TF_CHOICES]),
                                                  (F.pmod(F.col("user_id"), F.lit(len(TF_CHOICES))) + 1).cast("int")))


TF_CASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in P.TIMEFRAME_HOURS.items())


@query("prj_timeframe_hours",
       f"SELECT event_id, tf AS timeframe, CASE tf {TF_CASE} ELSE 24 END AS hours FROM ("
       f"SELECT event_id, ([{lit_list(TF_CHOICES)}])[(user_id % {len(TF_CHOICES)}) + 1] AS tf FROM events)")
def q_prj_timeframe_hours(spark, sf):
    r = timeframe_requests(spark, sf)
    return r.select("event_id", "timeframe", PR.timeframe_hours(F.col("timeframe")).alias("hours"))


@query("prj_label_index", with_items(
    "SELECT id, CASE informative_emotional_label WHEN 'informative' THEN 0 WHEN 'emotional' THEN 1 END AS label_index, "
    "informative_emotional_label AS label_back FROM labeled WHERE informative_emotional_label IN ('informative', 'emotional')",
    TRAINING_ROWS_SQL, LABELED_SQL))
def q_prj_label_index(spark, sf):
    d = flt.flt_labeled(labeled(spark, sf)).withColumn("label_index", PR.label_index(F.col(flt.LABEL_COL)))
    return d.select("id", "label_index", PR.index_label(F.col("label_index")).alias("label_back"))


@query("prj_split_list", with_items(
    f"SELECT id, cast(generate_subscripts(arr, 1) - 1 AS integer) AS item_pos, unnest(arr) AS item FROM ("
    f"SELECT id, list_filter(list_transform(string_split(title, ','), lambda x: {sql_strip('x')}), lambda x: x <> '') AS arr "
    f"FROM items WHERE type = 'post')"))
def q_prj_split_list(spark, sf):
    """Post titles read as comma lists (the ticker-list rule)."""
    return PR.prj_split_list(posts(spark, sf).select("id", "title"), "title").select("id", "item_pos", "item")


# ---------------------------------------------------------------- 2.4 joins (relational part)


@query("join_ticker_mentions_word", with_items(
    f"SELECT DISTINCT id, ticker FROM (SELECT id, unnest(regexp_split_to_array({full_upper("concat(coalesce(title, ''), ' ', coalesce(selftext, ''))")}, "
    f"'[^A-Z0-9.]+')) AS ticker FROM items) WHERE ticker IN ({lit_list(X.TICKERS)})"))
def q_join_ticker_mentions_word(spark, sf):
    """Whole-word mentions: an equi-join on the token, whose strategy Spark chooses by size."""
    return J.join_ticker_mentions(items(spark, sf), X.TICKERS, match="word").select("id", "ticker")


@query("set_ticker_list", with_items(
    "SELECT * FROM (SELECT subreddit, trim(unnest(string_split(words, ','))) AS ticker, 'configured' AS source FROM (SELECT subreddit, "
    "min(split_part(title, ' ', 1)) AS words FROM items WHERE type = 'post' GROUP BY 1)) WHERE ticker <> '' UNION ALL SELECT subreddit, unnest([" + lit_list(P.FALLBACK_TICKERS) + f"]), '{P.FALLBACK_SOURCE}' "
    "FROM (SELECT DISTINCT subreddit FROM items WHERE type = 'comment')"))
def q_set_ticker_list(spark, sf):
    """A configured list per community (a word of its posts), and the tagged fallback list for the
    communities seen in comments, which configure none."""
    it = items(spark, sf)
    own = it.filter("type = 'post'").groupBy("subreddit").agg(F.min(F.split("title", " ")[0]).alias("keywords"))
    none = it.filter("type = 'comment'").select("subreddit").distinct().select("subreddit", F.lit(None).cast("string").alias("keywords"))
    return J.ticker_lists(own.unionByName(none)).select("subreddit", "ticker", "source")


@query("join_ticker_mentions", with_items(
    f"SELECT i.id, t.ticker FROM items i JOIN (SELECT unnest([{lit_list(X.TICKERS)}]) AS ticker) t "
    f"ON contains(upper(i.title), t.ticker) OR contains(upper(i.selftext), t.ticker)"))
def q_join_ticker_mentions(spark, sf):
    return J.join_ticker_mentions(items(spark, sf), X.TICKERS).select("id", "ticker")


#: A symbol for each customer, of three or four letters: thousands at the smallest scales.
SYMBOL_NUMBER = "c_custkey * 7919 % 456976"
SYMBOLS_CTE = f"symbols AS MATERIALIZED (SELECT DISTINCT CASE WHEN c_nationkey < 12 THEN {letters_sql(SYMBOL_NUMBER, 3)} ELSE {letters_sql(SYMBOL_NUMBER, 4)} END AS ticker FROM customer)"
UPPER_CTE = "uppers AS MATERIALIZED (SELECT id, post_date, sentiment_type, upper(replace(coalesce(title, ''), 'ß', 'ss')) AS a, upper(replace(coalesce(selftext, ''), 'ß', 'ss')) AS b FROM items)"
MENTIONS_SQL = "uppers i JOIN symbols t ON contains(i.a, t.ticker) OR contains(i.b, t.ticker)"


def symbols(spark, sf):
    number = F.expr(SYMBOL_NUMBER)
    return table(spark, sf, "customer").select(F.when(F.col("c_nationkey") < 12, letters(number, 3)).otherwise(letters(number, 4)).alias("ticker"))


@query("join_ticker_table", with_items(f"SELECT i.id, t.ticker FROM {MENTIONS_SQL}", SYMBOLS_CTE, UPPER_CTE))
def q_join_ticker_table(spark, sf):
    """Mentions of the symbols of a table."""
    return J.join_ticker_table(items(spark, sf), symbols(spark, sf))


@query("agg_mentions_trend_table", with_items(
    f"SELECT t.ticker, i.post_date, i.sentiment_type, count(*) AS post_count FROM {MENTIONS_SQL} GROUP BY 1, 2, 3", SYMBOLS_CTE, UPPER_CTE))
def q_agg_mentions_trend_table(spark, sf):
    return J.agg_mentions_trend(enriched(spark, sf), symbols(spark, sf))


# ---------------------------------------------------------------- 2.5 rollups

DUAL_SQL = with_items(
    f"SELECT subreddit, post_date, sentiment_type, content_type, count(*) AS post_count, "
    f"{r6('avg(positive)')} AS avg_positive_score, {r6('avg(negative)')} AS avg_negative_score, "
    f"{r6('avg(neutral)')} AS avg_neutral_score, {r6('avg(confidence)')} AS avg_content_type_confidence "
    f"FROM items WHERE sentiment_type IS NOT NULL AND content_type IS NOT NULL AND content_type <> 'DISABLED' "
    f"AND content_type <> 'UNKNOWN' GROUP BY subreddit, post_date, sentiment_type, content_type")


@query("agg_dual_class", DUAL_SQL)
def q_agg_dual_class(spark, sf):
    return A.agg_dual_class(enriched(spark, sf))


@query("agg_trend", with_items(
    f"SELECT post_date, sentiment_type, count(*) AS post_count FROM items "
    f"WHERE contains(upper(title), '{SRCH.ticker}') OR contains(upper(selftext), '{SRCH.ticker}') GROUP BY 1, 2"))
def q_agg_trend(spark, sf):
    return A.agg_trend(enriched(spark, sf), SRCH.ticker, "all")


@query("agg_sentiment_by_community", with_items(
    "SELECT subreddit, post_date, sentiment_type, count(*) AS post_count FROM items GROUP BY 1, 2, 3"))
def q_agg_sentiment_by_community(spark, sf):
    return A.agg_sentiment_by_community(enriched(spark, sf))


@query("agg_content_trends", with_items(
    f"SELECT subreddit, post_date, content_type, count(*) AS post_count, {r6('avg(confidence)')} AS avg_confidence, "
    f"{r6('avg(p_informative)')} AS avg_informative_prob, {r6('avg(p_emotional)')} AS avg_emotional_prob, "
    f"{r6('avg(score)')} AS avg_post_score FROM items "
    f"WHERE content_type IN ('INFORMATIVE', 'EMOTIONAL') AND confidence >= 0.7 GROUP BY 1, 2, 3"))
def q_agg_content_trends(spark, sf):
    return A.agg_content_trends(enriched(spark, sf))


@query("agg_company_combined", with_items(
    f"SELECT '{COMPANY_TICKER}' AS ticker, post_date, sentiment_type, content_type, count(*) AS post_count, "
    f"{r6('avg(score)')} AS avg_post_score, {r6('avg(positive)')} AS avg_positive_sentiment, "
    f"{r6('avg(negative)')} AS avg_negative_sentiment, {r6('avg(confidence)')} AS avg_content_confidence, "
    f"{COMBINED_SQL} AS combined_classification FROM items "
    f"WHERE coalesce({ALIAS_SQL}, false) AND sentiment_type IS NOT NULL AND content_type IS NOT NULL "
    f"AND content_type <> 'DISABLED' GROUP BY post_date, sentiment_type, content_type"))
def q_agg_company_combined(spark, sf):
    return A.agg_company_combined(enriched(spark, sf), COMPANY_TICKER, COMPANY_ALIASES)


@query("agg_mentions_trend", with_items(
    f"SELECT t.ticker, i.post_date, i.sentiment_type, count(*) AS post_count FROM items i "
    f"JOIN (SELECT unnest([{lit_list(X.TICKERS)}]) AS ticker) t "
    f"ON contains(upper(i.title), t.ticker) OR contains(upper(i.selftext), t.ticker) GROUP BY 1, 2, 3"))
def q_agg_mentions_trend(spark, sf):
    return J.agg_mentions_trend(enriched(spark, sf), X.TICKERS)


TREND_CTE = "trend AS (SELECT post_date, sentiment_type, content_type, count(*) AS post_count FROM items GROUP BY 1, 2, 3)"


def dash_trend(spark, sf):
    return A.agg_trend(enriched(spark, sf), "ALL", "all", with_content=True)


@query("agg_sentiment_totals", with_items(
    "SELECT sentiment_type, cast(coalesce(total, 0) AS bigint) AS total FROM "
    "(SELECT unnest(['POSITIVE', 'NEGATIVE', 'NEUTRAL']) AS sentiment_type) b "
    "FULL JOIN (SELECT sentiment_type, sum(post_count) AS total FROM trend GROUP BY 1) t USING (sentiment_type)", TREND_CTE))
def q_agg_sentiment_totals(spark, sf):
    return A.agg_sentiment_totals(dash_trend(spark, sf))


@query("agg_content_totals", with_items(
    "SELECT content_type, cast(coalesce(total, 0) AS bigint) AS total FROM "
    "(SELECT unnest(['INFORMATIVE', 'EMOTIONAL']) AS content_type) b "
    "FULL JOIN (SELECT content_type, sum(post_count) AS total FROM trend WHERE content_type IS NOT NULL GROUP BY 1) t "
    "USING (content_type)", TREND_CTE))
def q_agg_content_totals(spark, sf):
    return A.agg_content_totals(dash_trend(spark, sf))


@query("agg_combined_totals", with_items(
    f"SELECT combined, cast(coalesce(total, 0) AS bigint) AS total FROM (SELECT unnest([{lit_list(P.COMBINED_LABELS)}]) AS combined) b "
    f"LEFT JOIN (SELECT concat_ws('_', sentiment_type, content_type) AS combined, sum(post_count) AS total FROM trend "
    f"WHERE content_type IS NOT NULL GROUP BY 1) t USING (combined)", TREND_CTE))
def q_agg_combined_totals(spark, sf):
    return A.agg_combined_totals(dash_trend(spark, sf))


@query("agg_trend_pivot", with_items(
    "SELECT post_date, "
    "cast(coalesce(sum(post_count) FILTER (WHERE sentiment_type = 'POSITIVE'), 0) AS bigint) AS positive, "
    "cast(coalesce(sum(post_count) FILTER (WHERE sentiment_type = 'NEGATIVE'), 0) AS bigint) AS negative, "
    "cast(coalesce(sum(post_count) FILTER (WHERE sentiment_type = 'NEUTRAL'), 0) AS bigint) AS neutral "
    "FROM trend GROUP BY post_date", TREND_CTE))
def q_agg_trend_pivot(spark, sf):
    return A.agg_trend_pivot(dash_trend(spark, sf))


SEARCH_SENT_CTE = f"""scored AS (
  SELECT *, CASE WHEN trim(st) <> '' THEN
      CASE WHEN pp = best THEN 'POSITIVE' WHEN nn = best THEN 'NEGATIVE' WHEN mx = best THEN 'MIXED' ELSE 'NEUTRAL' END END AS s_label
  FROM (SELECT *, greatest(pp, nn, mx, nu) AS best FROM (
    SELECT *, cast(p - least(p, n) AS double) / (p + n + 1) AS pp, cast(n - least(p, n) AS double) / (p + n + 1) AS nn,
      cast(2 * least(p, n) AS double) / (p + n + 1) AS mx, 1.0 / (p + n + 1) AS nu
    FROM (SELECT *, {count_in('tk', LEX.positive)} AS p, {count_in('tk', LEX.negative)} AS n
          FROM (SELECT *, {SEARCH_TEXT_SQL} AS st, {tokens(SEARCH_TEXT_SQL)} AS tk FROM items
                WHERE created_utc >= {SRCH.as_of} - {TF_HOURS} * 3600)))))"""


def search_scored(spark, sf):
    """Items of the search timeframe with the search text scored (unscorable -> no sentiment)."""
    d = flt.flt_timeframe(items(spark, sf), TF_HOURS, SRCH.as_of).withColumn("st", PR.search_text())
    d = S.score_columns(d, F.col("st"), sentiment_out="_s", lexicon=LEX)
    return d.withColumn("sentiment", F.when(S.scoring_error(F.col("st")).isNull(), F.col("_s"))).drop("_s")


@query("agg_summary", with_items(
    "SELECT count(*) AS total_items, count(*) FILTER (WHERE type = 'post') AS posts, "
    "count(*) FILTER (WHERE type = 'comment') AS comments, "
    "count(*) FILTER (WHERE s_label = 'POSITIVE') AS positive, count(*) FILTER (WHERE s_label = 'NEGATIVE') AS negative, "
    "count(*) FILTER (WHERE s_label = 'NEUTRAL') AS neutral, count(*) FILTER (WHERE s_label = 'MIXED') AS mixed, "
    f"coalesce({r6('avg(coalesce(score, 0))', 2)}, 0.0) AS average_score, "
    f"coalesce({r6('(max(coalesce(created_utc, 0.0)) - min(coalesce(created_utc, 0.0))) / 3600')}, 0.0) AS span_hours, "
    "CASE WHEN count(*) = 0 THEN 'No data' ELSE concat(cast(round(cast(round((max(coalesce(created_utc, 0.0)) - "
    "min(coalesce(created_utc, 0.0))) / 3600, 9) AS decimal(38,9)), 1) AS varchar), ' hours') END AS timeframe_coverage "
    "FROM scored", SEARCH_SENT_CTE))
def q_agg_summary(spark, sf):
    return A.agg_summary(search_scored(spark, sf))


@query("agg_sentiment_breakdown", with_items(
    "SELECT sentiment_type, cast(coalesce(total, 0) AS bigint) AS total FROM "
    "(SELECT unnest(['POSITIVE', 'NEGATIVE', 'NEUTRAL', 'MIXED']) AS sentiment_type) b FULL JOIN "
    "(SELECT s_label AS sentiment_type, count(*) AS total FROM scored WHERE s_label IS NOT NULL GROUP BY 1) t "
    "USING (sentiment_type)", SEARCH_SENT_CTE))
def q_agg_sentiment_breakdown(spark, sf):
    return A.agg_sentiment_breakdown(search_scored(spark, sf))


@query("agg_hwm", with_items(
    f"SELECT max(created_utc) AS new_mark, count(*) AS rows_past_mark FROM items WHERE type = 'post' AND created_utc >= {ING.mark}"))
def q_agg_hwm(spark, sf):
    return A.agg_hwm(posts(spark, sf), ING.mark)


@query("agg_label_distribution", with_items(
    f"SELECT label, n, {r6('n * 100.0 / sum(n) OVER ()')} AS percent FROM (SELECT informative_emotional_label AS label, "
    "count(*) AS n FROM labeled WHERE informative_emotional_label IN ('informative', 'emotional') GROUP BY 1)",
    TRAINING_ROWS_SQL, LABELED_SQL))
def q_agg_label_distribution(spark, sf):
    return A.agg_label_distribution(labeled(spark, sf))


# ---------------------------------------------------------------- 2.7 sorts / top-k


@query("top_recent", with_items(
    f"SELECT id, {PIPE_TEXT_SQL} AS display_text, subreddit, sentiment_type, url, type FROM items "
    "ORDER BY created_utc DESC, id LIMIT 20"))
def q_top_recent(spark, sf):
    from murmur.operators.topk import top_recent
    return top_recent(enriched(spark, sf)).drop("created_utc")


@query("top_extraction", with_items(
    f"SELECT id, type, score, created_utc FROM items WHERE {EXTRACT_WHERE} ORDER BY score DESC, created_utc DESC, id LIMIT 100"))
def q_top_extraction(spark, sf):
    return L.top_extraction(L.extraction(enriched(spark, sf)), 100).select("id", "type", "score", "created_utc")


@query("srt_rollup", DUAL_SQL + " ORDER BY post_date DESC, subreddit, post_count DESC")
def q_srt_rollup(spark, sf):
    from murmur.operators.topk import srt_rollup
    return srt_rollup(A.agg_dual_class(enriched(spark, sf)))


@query("srt_trend_days", with_items(
    "SELECT post_date, sentiment_type, count(*) AS post_count FROM items GROUP BY 1, 2 ORDER BY post_date"))
def q_srt_trend_days(spark, sf):
    return A.agg_trend(enriched(spark, sf)).orderBy("post_date")


# ---------------------------------------------------------------- 2.8 set operations


@query("set_union_items", with_items("SELECT type, id, post_id, subreddit FROM items"))
def q_set_union_items(spark, sf):
    p = adapter.posts(spark, sf).select("type", "id", "title", "subreddit")
    c = adapter.comments(spark, sf).select("type", "id", "post_id", "body", "subreddit")
    return p.unionByName(c, allowMissingColumns=True).select(
        "type", "id", "post_id", "subreddit")


COMMUNITIES = ("src1", "src2", "src3", "src5", "src8", "src13")


@query("set_union_communities", with_items(
    f"SELECT subreddit, type, count(*) AS n FROM items WHERE subreddit IN ({lit_list(COMMUNITIES)}) GROUP BY 1, 2"))
def q_set_union_communities(spark, sf):
    """Several communities in one scan (``isin``), not a loop of per-community queries."""
    return (items(spark, sf).filter(F.col("subreddit").isin(*COMMUNITIES))
            .groupBy("subreddit", "type").agg(F.count(F.lit(1)).alias("n")))
