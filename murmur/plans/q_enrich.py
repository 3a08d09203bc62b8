"""Registered queries: scorers, reply parsers, error policies, labeling."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.functions.text import py_strip
from murmur.operators import labeling as L
from murmur.operators import projections as PR
from murmur.plans import jobs
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import py_strip as sql_strip, scored_cte, with_items
from murmur.plans.q_relational import (ING, LABELED_SQL, PIPE_TEXT_SQL, RELEVANT_SQL, SEARCH_TEXT_SQL,
                                       TRAINING_ROWS_SQL, items, labeled, posts)
from murmur.plans.q_windows import LABEL_SCORED, MERGE_SQL
from murmur.sources.tables import table

PIPE_SCORED = scored_cte("scored", "items", PIPE_TEXT_SQL)


@query("enr_sentiment", with_items(
    "SELECT id, s_label AS sentiment_type, pp AS positive, nn AS negative, nu AS neutral, mx AS mixed FROM scored "
    "WHERE txt IS NOT NULL", PIPE_SCORED))
def q_enr_sentiment(spark, sf):
    d = S.score_columns(items(spark, sf).withColumn("_t", PR.pipeline_text()), F.col("_t"),
                        sentiment_out="s", lexicon=X.LEXICON).filter(F.col("s").isNotNull())
    return d.select("id", F.col("s.Sentiment").alias("sentiment_type"),
                    F.col("s.SentimentScore.Positive").alias("positive"),
                    F.col("s.SentimentScore.Negative").alias("negative"),
                    F.col("s.SentimentScore.Neutral").alias("neutral"),
                    F.col("s.SentimentScore.Mixed").alias("mixed"))


@query("enr_content_type", with_items(
    "SELECT id, c_label AS classification, c_conf AS confidence, "
    "CASE WHEN scorable THEN pi END AS p_informative, CASE WHEN scorable THEN 1.0 - pi END AS p_emotional FROM scored",
    PIPE_SCORED))
def q_enr_content_type(spark, sf):
    d = S.score_columns(items(spark, sf).withColumn("_t", PR.pipeline_text()), F.col("_t"), content_out="c", cues=X.CUES)
    return d.select("id", F.col("c.Classification").alias("classification"), F.col("c.Confidence").alias("confidence"),
                    F.col("c.Probabilities.Informative").alias("p_informative"),
                    F.col("c.Probabilities.Emotional").alias("p_emotional"))


SEARCH_SCORED = scored_cte("sscored", "items", SEARCH_TEXT_SQL, where=f"{sql_strip(SEARCH_TEXT_SQL)} <> ''")


@query("enr_error_passthrough", with_items(
    f"SELECT id, CASE WHEN contains(txt, '{X.SEARCH.rejects}') THEN NULL ELSE s_label END AS sentiment_type, "
    f"CASE WHEN contains(txt, '{X.SEARCH.rejects}') THEN '{P.REJECTED_TEXT}' END AS sentiment_error FROM sscored",
    SEARCH_SCORED))
def q_enr_error_passthrough(spark, sf):
    """Search scoring: a text the scorer rejects keeps its row, unscored; blank texts are dropped."""
    s = jobs.search_score(items(spark, sf), X.LEXICON, X.SEARCH.rejects)
    return s.select("id", F.col("sentiment.Sentiment").alias("sentiment_type"), "sentiment_error")


@query("enr_relevance", with_items(f"SELECT id, coalesce({RELEVANT_SQL}, false) AS relevant FROM items WHERE type = 'post'"))
def q_enr_relevance(spark, sf):
    return posts(spark, sf).select("id", S.relevance("title", "selftext", ING.relevance_terms).alias("relevant"))


# Replies, error messages and labels derived from the conversation turns, so that every branch occurs.
KIND_SQL = "((conv_id * 7 + turn) % 12)"
REPLY_CASES = ["'{\"decision\": \"RELEVANT\"}'", "'{\"decision\": \"irrelevant\", \"n\": 1}'", "'{\"decision\": null}'", "'{\"decision\": 5}'", "'NaN'",
               "'{\"decision\": \"IRRELEVANT\"} extra'", "'\"RELEVANT\"'", "''", "'[1, 2]'", "concat('I think RELEVANT: ', text)",
               "'  {\"decision\": \"relevant\"} '", "text"]
ERROR_CASES = ["concat('AccessDenied: You don''t have access to the model ', role)", "concat('ThrottlingException: ', role)", "'Too many requests'",
               "concat('ValidationException in turn ', cast(turn AS {string}))", "text"]
LABEL_CASES = ["'Informative.'", "concat(' EMOTIONAL ', role)", "NULL", "'emotional, not informative'", "text"]


def case_sql(cases: list[str], string: str = "varchar") -> str:
    return f"CASE {KIND_SQL} % {len(cases)} " + " ".join(f"WHEN {k} THEN {c.format(string=string) if '{string}' in c else c}" for k, c in enumerate(cases)) + " END"


def turns(spark, sf, cases: list[str]):
    return table(spark, sf, "conversations").withColumn("reply", F.expr(case_sql(cases, "string").replace("''t", "\\'t")))


def turns_sql(cases: list[str]) -> str:
    return f"(SELECT conv_id, turn, {case_sql(cases)} AS reply FROM conversations)"


REPLY = sql_strip("reply")
IS_JSON = f"(json_valid({REPLY}) OR {REPLY} IN ('NaN', 'Infinity', '-Infinity'))"
DECISION = f"json_extract({REPLY}, '$.decision')"
PARSE_SQL = (f"CASE WHEN reply IS NULL OR {REPLY} = '' THEN false "
             f"WHEN starts_with({REPLY}, '{{') AND {IS_JSON} THEN CASE WHEN {DECISION} IS NULL THEN false "
             f"WHEN json_type({DECISION}) <> 'VARCHAR' THEN true ELSE upper(json_extract_string({REPLY}, '$.decision')) = 'RELEVANT' END "
             f"WHEN {IS_JSON} THEN true ")


@query("enr_parse_decision",
       "SELECT conv_id, turn, " + PARSE_SQL + "ELSE contains(upper(" + REPLY + "), 'RELEVANT') END AS relevant, "
       + PARSE_SQL + "ELSE regexp_matches(upper(" + REPLY + "), '(^|[^A-Z])RELEVANT') END AS relevant_strict "
       "FROM " + turns_sql(REPLY_CASES))
def q_enr_parse_decision(spark, sf):
    """Model replies re-aimed onto the turns of ``conversations``."""
    r = py_strip("reply")
    return turns(spark, sf, REPLY_CASES).select("conv_id", "turn", S.parse_decision(r).alias("relevant"),
                                                S.parse_decision(r, strict=True).alias("relevant_strict"))


@query("enr_error_policy",
       "SELECT conv_id, turn, CASE WHEN contains(reply, 'You don''t have access to the model') THEN false "
       "WHEN contains(reply, 'ThrottlingException') OR contains(reply, 'Too many requests') THEN true "
       "WHEN contains(reply, 'ValidationException') THEN false ELSE true END AS keep FROM " + turns_sql(ERROR_CASES))
def q_enr_error_policy(spark, sf):
    """Error messages re-aimed onto the turns of ``conversations``."""
    return turns(spark, sf, ERROR_CASES).select("conv_id", "turn", S.error_policy("reply").alias("keep"))


@query("lbl_normalize",
       "SELECT conv_id, turn, CASE WHEN reply IS NULL THEN 'error' WHEN contains(lower(reply), 'informative') THEN 'informative' "
       "WHEN contains(lower(reply), 'emotional') THEN 'emotional' ELSE 'unknown' END AS label "
       "FROM " + turns_sql(LABEL_CASES))
def q_lbl_normalize(spark, sf):
    return turns(spark, sf, LABEL_CASES).select("conv_id", "turn", S.normalize_label("reply").alias("label"))


@query("lbl_ai_label", with_items(
    MERGE_SQL.replace("SELECT id,", "SELECT id, text, existing_sentiment,", 1),
    TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_lbl_ai_label(spark, sf):
    return L.lbl_ai_label(labeled(spark, sf), X.RUN_TIMESTAMP, X.CUES).select(
        "id", "text", "existing_sentiment", "informative_emotional_label", "labeler", "labeling_notes")

