"""Registered queries: the end-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import params as P
from murmur.operators import ml as ML
from murmur.plans import jobs
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import r6, with_items
from murmur.plans.q_enrich import PIPE_SCORED
from murmur.plans.q_io import _raw_dir
from murmur.plans.q_relational import (EXTRACT_WHERE, LABELED_SQL, TRAINING_ROWS_SQL, TREND_CTE, enriched, items,
                                       labeled)
from murmur.plans.q_search import SEARCH_CTES
from murmur.plans.q_windows import INGEST_CTES, LABEL_SCORED, MERGE_SQL
from murmur.sources import files

ING = X.INGEST
SRCH = X.SEARCH

BATCH_SQL = ("SELECT type, id, post_id, substr(title, 1, 500) AS title, substr(selftext, 1, 10000) AS selftext, "
             "substr(body, 1, 5000) AS body, url, subreddit, created_utc, score, {nc} AS num_comments, content_hash FROM {src}")


@query("job_ingest", with_items(
    BATCH_SQL.format(nc="num_comments", src="kept_posts") + " UNION ALL "
    + BATCH_SQL.format(nc="cast(NULL AS bigint)", src="kept_comments"), *INGEST_CTES))
def q_job_ingest(spark, sf):
    """Collected batch (posts + quality comments within the budget), sanitized and hashed."""
    return jobs.job_ingest(items(spark, sf), ING).batch


@query("job_enrich", with_items(
    "SELECT id, type, s_label AS sentiment_type, c_label AS classification, c_conf AS confidence FROM scored "
    "WHERE coalesce(txt, '') <> ''", PIPE_SCORED))
def q_job_enrich(spark, sf):
    """Raw batch files -> enriched rows."""
    e = jobs.job_enrich(files.read_raw_batches(spark, _raw_dir(spark, sf), multi_line=False), X.LEXICON, X.CUES)
    return e.select("id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"),
                    F.col("content_type.Classification").alias("classification"),
                    F.col("content_type.Confidence").alias("confidence"))


@query("job_enrich_model")
def q_job_enrich_model(spark, sf):
    """Enrichment with the trained model, loaded from where training saved it."""
    from murmur.plans.q_ml import _train
    e = jobs.job_enrich(items(spark, sf), X.LEXICON, model=ML.load_model(_train(spark, sf)))
    return e.select("id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"),
                    F.col("content_type.Classification").alias("classification"), F.col("content_type.Confidence").alias("confidence"))


@query("job_dashboard", with_items("SELECT * FROM trend", TREND_CTE))
def q_job_dashboard(spark, sf):
    return jobs.job_dashboard(enriched(spark, sf), X.DASHBOARD).trend


@query("job_search", with_items(
    f"SELECT id, type, CASE WHEN contains(txt, '{SRCH.rejects}') THEN NULL ELSE s_label END AS sentiment_type, "
    f"CASE WHEN contains(txt, '{SRCH.rejects}') THEN '{P.REJECTED_TEXT}' END AS sentiment_error FROM ss", *SEARCH_CTES))
def q_job_search(spark, sf):
    r = jobs.job_search(items(spark, sf), SRCH, X.LEXICON)
    return r.items.select("id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"), "sentiment_error")


@query("top_search_sample", with_items(
    f"SELECT id, type, subreddit FROM ss ORDER BY subreddit, pc DESC, pid, is_c, crank LIMIT {P.SEARCH_SAMPLE_SIZE}",
    *SEARCH_CTES))
def q_top_search_sample(spark, sf):
    return jobs.job_search(items(spark, sf), SRCH, X.LEXICON).sample.select("id", "type", "subreddit")


EXTRACT_N = 100  # fewer than the rows that qualify
TOP_TRAIN_SQL = f"""toptrain AS (
  SELECT * FROM (SELECT * FROM items WHERE {EXTRACT_WHERE} ORDER BY score DESC, created_utc DESC, id LIMIT {EXTRACT_N}))"""


@query("job_extract_training", with_items(
    TRAINING_ROWS_SQL.split("AS (", 1)[1].rsplit(")", 1)[0].replace("FROM items WHERE", "FROM toptrain WHERE", 1),
    TOP_TRAIN_SQL))
def q_job_extract_training(spark, sf):
    return jobs.job_extract_training(enriched(spark, sf), EXTRACT_N)


@query("job_label", with_items(
    f"SELECT informative_emotional_label AS label, n, {r6('n * 100.0 / sum(n) OVER ()')} AS percent FROM ("
    "SELECT informative_emotional_label, count(*) AS n FROM (" + MERGE_SQL + ") WHERE informative_emotional_label IN "
    "('informative', 'emotional') GROUP BY 1)", TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_job_label(spark, sf):
    """Label run -> label distribution of the merged table."""
    return jobs.job_label(labeled(spark, sf), X.RUN_TIMESTAMP, X.CUES).distribution


@query("job_train_eval")
def q_job_train_eval(spark, sf):
    """labeled -> split -> train (per-pass validation) -> evaluate the best model on the test rows."""
    from murmur.plans.q_ml import _train
    path = _train(spark, sf)
    model, runs, test = ML.load_model(path), spark.read.parquet(f"{path}/runs"), spark.read.parquet(f"{path}/test")
    pred = ML.ml_predict(model, test).select(F.col("informative_emotional_label").alias("actual"),
                                             F.col("predicted_class").alias("predicted"))
    best = ML.agg_best_epoch(runs).select(F.col("epoch").alias("best_epoch"))
    return ML.evaluate(pred).unionByName(best, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "best_epoch")])
