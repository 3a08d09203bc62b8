"""Registered queries for sources and sinks. Each writes what Spark derives from the driver tables
into a fresh folder under the shared checkpoint directory and reads it back through the source
under test, so the whole table goes through the file format."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import params as P
from murmur.plans import jobs
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import with_items
from murmur.plans.q_enrich import PIPE_SCORED
from murmur.plans.q_relational import (LABELED_SQL, PIPE_TEXT_SQL, TRAINING_ROWS_SQL, TREND_CTE, enriched, items,
                                       labeled)
from murmur.plans.q_search import SEARCH_CTES
from murmur.plans.q_windows import ALL, ALL_CTES, LABEL_SCORED, MERGE_SQL
from murmur.schema import RAW_ITEM_FIELDS
from murmur.session import scratch_path
from murmur.sources import files, runs, schemas, sinks

ING = X.INGEST
ITEM_SQL = "SELECT type, id, post_id, title, selftext, body, url, subreddit, created_utc, score FROM items"
ITEM_COLS = ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit", "created_utc", "score"]


def _raw_dir(spark, sf):
    path = scratch_path(spark, "raw-batches")
    sinks.write_raw_batches(items(spark, sf), path, ING.batch_timestamp, ING.keywords, batch_size=500)
    return path


@query("src_raw_batch", with_items(ITEM_SQL))
def q_src_raw_batch(spark, sf):
    """Items written as wrapped batch documents and read back (wrapped and bare arrays both
    unwrap through the same reader; see tests for the bare form)."""
    return files.read_raw_batches(spark, _raw_dir(spark, sf), multi_line=False).select(*ITEM_COLS)


@query("src_ndjson", with_items(
    "SELECT id, type, subreddit, created_utc, sentiment_type, CASE WHEN sentiment_type IS NOT NULL THEN positive END AS positive, "
    "content_type, confidence, p_informative FROM items"))
def q_src_ndjson(spark, sf):
    path = scratch_path(spark, "enriched-ndjson")
    sinks.write_ndjson(enriched(spark, sf), path)
    e = files.read_enriched(spark, path)
    return e.select("id", "type", "subreddit", "created_utc", F.col("sentiment.Sentiment").alias("sentiment_type"),
                    F.col("sentiment.SentimentScore.Positive").alias("positive"),
                    F.col("content_type.Classification").alias("content_type"),
                    F.col("content_type.Confidence").alias("confidence"),
                    F.col("content_type.Probabilities.Informative").alias("p_informative"))


@query("src_file_stream", with_items(ITEM_SQL))
def q_src_file_stream(spark, sf):
    """The raw-batch folder consumed as a file stream (availableNow, checkpointed), collected by a
    foreachBatch sink into a table and read back."""
    from murmur.streaming.files import drain_to_parquet
    src = _raw_dir(spark, sf)
    out = drain_to_parquet(files.raw_stream(spark, src, max_files=4), scratch_path(spark, "stream-out"),
                           scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).select(*ITEM_COLS)


TRAIN_COLS = ["id", "text", "subreddit", "type", "score", "created_utc", "existing_sentiment",
              "informative_emotional_label", "labeler", "labeling_notes"]


@query("src_labeled_csv", with_items("SELECT * FROM labeled", TRAINING_ROWS_SQL, LABELED_SQL))
def q_src_labeled_csv(spark, sf):
    path = scratch_path(spark, "labeled-csv")
    sinks.write_training_csv(labeled(spark, sf).select(*TRAIN_COLS), path)
    return files.read_training_csv(spark, path)


@query("src_schema_evolve", with_items(
    f"SELECT id, type, created_utc, CASE WHEN created_utc >= {ING.mark} THEN sentiment_type END AS sentiment_type FROM items"))
def q_src_schema_evolve(spark, sf):
    """Rows before the mark written by an older writer without the sentiment column, later rows
    with it; the reader unions the schemas (missing -> null) instead of failing or dropping."""
    path = scratch_path(spark, "evolving")
    it = items(spark, sf)
    old = it.filter(F.col("created_utc") < ING.mark).select("id", "type", "created_utc")
    new = it.filter(F.col("created_utc") >= ING.mark).select("id", "type", "created_utc", "sentiment_type")
    sinks.write_evolving(old, path, "1")
    sinks.write_evolving(new, path, "2")
    return files.read_evolving_parquet(spark, path).select("id", "type", "created_utc", "sentiment_type")


def _three_runs(spark, sf) -> tuple[str, str]:
    """Posts, early comments and late comments as three runs of NDJSON whose fields appear, vanish and
    change type, crawled run by run."""
    path, log = scratch_path(spark, "evolving-json"), scratch_path(spark, "schema-log")
    it = items(spark, sf)
    late = F.col("created_utc") >= ING.mark
    parts = [it.filter("type = 'post'").select("id", "subreddit", "score", F.lit(True).alias("is_post")),
            it.filter((F.col("type") == "comment") & ~late).select("id", "type", (F.col("score") / 4).alias("score"), F.struct("post_id", "created_utc").alias("of")),
            it.filter((F.col("type") == "comment") & late).select("id", "type", F.concat(F.lit("about "), "score").alias("score"), F.array("post_id").alias("tags"))]
    for run, rows in enumerate(parts):
        sinks.write_ndjson(rows, f"{path}/run={run}")
        schemas.crawl(spark, f"{path}/run={run}", log, run)
    return path, log


@query("src_schema_inferred", with_items(
    f"SELECT id, CASE WHEN type = 'comment' THEN type END AS type, CASE WHEN type = 'post' THEN subreddit END AS subreddit, CASE WHEN type = 'post' THEN true END AS is_post, "
    f"CASE WHEN type = 'post' THEN cast(score AS varchar) WHEN created_utc < {ING.mark} THEN cast(cast(score AS double) / 4 AS varchar) ELSE concat('about ', score) END AS score, "
    f"CASE WHEN type = 'comment' AND created_utc < {ING.mark} THEN post_id END AS of_post, CASE WHEN type = 'comment' AND created_utc < {ING.mark} THEN created_utc END AS of_created, "
    f"CASE WHEN type = 'comment' AND created_utc >= {ING.mark} THEN post_id END AS tag FROM items"))
def q_src_schema_inferred(spark, sf):
    path, log = _three_runs(spark, sf)
    d = schemas.read_evolving_json(spark, path, log)
    return d.select("id", "type", "subreddit", "is_post", "score", F.col("of.post_id").alias("of_post"), F.col("of.created_utc").alias("of_created"),
                    F.col("tags")[0].alias("tag"))


@query("src_schema_changes", with_items(
    f"SELECT run, field, old_type, new_type FROM (VALUES (0, 'id', NULL, 'string'), (0, 'subreddit', NULL, 'string'), (0, 'score', NULL, 'bigint'), "
    f"(0, 'is_post', NULL, 'boolean'), (1, 'type', NULL, 'string'), (1, 'score', 'bigint', 'double'), (1, 'of', NULL, 'struct'), (1, 'of.post_id', NULL, 'string'), "
    f"(1, 'of.created_utc', NULL, 'double'), (2, 'score', 'double', 'string'), (2, 'tags', NULL, 'array'), (2, 'tags.[]', NULL, 'string')) v(run, field, old_type, new_type) "
    f"WHERE run IN (SELECT CASE WHEN type = 'post' THEN 0 WHEN created_utc < {ING.mark} THEN 1 ELSE 2 END FROM items)"))
def q_src_schema_changes(spark, sf):
    return schemas.changes(spark, _three_runs(spark, sf)[1])


@query("snk_label_progress", with_items(MERGE_SQL, TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_snk_label_progress(spark, sf):
    """A labeling run in numbered slices that stops after a few of them and is started again."""
    path, rows = scratch_path(spark, "label-run"), labeled(spark, sf).select(*TRAIN_COLS)
    runs.label_slices(rows, path, X.RUN_TIMESTAMP, n_slices=6, cues=X.CUES, at_most=2)
    done = runs.label_slices(rows, path, X.RUN_TIMESTAMP, cues=X.CUES)
    return done.select("id", "informative_emotional_label", "labeler", "labeling_notes")


@query("snk_raw_batch", with_items(
    "SELECT type, id, post_id, subreddit, score, num_comments, content_hash FROM kept_posts UNION ALL "
    "SELECT type, id, post_id, subreddit, score, cast(NULL AS bigint) AS num_comments, content_hash FROM kept_comments",
    *ALL_CTES))
def q_snk_raw_batch(spark, sf):
    """The ingest batch (everything accepted) written as batch documents with its manifest, read back."""
    path = scratch_path(spark, "ingest-batch")
    it = items(spark, sf)
    sinks.write_raw_batches(jobs.ingest_collect(it, ALL), path, ING.batch_timestamp, ING.keywords,
                            communities=jobs.examined_communities(it, ALL))
    back = files.read_raw_batches(spark, path, multi_line=False)
    return back.select("type", "id", "post_id", "subreddit", "score", "num_comments", "content_hash")


@query("snk_ndjson", with_items(
    "SELECT id, type, s_label AS sentiment_type, c_label AS classification, c_conf AS confidence FROM scored "
    "WHERE coalesce(txt, '') <> ''", PIPE_SCORED))
def q_snk_ndjson(spark, sf):
    """Enrichment output written one JSON object per line and read back with the explicit schema."""
    path = scratch_path(spark, "enrich-out")
    raw = items(spark, sf).select(*[c for c in RAW_ITEM_FIELDS if c in items(spark, sf).columns])
    sinks.write_ndjson(jobs.job_enrich(raw, X.LEXICON, X.CUES), path)
    e = files.read_enriched(spark, path)
    return e.select("id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"),
                    F.col("content_type.Classification").alias("classification"),
                    F.col("content_type.Confidence").alias("confidence"))


@query("snk_csv", with_items("SELECT * FROM training", TRAINING_ROWS_SQL))
def q_snk_csv(spark, sf):
    path = scratch_path(spark, "training-csv")
    sinks.write_training_csv(jobs.job_extract_training(enriched(spark, sf), None), path)
    return files.read_training_csv(spark, path)


@query("snk_label_snapshots", with_items(
    "SELECT 'backup' AS snapshot, count(*) AS n_rows, count(*) FILTER (WHERE informative_emotional_label IN "
    "('informative', 'emotional')) AS n_labeled FROM labeled UNION ALL "
    "SELECT 'final', count(*), count(*) FILTER (WHERE scorable OR informative_emotional_label IN ('informative', 'emotional')) "
    "FROM lab_scored", TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_snk_label_snapshots(spark, sf):
    before = labeled(spark, sf).select(*TRAIN_COLS)
    after = jobs.job_label(before, X.RUN_TIMESTAMP, X.CUES).table.select(*TRAIN_COLS)
    paths = sinks.write_snapshots(before, after, scratch_path(spark, "label-snapshots"), "20240116_090000")
    parts = [files.read_training_csv(spark, p).select(F.lit(name).alias("snapshot"), "informative_emotional_label")
             for name, p in paths.items()]
    u = parts[0].unionByName(parts[1])
    return u.groupBy("snapshot").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_if(F.col("informative_emotional_label").isin(*P.LABELS)).alias("n_labeled"))


@query("snk_enriched_table", with_items(
    "SELECT id, type, post_date, CASE WHEN type = 'post' THEN 'r1' ELSE 'r2' END AS run FROM items"))
def q_snk_enriched_table(spark, sf):
    """Two runs added to the enriched table, the first one replayed: every row is there once."""
    path = scratch_path(spark, "enriched-table")
    e = enriched(spark, sf)
    for run, kind in (("r1", "post"), ("r2", "comment"), ("r1", "post")):
        sinks.write_enriched_table(e.filter(F.col("type") == kind), path, run)
    return files.read_enriched_table(spark, path).select("id", "type", "post_date", "run")


@query("src_corrupt_batches", with_items(
    "SELECT (SELECT count(*) FROM items WHERE type = 'comment') AS n_items, (SELECT count(*) FROM items WHERE type = 'post' AND score % 7 = 0) AS n_corrupt"))
def q_src_corrupt_batches(spark, sf):
    """Batch folders with broken documents: the items of the good ones are read, the broken ones counted."""
    path = scratch_path(spark, "mixed-batches")
    it = items(spark, sf)
    sinks.write_raw_batches(it.filter(F.col("type") == "comment"), path, ING.batch_timestamp, ING.keywords, run="1")
    (it.filter((F.col("type") == "post") & (F.col("score") % 7 == 0))
     .select(F.concat(F.lit('{"metadata": {}, "data": [{"id": "'), "id", F.lit('", "title": '))).write.mode("overwrite").text(f"{path}/run=2"))
    good = files.read_raw_batches(spark, path, multi_line=False).agg(F.count("id").alias("n_items"))
    bad = files.corrupt_batches(spark, path, multi_line=False).agg(F.count("record").alias("n_corrupt"))
    return good.unionByName(bad, allowMissingColumns=True).agg(F.max("n_items").alias("n_items"), F.max("n_corrupt").alias("n_corrupt"))


RECENT_SQL = "(SELECT *, row_number() OVER (ORDER BY created_utc DESC, id) AS n FROM items)"


@query("snk_dashboard_doc", with_items(
    "SELECT 'trend' AS part, cast(row_number() OVER (ORDER BY post_date DESC, sentiment_type DESC NULLS LAST) - 1 AS integer) AS pos, "
    "cast(post_date AS varchar) AS post_date, sentiment_type, cast(sum(post_count) AS bigint) AS post_count, cast(NULL AS varchar) AS display_text, "
    "cast(NULL AS varchar) AS subreddit, cast(NULL AS varchar) AS url, cast(NULL AS varchar) AS type FROM trend GROUP BY post_date, sentiment_type "
    f"UNION ALL SELECT 'posts', cast(n - 1 AS integer), NULL, sentiment_type, NULL, {PIPE_TEXT_SQL}, subreddit, url, type FROM {RECENT_SQL} WHERE n <= {P.RECENT_ROWS}",
    TREND_CTE))
def q_snk_dashboard_doc(spark, sf):
    """The dashboard document written as text, read back and opened again into its rows."""
    path = scratch_path(spark, "dashboard")
    jobs.dashboard_doc(jobs.job_dashboard(enriched(spark, sf), X.DASHBOARD), X.DASHBOARD).select("doc").write.mode("overwrite").text(path)
    doc = spark.read.text(path).select(F.from_json("value", jobs.DASHBOARD_DOC).alias("d"))
    t = doc.select(F.posexplode("d.trend_data").alias("pos", "x")).select(F.lit("trend").alias("part"), "pos", "x.*")
    r = doc.select(F.posexplode("d.posts_data").alias("pos", "x")).select(F.lit("posts").alias("part"), "pos", "x.*")
    return t.unionByName(r, allowMissingColumns=True)


@query("snk_search_doc", with_items(
    "SELECT cast(pos - 1 AS integer) AS pos, id, type, title, selftext, body, url, subreddit, created_utc, score, num_comments, "
    f"CASE WHEN contains(txt, '{X.SEARCH.rejects}') THEN NULL ELSE s_label END AS sentiment, total_items, '{X.SEARCH.ticker}' AS ticker FROM ("
    "SELECT *, row_number() OVER (ORDER BY subreddit, pc DESC, pid, is_c, crank) AS pos, count(*) OVER () AS total_items FROM ss) "
    f"WHERE pos <= {P.SEARCH_SAMPLE_SIZE}", *SEARCH_CTES))
def q_snk_search_doc(spark, sf):
    """The search document written as text, read back and opened again into its items."""
    path = scratch_path(spark, "search")
    jobs.search_doc(jobs.job_search(items(spark, sf), X.SEARCH, X.LEXICON), X.SEARCH).select("doc").write.mode("overwrite").text(path)
    item = ("struct<id:string,type:string,title:string,selftext:string,body:string,url:string,subreddit:string,created_utc:double,score:bigint,"
            "num_comments:bigint,sentiment:struct<Sentiment:string>>")
    doc = spark.read.text(path).select(F.from_json("value", f"ticker string, summary struct<total_items:bigint>, data array<{item}>").alias("d"))
    rows = doc.select("d.ticker", F.col("d.summary.total_items").alias("total_items"), F.posexplode("d.data").alias("pos", "x"))
    return rows.select("pos", "x.*", "total_items", "ticker").withColumn("sentiment", F.col("sentiment.Sentiment"))
