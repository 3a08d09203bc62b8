"""Registered queries: windows, dedup, the ingest joins and funnel, quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.operators import dedup as D
from murmur.operators import joins as J
from murmur.operators import labeling as L
from murmur.operators import projections as PR
from murmur.operators import windows as WN
from murmur.plans import jobs
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import contains_any, scored_cte, with_items
from murmur.plans.q_relational import (HASH_SQL, LABELED_SQL, PIPE_TEXT_SQL, POST_TEXT_SQL, RELEVANT_SQL,
                                       TRAINING_ROWS_SQL, items, labeled, posts)
from murmur.session import scratch_path
from murmur.sources.tables import table

ING = X.INGEST

NEWEST = (f"newest AS (SELECT * FROM items WHERE type = 'post' QUALIFY row_number() OVER "
          f"(PARTITION BY subreddit ORDER BY created_utc DESC, id) <= {ING.newest_per_community})")
STAGES_SQL = [
    ("after_timestamp", f"created_utc >= {ING.mark}"),
    ("with_keywords", contains_any(POST_TEXT_SQL, ING.keywords)),
    ("not_ignored", f"NOT {contains_any(POST_TEXT_SQL, ING.ignore_keywords)}"),
    ("meeting_score", f"score >= {ING.min_post_score}"),
    ("meeting_length", f"length(coalesce(selftext, '')) >= {ING.min_post_length}"),
    ("ai_relevant", RELEVANT_SQL),
]
ACCEPT_WHERE = " AND ".join(f"({w})" for _, w in STAGES_SQL)
QUALITY = f"score >= {ING.min_comment_score} AND length(coalesce(body, '')) >= {ING.min_comment_length}"
INGEST_CTES = [
    NEWEST,
    f"accepted AS (SELECT *, {HASH_SQL} AS content_hash FROM newest WHERE {ACCEPT_WHERE})",
    "linked AS (SELECT c.* EXCLUDE (subreddit), a.subreddit FROM items c JOIN accepted a ON c.post_id = a.id "
    "WHERE c.type = 'comment')",
    f"counts AS (SELECT post_id, count(*) AS num_comments, count(*) FILTER (WHERE {QUALITY}) AS kept "
    "FROM linked GROUP BY post_id)",
    "posts_n AS (SELECT a.*, coalesce(k.num_comments, 0) AS num_comments, 1 + coalesce(k.kept, 0) AS n_items "
    "FROM accepted a LEFT JOIN counts k ON k.post_id = a.id)",
    "budget AS (SELECT *, cast(coalesce(sum(n_items) OVER (ORDER BY subreddit, created_utc DESC, id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS items_before FROM posts_n)",
    f"kept_posts AS (SELECT * FROM budget WHERE items_before < {ING.budget})",
    f"kept_comments AS (SELECT *, {HASH_SQL} AS content_hash FROM linked WHERE {QUALITY} "
    "AND post_id IN (SELECT id FROM kept_posts))",
]
# The same rules over all posts, without the listing's cut and without a budget.
ALL = X.INGEST_ALL
ALL_CTES = ["newest AS (SELECT * FROM items WHERE type = 'post')", *INGEST_CTES[1:5],
            "kept_posts AS (SELECT * FROM posts_n)", INGEST_CTES[7]]
NEWEST_N = 20  # communities hold more posts than this


@query("src_newest_per_group", with_items(
    f"SELECT id, subreddit FROM items WHERE type = 'post' QUALIFY row_number() OVER "
    f"(PARTITION BY subreddit ORDER BY created_utc DESC, id) <= {NEWEST_N}"))
def q_src_newest_per_group(spark, sf):
    return WN.newest_per_group(posts(spark, sf), "subreddit", NEWEST_N).select("id", "subreddit")


@query("join_comments_of_accepted", with_items(
    "SELECT id, post_id, subreddit FROM linked", *ALL_CTES[:3]))
def q_join_comments_of_accepted(spark, sf):
    it = items(spark, sf)
    acc = jobs.ingest_accepted(jobs.ingest_examined(it, ALL), ALL)
    return J.join_comments_of_accepted(acc, it.filter(F.col("type") == "comment")).select("id", "post_id", "subreddit")


@query("agg_filter_funnel", with_items(
    "SELECT subreddit, count(*) AS examined, "
    + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(f'({w})' for _, w in STAGES_SQL[:i + 1])}) AS {n}"
                for i, (n, _) in enumerate(STAGES_SQL))
    + " FROM newest GROUP BY subreddit", ALL_CTES[0]))
def q_agg_filter_funnel(spark, sf):
    return jobs.ingest_funnel(items(spark, sf), ALL)


@query("win_item_budget", with_items("SELECT id, n_items, items_before FROM kept_posts", *INGEST_CTES[:7]))
def q_win_item_budget(spark, sf):
    posts_n, _, _ = jobs.ingest_candidates(items(spark, sf), ING)
    return WN.item_budget(posts_n, ING.budget).select("id", "n_items", "items_before")


COMMENT_CAP_SQL = with_items(
    f"SELECT id, post_id, comment_rank FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY created_utc, id) "
    f"AS comment_rank FROM items WHERE type = 'comment') WHERE comment_rank <= {P.SEARCH_COMMENTS_PER_POST} "
    f"AND score >= {P.SEARCH_MIN_COMMENT_SCORE} AND length(coalesce(body, '')) >= {P.SEARCH_MIN_COMMENT_LENGTH}")


@query("win_comment_cap", COMMENT_CAP_SQL)
def q_win_comment_cap(spark, sf):
    """First 10 comments per post, then the search quality filter (order matters)."""
    from murmur.operators.filters import comment_quality
    c = WN.comment_cap(items(spark, sf).filter(F.col("type") == "comment"))
    return (c.filter(comment_quality(P.SEARCH_MIN_COMMENT_SCORE, P.SEARCH_MIN_COMMENT_LENGTH))
            .select("id", "post_id", F.col("comment_rank").cast("bigint").alias("comment_rank")))


def request_log(spark, sf, client: str = "user_id"):
    """Search requests re-aimed onto ``events``: client = the user, time = ts (epoch seconds)."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return e.select("event_id", F.expr(client).cast("bigint").alias("client"), (F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / 1e6).alias("ts_s"))


QUOTA_LIMIT = P.SEARCH_QUOTA_PER_HOUR


def quota_sql(client: str, window: float) -> str:
    """The state is the list of the last accepted times: a recursive CTE walks each client's requests in order."""
    return f"""WITH RECURSIVE ev AS (
  SELECT *, row_number() OVER (PARTITION BY client ORDER BY ts_s, event_id) AS rn
  FROM (SELECT event_id, cast({client} AS bigint) AS client, cast(epoch_us(ts) AS double) / 1000000 AS ts_s FROM events)),
r AS (
  SELECT event_id, client, ts_s, rn, true AS accepted, [ts_s] AS kept FROM ev WHERE rn = 1
  UNION ALL
  SELECT event_id, client, ts_s, rn, len(k) < {QUOTA_LIMIT} AS accepted, CASE WHEN len(k) < {QUOTA_LIMIT} THEN list_append(k, ts_s) ELSE k END AS kept
  FROM (SELECT e.event_id, e.client, e.ts_s, e.rn, list_filter(r.kept, lambda x: x > e.ts_s - {window}) AS k
        FROM r JOIN ev e ON e.client = r.client AND e.rn = r.rn + 1))
SELECT event_id, client, ts_s, accepted FROM r"""


QUOTA_SQL = quota_sql("user_id", X.QUOTA_WINDOW)


@query("win_sliding_quota", QUOTA_SQL)
def q_win_sliding_quota(spark, sf):
    """The quota per user, over a week."""
    return WN.sliding_quota(request_log(spark, sf), "client", "ts_s", QUOTA_LIMIT, X.QUOTA_WINDOW)


@query("win_sliding_quota_one_client", quota_sql("0", 3600.0))
def q_win_sliding_quota_one_client(spark, sf):
    """The hourly quota where one client makes all requests: an unbroken burst over many blocks."""
    return WN.sliding_quota(request_log(spark, sf, "0"), "client", "ts_s", QUOTA_LIMIT, 3600.0, block_rows=1000)


DAILY_N = 2  # requests per user and day on the driver tables


@query("win_daily_quota",
       f"SELECT event_id, user_id, cast(ts AS date) AS day, row_number() OVER (PARTITION BY user_id, cast(ts AS date) "
       f"ORDER BY ts, event_id) AS request_no FROM events QUALIFY request_no <= {DAILY_N}")
def q_win_daily_quota(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return WN.daily_quota(e, "user_id", "ts", DAILY_N).select(
        "event_id", "user_id", "day", F.col("request_no").cast("bigint").alias("request_no"))


OVERLAP = 3 * 86400.0


SEEN_SQL = (f"SELECT n.id FROM items n WHERE n.type = 'post' AND n.created_utc >= {ING.mark} "
            f"AND NOT EXISTS (SELECT 1 FROM items s WHERE s.created_utc <= {ING.mark + OVERLAP} AND s.id = n.id)")


def new_and_seen(spark, sf):
    """New run (rows at or past the mark), and what earlier runs ingested, of which one went three
    days past the mark that was stored."""
    it = items(spark, sf)
    new = it.filter((F.col("type") == "post") & (F.col("created_utc") >= ING.mark))
    return new, it.filter(F.col("created_utc") <= ING.mark + OVERLAP)


@query("dedup_ids", with_items(SEEN_SQL))
def q_dedup_ids(spark, sf):
    """New run minus what earlier runs ingested."""
    new, seen = new_and_seen(spark, sf)
    return J.dedup_ids(new, seen).select("id")


@query("dedup_ids_by_bits", with_items(SEEN_SQL))
def q_dedup_ids_by_bits(spark, sf):
    """The same against the merged bits of two earlier runs; only possible hits reach the exact join."""
    new, seen = (d.select("id", "created_utc") for d in new_and_seen(spark, sf))
    path = scratch_path(spark, "id-bits")
    for run, rows in (("1", F.col("created_utc") < ING.mark), ("2", F.col("created_utc") >= ING.mark)):
        D.write_id_bits(seen.filter(rows), path, run)
    stored = scratch_path(spark, "new-ids")
    new.select("id").write.parquet(stored)
    return D.dedup_ids_by_bits(spark.read.parquet(stored), seen, spark.read.parquet(path)).select("id")


@query("dedup_content", with_items(
    f"SELECT id, {HASH_SQL} AS content_hash FROM items QUALIFY row_number() OVER "
    f"(PARTITION BY {HASH_SQL} ORDER BY created_utc, id) = 1"))
def q_dedup_content(spark, sf):
    return D.dedup_content(PR.prj_content_hash(items(spark, sf))).select("id", "content_hash")


ENRICH_SCORED = scored_cte("scored", "items", PIPE_TEXT_SQL)


@query("join_enrichment", with_items(
    "SELECT id, type, s_label AS sentiment_type, c_label AS classification FROM scored", ENRICH_SCORED))
def q_join_enrichment(spark, sf):
    """Scores materialised by id, then joined back (the shape used when a model scores a
    projection of the table rather than the rows in place)."""
    it = items(spark, sf)
    t = PR.pipeline_text()
    scores = S.score_columns(it.select("id", t.alias("_t")), F.col("_t"), sentiment_out="sentiment",
                             content_out="content_type", lexicon=X.LEXICON, cues=X.CUES).drop("_t")
    return J.join_enrichment(it.select("id", "type"), scores).select(
        "id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"),
        F.col("content_type.Classification").alias("classification"))


LABEL_SCORED = scored_cte("lab_scored", "labeled", "text")
MERGE_SQL = f"""SELECT id,
  CASE WHEN coalesce(informative_emotional_label, '') <> '' THEN informative_emotional_label
       WHEN scorable THEN lower(c_label) ELSE 'needs_review' END AS informative_emotional_label,
  CASE WHEN coalesce(informative_emotional_label, '') <> '' THEN labeler
       WHEN scorable THEN '{P.LABELER_OK}' ELSE '{P.LABELER_ERROR}' END AS labeler,
  CASE WHEN coalesce(informative_emotional_label, '') <> '' THEN labeling_notes
       WHEN scorable THEN '{P.LABEL_NOTE.format(X.RUN_TIMESTAMP)}' ELSE labeling_notes END AS labeling_notes
FROM lab_scored"""


@query("join_label_merge", with_items(MERGE_SQL, TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_join_label_merge(spark, sf):
    """Labels scored as a separate frame (the unlabeled rows only), written back by id."""
    tbl = labeled(spark, sf)
    from murmur.operators import filters as flt
    scored = L.label_replies(flt.flt_unlabeled(tbl), cues=X.CUES).select("id", S.normalize_label(F.col("reply")).alias("new_label"))
    return L.join_label_merge(tbl, scored, X.RUN_TIMESTAMP).select(
        "id", "informative_emotional_label", "labeler", "labeling_notes")


@query("agg_label_run_stats", with_items(
    "SELECT count(*) AS processed, count(*) FILTER (WHERE scorable) AS labeled, "
    "count(*) FILTER (WHERE NOT scorable) AS needs_review FROM lab_scored "
    "WHERE coalesce(informative_emotional_label, '') = ''", TRAINING_ROWS_SQL, LABELED_SQL, LABEL_SCORED))
def q_agg_label_run_stats(spark, sf):
    return jobs.job_label(labeled(spark, sf), X.RUN_TIMESTAMP, X.CUES).stats


@query("agg_batch_manifest", with_items(
    f"SELECT '{ING.batch_timestamp}' AS timestamp, count(*) AS total_items, "
    f"(SELECT array_to_string(list_sort(list(DISTINCT subreddit)), ',') FROM items WHERE type = 'post') AS processed_subreddits, "
    f"'{','.join(ING.keywords)}' AS keywords FROM (SELECT id FROM kept_posts UNION ALL SELECT id FROM kept_comments)",
    *ALL_CTES))
def q_agg_batch_manifest(spark, sf):
    m = jobs.job_ingest(items(spark, sf), ALL).manifest
    return m.select("timestamp", "total_items", F.array_join("processed_subreddits", ",").alias("processed_subreddits"),
                    F.array_join("keywords", ",").alias("keywords"))

