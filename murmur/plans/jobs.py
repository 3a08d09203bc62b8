"""End-to-end jobs composed from the operators. Each takes DataFrames and parameters and
returns DataFrames (lazy); sinks and commits are separate so a job can be re-run after a lost
executor without duplicating output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.operators import aggregations as A
from murmur.operators import filters as flt
from murmur.operators import joins as J
from murmur.operators import labeling as L
from murmur.operators import ml as ML
from murmur.operators import projections as PR
from murmur.operators import windows as WN
from murmur.operators.topk import top_recent
from murmur.session import cut_lineage

BATCH_COLUMNS = ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit", "created_utc",
                 "score", "num_comments", "content_hash"]


def community_rank(communities) -> Column | None:
    """Collection order of communities: the configured list, else name order (None)."""
    if not communities:
        return None
    return F.array_position(F.array(*[F.lit(c) for c in communities]), F.col("subreddit"))


# ------------------------------------------------------------------------------ ingest

def ingest_stages(p: P.IngestParams) -> list[tuple[str, Column]]:
    """Post tests in the original's order (cheap first); the funnel counts them cumulatively."""
    return [
        ("after_timestamp", flt.since_mark(p.mark)),
        ("with_keywords", flt.has_keyword(p.keywords, p.keyword_match)),
        ("not_ignored", ~flt.has_ignored(p.ignore_keywords)),
        ("meeting_score", F.col("score") >= p.min_post_score),
        ("meeting_length", F.length(F.coalesce(F.col("selftext"), F.lit(""))) >= p.min_post_length),
        ("ai_relevant", S.relevance("title", "selftext", p.relevance_terms, p.cuts) if p.relevance_check else F.lit(True)),
    ]


def ingest_examined(items: DataFrame, p: P.IngestParams) -> DataFrame:
    """Newest N posts per community (the listing the original pages through)."""
    posts = items.filter(F.col("type") == "post")
    if p.communities:
        posts = posts.filter(F.col("subreddit").isin(*p.communities))
    return WN.newest_per_group(posts, "subreddit", p.newest_per_community)


def ingest_accepted(examined: DataFrame, p: P.IngestParams) -> DataFrame:
    acc = flt.all_of(pred for _, pred in ingest_stages(p))
    # hash is taken on the uncut text, then required fields checked
    return flt.flt_required_fields(PR.prj_content_hash(examined.filter(acc)))


def ingest_candidates(items: DataFrame, p: P.IngestParams = P.IngestParams()):
    """(accepted posts with n_items / num_comments, their comments, the quality predicate)."""
    examined = ingest_examined(items, p)
    accepted = ingest_accepted(examined, p)
    if p.newest_per_community is not None:  # a bounded listing, joined three times: its posts' texts are read and shuffled once
        accepted = cut_lineage(accepted)
    linked = J.join_comments_of_accepted(accepted, items.filter(F.col("type") == "comment"))
    quality = flt.comment_quality(p.min_comment_score, p.min_comment_length)
    counts = linked.groupBy(F.col("post_id").alias("_pid")).agg(
        F.count(F.lit(1)).alias("num_comments"), F.count_if(quality).alias("_kept"))
    posts_n = (accepted.join(counts, accepted.id == counts._pid, "left")
               .withColumn("num_comments", F.coalesce("num_comments", F.lit(0)).cast("bigint"))
               .withColumn("n_items", F.lit(1) + F.coalesce("_kept", F.lit(0)))
               .drop("_pid", "_kept"))
    return posts_n, linked, quality


def examined_communities(items: DataFrame, p: P.IngestParams) -> DataFrame:
    """(subreddit) the configured list, or every community with posts."""
    if p.communities:
        return items.sparkSession.createDataFrame([(c,) for c in p.communities], "subreddit string")
    return items.filter(F.col("type") == "post").select("subreddit").distinct()


def ingest_collect(items: DataFrame, p: P.IngestParams = P.IngestParams()) -> DataFrame:
    """Accepted posts with their quality comments, cut to the item budget, sanitized."""
    posts_n, linked, quality = ingest_candidates(items, p)
    # the batch's posts are written as posts and joined to their comments: materialise them (with a
    # budget, a few rows) instead of ranking and joining twice
    kept_posts = cut_lineage(WN.item_budget(posts_n, p.budget, community_rank(p.communities)))
    kept_comments = (flt.flt_required_fields(PR.prj_content_hash(linked.filter(quality)))
                     .join(kept_posts.select(F.col("id").alias("post_id")), "post_id", "left_semi"))
    batch = kept_posts.select(*[c for c in BATCH_COLUMNS if c in kept_posts.columns]).unionByName(
        kept_comments.select(*[c for c in BATCH_COLUMNS if c in kept_comments.columns]), allowMissingColumns=True)
    return PR.prj_sanitize(batch).select(*BATCH_COLUMNS)


def ingest_funnel(items: DataFrame, p: P.IngestParams = P.IngestParams()) -> DataFrame:
    return A.agg_filter_funnel(ingest_examined(items, p), ingest_stages(p))


def ingest_mark(items: DataFrame, p: P.IngestParams = P.IngestParams()) -> DataFrame:
    """New high-water mark: newest created_utc past the old mark among examined posts."""
    return A.agg_hwm(ingest_examined(items, p), p.mark)


@dataclass
class IngestResult:
    batch: DataFrame
    manifest: DataFrame
    funnel: DataFrame
    mark: DataFrame


def job_ingest(items: DataFrame, p: P.IngestParams = P.IngestParams()) -> IngestResult:
    batch = ingest_collect(items, p)
    return IngestResult(batch, A.agg_batch_manifest(batch, p.batch_timestamp, p.keywords, examined_communities(items, p)),
                        ingest_funnel(items, p), ingest_mark(items, p))


# ------------------------------------------------------------------------------ enrich

def job_enrich(raw_items: DataFrame, lexicon: P.Lexicon = P.Lexicon(), cues: tuple = L.RULE_CUES,
               classifier_enabled: bool = True, model=None) -> DataFrame:
    """Raw items -> enriched rows: pipeline text, drop empty, sentiment + content type in place. With
    a trained ``model`` (``ml.load_model``) its prediction is the content type, else the cue words'."""
    d = raw_items.withColumn("_text", PR.pipeline_text())
    d = flt.flt_nonempty_text(d, "_text")
    if model is None or not classifier_enabled:
        return S.score_columns(d, F.col("_text"), sentiment_out="sentiment", content_out="content_type",
                               lexicon=lexicon, cues=cues, classifier_enabled=classifier_enabled).drop("_text")
    d = S.score_columns(d, F.col("_text"), sentiment_out="sentiment", lexicon=lexicon)
    p = ML.ml_predict(model, d.select(F.struct(*[c for c in d.columns if c not in ("_text", "content_type")]).alias("_row"), F.col("_text").alias("text")))
    pred = F.struct("predicted_class", "confidence", "probabilities")
    stored = S.class_fallback(S.class_result(pred), S.scoring_error(F.col("text")))
    return p.select("_row.*", stored.alias("content_type"))


# ------------------------------------------------------------------------------ dashboard

@dataclass
class Dashboard:
    trend: DataFrame
    recent: DataFrame


def job_dashboard(enriched: DataFrame, p: P.DashboardParams = P.DashboardParams()) -> Dashboard:
    import re
    if not (p.ticker in ("", "ALL") or (len(p.ticker) <= P.API_TICKER_MAX_LENGTH
                                        and re.match(P.API_TICKER_PATTERN, p.ticker.upper()))):
        raise ValueError(P.INVALID_TICKER_API)
    if p.item_type not in P.API_ITEM_TYPES:
        raise ValueError(P.INVALID_TYPE_API)
    return Dashboard(A.agg_trend(enriched, p.ticker, p.item_type, with_content=True),
                     top_recent(enriched, p.ticker, p.item_type))


DASHBOARD_DOC = ("trend_data array<struct<post_date:string,sentiment_type:string,post_count:bigint>>, "
                 "posts_data array<struct<display_text:string,subreddit:string,sentiment_type:string,url:string,type:string>>, "
                 "metadata struct<ticker:string,content_type:string,timestamp:bigint>")


def dashboard_doc(d: Dashboard, p: P.DashboardParams = P.DashboardParams()) -> DataFrame:
    """One JSON document: trend rows (one per day and sentiment, newest day first), recent rows and
    metadata. Built from the two small results (days x labels and 20 rows), never from raw rows;
    unknown sentiments are written as nulls."""
    by_day = d.trend.groupBy("post_date", "sentiment_type").agg(F.sum("post_count").alias("post_count"))
    t = by_day.select(F.struct(F.col("post_date").cast("string").alias("post_date"), "sentiment_type", "post_count").alias("_t"))
    fields = ["display_text", "subreddit", "sentiment_type", "url", "type"]
    r = d.recent.select(F.lit(None).cast(t.schema["_t"].dataType).alias("_t"),
                        F.struct((-F.col("created_utc")).alias("k"), F.col("id").alias("k2"), *fields).alias("_r"))
    t = t.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))
    # one small union, one aggregate: both lists land in the same single row (collect_list skips nulls),
    # sorted so the document does not depend on task order
    doc = t.unionByName(r).agg(F.reverse(F.array_sort(F.collect_list("_t"))).alias("trend_data"),
                               F.transform(F.array_sort(F.collect_list("_r")),
                                           lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("posts_data"))
    meta = F.struct(F.lit(p.ticker).alias("ticker"), F.lit(p.item_type).alias("content_type"),
                    F.lit(int(p.as_of)).alias("timestamp"))
    return doc.select(F.size("trend_data").alias("trend_rows"), F.size("posts_data").alias("recent_rows"),
                      F.to_json(F.struct("trend_data", "posts_data", meta.alias("metadata")), {"ignoreNullFields": "false"}).alias("doc"))


# ------------------------------------------------------------------------------ search

def search_collect(items: DataFrame, p: P.SearchParams = P.SearchParams()) -> DataFrame:
    """Collected search items in collection order columns, before scoring."""
    hours = P.TIMEFRAME_HOURS.get(p.timeframe, P.TIMEFRAME_DEFAULT_HOURS)
    ticker = p.ticker.strip().upper()
    posts = items.filter(F.col("type") == "post")
    if p.communities:
        posts = posts.filter(F.col("subreddit").isin(*p.communities))
    posts = WN.newest_per_group(posts, "subreddit", p.newest_per_community)
    posts = flt.flt_timeframe(posts, hours, p.as_of)
    posts = posts.filter(F.contains(flt.post_text(), F.lit(ticker.lower())))
    posts = posts.filter(~flt.has_ignored(p.ignore_keywords) & (F.col("score") >= p.min_post_score)
                         & (F.length(F.coalesce(F.col("selftext"), F.lit(""))) >= p.min_post_length))
    linked = J.join_comments_of_accepted(posts, items.filter(F.col("type") == "comment"))
    totals = linked.groupBy(F.col("post_id").alias("_tid")).agg(F.count(F.lit(1)).alias("num_comments"))
    comments = WN.comment_cap(linked, p.comments_per_post)
    comments = comments.filter(flt.comment_quality(p.min_comment_score, p.min_comment_length))
    counts = comments.groupBy(F.col("post_id").alias("_pid")).agg(F.count(F.lit(1)).alias("_kept"))
    posts_n = (posts.join(counts, posts.id == counts._pid, "left").join(totals, posts.id == totals._tid, "left")
               .withColumn("num_comments", F.coalesce("num_comments", F.lit(0)).cast("bigint"))
               .withColumn("n_items", F.lit(1) + F.coalesce("_kept", F.lit(0))).drop("_pid", "_kept", "_tid"))
    kept = cut_lineage(WN.item_budget(posts_n, p.budget, community_rank(p.communities)))  # at most ``budget`` posts
    post_order = kept.select(F.col("id").alias("_op"), F.col("created_utc").alias("_oc"))
    kept_c = (comments.join(post_order, comments.post_id == post_order._op, "inner")
              .withColumn("_post_created", F.col("_oc")).withColumn("_post_id", F.col("post_id"))
              .withColumn("_is_comment", F.lit(1)).drop("_op", "_oc"))
    kept_p = (kept.withColumn("_post_created", F.col("created_utc")).withColumn("_post_id", F.col("id"))
              .withColumn("_is_comment", F.lit(0)).withColumn("comment_rank", F.lit(0)))
    cols = ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit", "created_utc", "score",
            "num_comments", "_post_created", "_post_id", "_is_comment", "comment_rank"]
    return kept_p.select(*[c for c in cols if c in kept_p.columns]).unionByName(
        kept_c.select(*[c for c in cols if c in kept_c.columns]), allowMissingColumns=True)


def search_score(collected: DataFrame, lexicon: P.Lexicon = P.Lexicon(), rejects: str | None = None,
                 cut: int | None = None) -> DataFrame:
    """Search text -> sentiment; blank text drops the item, a scorer error keeps it unscored."""
    d = collected.withColumn("_st", PR.search_text(cut))
    d = d.filter(flt.py_strip(F.col("_st")) != "")
    d = S.score_columns(d.withColumn("sentiment_error", S.scoring_error(F.col("_st"), rejects)), F.col("_st"),
                        sentiment_out="_s", lexicon=lexicon)
    return d.withColumn("sentiment", F.when(F.col("sentiment_error").isNull(), F.col("_s"))).drop("_st", "_s")


def collection_order(communities=None) -> list[Column]:
    rank = community_rank(communities)
    first = [rank] if rank is not None else []
    return first + [F.col("subreddit"), F.col("_post_created").desc(), F.col("_post_id"), F.col("_is_comment"),
                    F.col("comment_rank")]


@dataclass
class SearchResult:
    items: DataFrame
    summary: DataFrame
    sample: DataFrame


def job_search(items: DataFrame, p: P.SearchParams = P.SearchParams(), lexicon: P.Lexicon = P.Lexicon()) -> SearchResult:
    import re
    t = (p.ticker or "").strip().upper()
    if not re.match(P.SEARCH_TICKER_PATTERN, t):
        raise ValueError(P.INVALID_TICKER_SEARCH)
    scored = search_score(search_collect(items, p), lexicon, p.rejects, p.cuts.search)
    sample = scored.orderBy(*collection_order(p.communities)).limit(P.SEARCH_SAMPLE_SIZE)
    return SearchResult(scored, A.agg_summary(scored), sample)


SEARCH_ITEM = ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit", "created_utc", "score", "num_comments"]


def search_doc(r: SearchResult, p: P.SearchParams = P.SearchParams()) -> DataFrame:
    """Response document: ticker, timeframe, summary and the first 20 items with all their fields (or
    the no-results form). Fields an item lacks (a comment's title, the sentiment of an item that could
    not be scored) are left out of it, as in the original."""
    rank = community_rank(p.communities)
    keys = [(rank if rank is not None else F.lit(0)).alias("k0"), F.col("subreddit").alias("k1"),
            (-F.col("_post_created")).alias("k2"), F.col("_post_id").alias("k3"), F.col("_is_comment").alias("k4"),
            F.col("comment_rank").alias("k5")]
    sample = r.sample.select(F.struct(*keys, *SEARCH_ITEM, "sentiment").alias("_d"))
    breakdown = F.struct(*[F.col(lab.lower()).alias(lab) for lab in P.SENTIMENTS]).alias("sentiment_breakdown")
    summ = r.summary.select(F.struct("total_items", "posts", "comments", breakdown, "average_score",
                                     "timeframe_coverage").alias("_s"))
    both = (summ.select("_s", F.lit(None).cast(sample.schema["_d"].dataType).alias("_d"))
            .unionByName(sample.select(F.lit(None).cast(summ.schema["_s"].dataType).alias("_s"), "_d")))
    # the first 20 items in collection order, whatever order the tasks delivered them in
    data = F.transform(F.array_sort(F.collect_list("_d")), lambda x: F.struct(*[x[f].alias(f) for f in [*SEARCH_ITEM, "sentiment"]]))
    doc = both.agg(F.first("_s", ignorenulls=True).alias("_s"), data.alias("data")).select(F.col("_s.*"), "data")
    msg = F.when(F.col("total_items") == 0, F.lit(P.NO_RESULTS_MESSAGE))
    return doc.select("total_items", F.to_json(F.struct(
        F.lit(p.ticker.strip().upper()).alias("ticker"), F.lit(p.timeframe).alias("timeframe"),
        F.when(F.col("total_items") > 0, F.date_format(F.timestamp_seconds(F.lit(p.as_of)), "yyyy-MM-dd'T'HH:mm:ss"))
         .alias("timestamp"), msg.alias("message"),
        F.struct("total_items", "posts", "comments", "sentiment_breakdown", "average_score",
                 "timeframe_coverage").alias("summary"),
        "data")).alias("doc"))


# ------------------------------------------------------------------------------ extraction / labeling

def job_extract_training(enriched: DataFrame, limit: int = P.EXTRACT_LIMIT) -> DataFrame:
    return L.training_rows(enriched, limit)


@dataclass
class LabelRun:
    table: DataFrame
    stats: DataFrame
    distribution: DataFrame


def job_label(table_df: DataFrame, run_timestamp: str, cues: tuple = L.RULE_CUES, cut: int | None = None) -> LabelRun:
    out = L.lbl_ai_label(table_df, run_timestamp, cues, cut)
    stats = A.agg_label_run_stats(out.filter("processed_this_run"))
    return LabelRun(out.drop("processed_this_run"), stats, A.agg_label_distribution(out))
