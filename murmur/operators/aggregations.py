"""Rollups. Each is one hash aggregate (partial aggregation before the shuffle, so a hot
community or day only sends one partial row per map task). Averages are rounded to six places so
two engines agree bit-for-bit on the checked output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.operators import filters as flt
from murmur.operators.projections import combined_class, post_date

ROUND = 6


def r6(c: Column, places: int = ROUND) -> Column:
    """Round in two steps (9 places, then ``places``, HALF_UP) so summation-order noise in the
    last bits cannot flip a decimal tie."""
    return F.round(F.round(c, 9), places)


def ravg(c, name: str) -> Column:
    return r6(F.avg(c)).alias(name)


def agg_trend(df: DataFrame, ticker: str = "ALL", item_type: str = "all", with_content: bool = False) -> DataFrame:
    """(day, sentiment) -> count after the ticker / type filter; null sentiment is its own group."""
    d = flt.flt_item_type(flt.flt_ticker(df, ticker), item_type)
    keys = [post_date().alias("post_date"), F.col("sentiment.Sentiment").alias("sentiment_type")]
    if with_content:
        keys.append(F.col("content_type.Classification").alias("content_type"))
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("post_count"))


def agg_sentiment_by_community(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("subreddit"), post_date().alias("post_date"),
                      F.col("sentiment.Sentiment").alias("sentiment_type")).agg(
        F.count(F.lit(1)).alias("post_count"))


def agg_dual_class(df: DataFrame) -> DataFrame:
    """(community, day, sentiment, content type) -> count and average scores; classified rows."""
    return (flt.flt_classified(df, exclude_unknown=True)
            .groupBy(F.col("subreddit"), post_date().alias("post_date"),
                     F.col("sentiment.Sentiment").alias("sentiment_type"),
                     F.col("content_type.Classification").alias("content_type"))
            .agg(F.count(F.lit(1)).alias("post_count"),
                 ravg("sentiment.SentimentScore.Positive", "avg_positive_score"),
                 ravg("sentiment.SentimentScore.Negative", "avg_negative_score"),
                 ravg("sentiment.SentimentScore.Neutral", "avg_neutral_score"),
                 ravg("content_type.Confidence", "avg_content_type_confidence")))


def agg_content_trends(df: DataFrame) -> DataFrame:
    return (flt.flt_confident(df)
            .groupBy(F.col("subreddit"), post_date().alias("post_date"),
                     F.col("content_type.Classification").alias("content_type"))
            .agg(F.count(F.lit(1)).alias("post_count"),
                 ravg("content_type.Confidence", "avg_confidence"),
                 ravg("content_type.Probabilities.Informative", "avg_informative_prob"),
                 ravg("content_type.Probabilities.Emotional", "avg_emotional_prob"),
                 ravg("score", "avg_post_score")))


def agg_company_combined(df: DataFrame, ticker: str, aliases) -> DataFrame:
    """Company rollup: alias match on title / body (posts keep selftext, so they match by title),
    classified rows, grouped by day x sentiment x content type; combined label on the keys."""
    d = flt.flt_classified(flt.flt_company_alias(df, aliases))
    g = (d.groupBy(post_date().alias("post_date"), F.col("sentiment.Sentiment").alias("sentiment_type"),
                   F.col("content_type.Classification").alias("content_type"))
         .agg(F.count(F.lit(1)).alias("post_count"),
              ravg("score", "avg_post_score"),
              ravg("sentiment.SentimentScore.Positive", "avg_positive_sentiment"),
              ravg("sentiment.SentimentScore.Negative", "avg_negative_sentiment"),
              ravg("content_type.Confidence", "avg_content_confidence")))
    return g.select(F.lit(ticker).alias("ticker"), "*",
                    combined_class(F.col("sentiment_type"), F.col("content_type")).alias("combined_classification"))


def zero_filled(counts: DataFrame, key: str, fixed: list[str], value: str = "total",
                keep_others: bool = True) -> DataFrame:
    """Totals per label with the fixed labels always present (0 when absent). The fixed frame is a
    handful of literal rows, so joining it is a broadcast of a proven-small side."""
    spark = counts.sparkSession
    base = spark.createDataFrame([(k,) for k in fixed], f"{key} string")
    j = base.join(counts, key, "full" if keep_others else "left")
    return j.select(key, F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value))


def agg_sentiment_totals(trend: DataFrame) -> DataFrame:
    """Sentiment -> total over trend rows; POSITIVE / NEGATIVE / NEUTRAL always present."""
    t = trend.groupBy("sentiment_type").agg(F.sum("post_count").alias("total"))
    return zero_filled(t, "sentiment_type", P.CHART_SENTIMENTS)


def agg_content_totals(trend: DataFrame) -> DataFrame:
    t = (trend.filter(F.col("content_type").isNotNull())
         .groupBy("content_type").agg(F.sum("post_count").alias("total")))
    return zero_filled(t, "content_type", P.CONTENT_TYPES)


def agg_combined_totals(trend: DataFrame) -> DataFrame:
    t = (trend.filter(F.col("content_type").isNotNull())
         .groupBy(F.concat_ws("_", "sentiment_type", "content_type").alias("combined"))
         .agg(F.sum("post_count").alias("total")))
    return zero_filled(t, "combined", P.COMBINED_LABELS, keep_others=False)


def agg_trend_pivot(trend: DataFrame) -> DataFrame:
    """Day x {Positive, Negative, Neutral} counts, missing -> 0. Fixed pivot values skip the
    extra distinct-values job."""
    # the plan Catalyst makes for pivot with fixed values (conditional sums), kept as one aggregate so
    # days holding none of the three labels still get their zero row without a second pass + join
    return trend.groupBy("post_date").agg(*[
        F.coalesce(F.sum(F.when(F.col("sentiment_type") == s, F.col("post_count"))), F.lit(0)).cast("bigint")
        .alias(s.lower()) for s in P.CHART_SENTIMENTS])


def agg_summary(df: DataFrame, sentiment_col: str = "sentiment") -> DataFrame:
    """Search summary: totals, posts, comments, average score (2 dp), span of the items in hours.
    One global aggregate (partial per task, one row to merge). Empty input -> zeros, 'No data'."""
    n = F.count(F.lit(1))
    s = F.col(f"{sentiment_col}.Sentiment")
    g = df.agg(
        n.alias("total_items"),
        F.count_if(F.col("type") == "post").alias("posts"),
        F.count_if(F.col("type") == "comment").alias("comments"),
        *[F.count_if(s == lab).alias(lab.lower()) for lab in P.SENTIMENTS],
        F.avg(F.coalesce(F.col("score"), F.lit(0))).alias("_avg"),
        F.min(F.coalesce(F.col("created_utc"), F.lit(0.0))).alias("_lo"),
        F.max(F.coalesce(F.col("created_utc"), F.lit(0.0))).alias("_hi"))
    span = (F.col("_hi") - F.col("_lo")) / 3600
    return g.select(
        "total_items", "posts", "comments", *[lab.lower() for lab in P.SENTIMENTS],
        F.coalesce(r6(F.col("_avg"), 2), F.lit(0.0)).alias("average_score"),
        F.coalesce(r6(span), F.lit(0.0)).alias("span_hours"),
        F.when(F.col("total_items") == 0, F.lit(P.NO_DATA))
         .otherwise(F.concat(F.round(F.round(span, 9).cast("decimal(38,9)"), 1).cast("string"), F.lit(" hours")))
         .alias("timeframe_coverage"))


def agg_sentiment_breakdown(df: DataFrame, sentiment_col: str = "sentiment") -> DataFrame:
    """Counts for the four labels (zero-filled); unscored items are skipped, new labels added."""
    t = (df.filter(F.col(f"{sentiment_col}.Sentiment").isNotNull())
         .groupBy(F.col(f"{sentiment_col}.Sentiment").alias("sentiment_type")).agg(F.count(F.lit(1)).alias("total")))
    return zero_filled(t, "sentiment_type", P.SENTIMENTS)


def agg_label_distribution(df: DataFrame, label: str = "informative_emotional_label") -> DataFrame:
    """Label -> count and percent of the labeled rows (informative / emotional only)."""
    g = flt.flt_labeled(df, label).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window as W
    return g.select("label", "n", r6(F.col("n") * 100.0 / F.sum("n").over(W.partitionBy())).alias("percent"))


def agg_label_run_stats(labeled_run: DataFrame) -> DataFrame:
    """Processed / labeled / needs-review counts of one labeling run."""
    lab = F.col("informative_emotional_label")
    return labeled_run.agg(F.count(F.lit(1)).alias("processed"),
                           F.count_if(lab.isin(*P.LABELS)).alias("labeled"),
                           F.count_if(lab == P.LABEL_NEEDS_REVIEW).alias("needs_review"))


def agg_batch_manifest(batch: DataFrame, timestamp: str, keywords, communities: DataFrame) -> DataFrame:
    """Batch -> total items, communities, keywords, timestamp (one row). ``communities`` (subreddit):
    those the run was configured for and went through, whether or not they gave items."""
    rows = batch.select(F.lit(1).alias("n"), F.lit(None).cast("string").alias("subreddit")).unionByName(
        communities.select(F.lit(0).alias("n"), "subreddit").distinct())
    return rows.agg(F.sum("n").alias("total_items"), F.array_sort(F.collect_set("subreddit")).alias("processed_subreddits")).select(
        F.lit(timestamp).alias("timestamp"), F.coalesce("total_items", F.lit(0)).cast("bigint").alias("total_items"),
        "processed_subreddits", F.array(*[F.lit(k) for k in keywords]).alias("keywords"))


def agg_hwm(df: DataFrame, mark: float | None) -> DataFrame:
    """Newest created_utc among rows at or past the mark, before any other filter."""
    return flt.flt_hwm(df, mark).agg(F.max("created_utc").alias("new_mark"),
                                     F.count(F.lit(1)).alias("rows_past_mark"))


def agg_filter_funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Per community cumulative counts: each stage counts rows passing it and every earlier one."""
    acc, cols = F.lit(True), []
    for name, pred in stages:
        acc = acc & pred
        cols.append(F.count_if(acc).alias(name))
    return df.groupBy("subreddit").agg(F.count(F.lit(1)).alias("examined"), *cols)
