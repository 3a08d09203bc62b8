"""Items (posts + comments) built from the driver tables.

The same rows are produced by the SQL in ``murmur.plans.oracle_sql.ADAPTER`` so DuckDB can
check every query. Posts come from ``documents`` joined to ``events`` (time, score) and
``labels`` (stand-in sentiment); comments are ``conversations`` turns of the post with the same
id. ``enriched`` nests the stand-in scores the way the enrichment job stores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.sources.tables import table

ITEM_COLUMNS = ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit",
                "created_us", "created_utc", "score", "sentiment_type", "positive", "negative",
                "content_type", "confidence"]


def _ratio(c: Column, m: int = 101) -> Column:
    return (c % m).cast("double") / 100


def _post_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The events that are a document's (event_id = 5 * doc_id), by doc_id: documents, labels and comments
    are joined on the same column, so whole texts are shuffled once, and other events not at all."""
    e = table(spark, sf_dir, "events")
    return e.filter(F.col("event_id") % 5 == 0).select(F.expr("event_id div 5").alias("doc_id"), *columns)


def posts(spark: SparkSession, sf_dir: str, keep_doc_id: bool = False) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    e = _post_events(spark, sf_dir, "ts", "value")
    # labels holds one row per document; saying so with a keyed aggregate (a no-op on these values)
    # lets Catalyst drop the whole join from queries that use no label column
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"),
                                                              F.max("toxic").alias("toxic"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    doc = F.col("doc_id").cast("string")
    j = d.join(e, "doc_id", "inner").join(lab, "doc_id", "left")
    cols = [
        F.lit("post").alias("type"),
        F.concat(F.lit("p"), doc).alias("id"),
        F.lit(None).cast("string").alias("post_id"),
        F.replace("text", F.lit("\n"), F.lit(" ")).alias("title"),
        F.col("text").alias("selftext"),
        F.lit(None).cast("string").alias("body"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://example.com/"), "source", F.lit("/"), doc))
         .otherwise(F.concat(F.lit("/r/"), "source", F.lit("/"), doc)).alias("url"),
        F.col("source").alias("subreddit"),
        us.alias("created_us"),
        (us.cast("double") / 1000000).alias("created_utc"),
        F.floor("value").cast("bigint").alias("score"),
        F.when(F.col("toxic") == 1, "NEGATIVE").when(F.col("quality") == 1, "POSITIVE")
         .when(F.col("quality") == 0, "NEUTRAL").alias("sentiment_type"),
        _ratio(F.col("doc_id")).alias("positive"),
        _ratio(F.col("doc_id") * 7).alias("negative"),
        F.when(F.col("doc_id") % 10 == 0, "UNKNOWN").when(F.col("doc_id") % 10 == 1, "DISABLED")
         .when(F.col("n_chars") >= 1500, "INFORMATIVE").otherwise("EMOTIONAL").alias("content_type"),
        ((F.col("doc_id") % 50 + 50).cast("double") / 100).alias("confidence"),
    ]
    if keep_doc_id:
        cols.append(F.col("doc_id"))
    return j.select(*cols)


def post_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a comment takes from its post: id, url, community, time. Only documents x events:
    the labels join of ``posts`` is on a key of ``labels`` (one row per document), so leaving it
    out changes no row, and saves a full join at scale."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    e = _post_events(spark, sf_dir, "ts")
    doc = F.col("doc_id").cast("string")
    return d.join(e, "doc_id", "inner").select(
        "doc_id", F.concat(F.lit("p"), doc).alias("id"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://example.com/"), "source", F.lit("/"), doc))
         .otherwise(F.concat(F.lit("/r/"), "source", F.lit("/"), doc)).alias("url"),
        F.col("source").alias("subreddit"), F.unix_micros(F.col("ts").cast("timestamp")).alias("created_us"))


def comments(spark: SparkSession, sf_dir: str, post_df: DataFrame | None = None) -> DataFrame:
    p = (post_df if post_df is not None else post_keys(spark, sf_dir)).select(
        "doc_id", F.col("id").alias("p_id"), F.col("url").alias("p_url"),
        F.col("subreddit").alias("p_sub"), F.col("created_us").alias("p_us"))
    v = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # equi-join on the numeric key (id = 'p' || doc_id), not on the derived string
    j = v.join(p, v.conv_id == p.doc_id, "inner")
    us = F.col("p_us") + F.lit(60000000) * (F.col("turn") + 1)
    n = F.length("text")
    return j.select(
        F.lit("comment").alias("type"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
        F.col("p_id").alias("post_id"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("selftext"),
        F.col("text").alias("body"),
        F.concat("p_url", F.lit("/"), F.col("turn").cast("string")).alias("url"),
        F.col("p_sub").alias("subreddit"),
        us.alias("created_us"),
        (us.cast("double") / 1000000).alias("created_utc"),
        (n % 40).cast("bigint").alias("score"),
        F.when(F.col("role") == "user", "NEGATIVE").when(F.col("role") == "assistant", "POSITIVE")
         .otherwise("MIXED").alias("sentiment_type"),
        _ratio(n).alias("positive"),
        _ratio(n * 7).alias("negative"),
        F.when(F.col("role") == "system", "DISABLED").when(n >= 400, "INFORMATIVE")
         .otherwise("EMOTIONAL").alias("content_type"),
        ((F.col("turn") * 5 + 50).cast("double") / 100).alias("confidence"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and comments in one frame (``type`` tells them apart)."""
    return posts(spark, sf_dir).unionByName(comments(spark, sf_dir))


def with_scores(df: DataFrame) -> DataFrame:
    """Stand-in remaining scores: neutral takes what positive and negative leave, mixed is 0."""
    return (df.withColumn("neutral", F.greatest(F.lit(0.0), F.lit(1.0) - F.col("positive") - F.col("negative")))
              .withColumn("mixed", F.lit(0.0)))


def nest(df: DataFrame) -> DataFrame:
    """Flat stand-in scores -> the stored enriched layout (CamelCase structs)."""
    df = with_scores(df)
    ct = F.col("content_type")
    conf = F.col("confidence")
    probs = F.when(ct.isin("INFORMATIVE", "EMOTIONAL"), F.struct(
        F.when(ct == "INFORMATIVE", conf).otherwise(F.lit(1.0) - conf).alias("Informative"),
        F.when(ct == "EMOTIONAL", conf).otherwise(F.lit(1.0) - conf).alias("Emotional")))
    sentiment = F.when(F.col("sentiment_type").isNotNull(), F.struct(
        F.col("sentiment_type").alias("Sentiment"),
        F.struct(F.col("positive").alias("Positive"), F.col("negative").alias("Negative"),
                 F.col("neutral").alias("Neutral"), F.col("mixed").alias("Mixed")).alias("SentimentScore")))
    content = F.struct(ct.alias("Classification"), conf.alias("Confidence"),
                       probs.alias("Probabilities"), F.lit(None).cast("string").alias("Error"))
    keep = [c for c in ["type", "id", "post_id", "title", "selftext", "body", "url", "subreddit",
                        "created_utc", "score", "content_hash"] if c in df.columns]
    return df.select(*keep, sentiment.alias("sentiment"), content.alias("content_type"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table as the rollup queries see it."""
    return nest(items(spark, sf_dir))
