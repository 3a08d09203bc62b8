"""Explicit schemas. JSON keys of the stored layout are CamelCase inside the score structs; an
explicit read schema must spell them exactly (a lower-case schema reads nulls)."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_ITEM = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("content_hash", T.StringType()),
])
RAW_ITEM_FIELDS = [f.name for f in RAW_ITEM.fields]

METADATA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("total_items", T.LongType()),
    T.StructField("processed_subreddits", T.ArrayType(T.StringType())),
    T.StructField("keywords", T.ArrayType(T.StringType())),
])

# A wrapped batch {metadata, data:[item]} and a bare array of items read with one schema:
# wrapped documents fill metadata/data, bare-array elements fill the item fields.
RAW_BATCH_READ = T.StructType([T.StructField("metadata", METADATA), T.StructField("data", T.ArrayType(RAW_ITEM))]
                              + list(RAW_ITEM.fields) + [T.StructField("_corrupt_record", T.StringType())])

SENTIMENT = T.StructType([
    T.StructField("Sentiment", T.StringType()),
    T.StructField("SentimentScore", T.StructType([
        T.StructField("Positive", T.DoubleType()), T.StructField("Negative", T.DoubleType()),
        T.StructField("Neutral", T.DoubleType()), T.StructField("Mixed", T.DoubleType())])),
])
CONTENT_TYPE = T.StructType([
    T.StructField("Classification", T.StringType()),
    T.StructField("Confidence", T.DoubleType()),
    T.StructField("Probabilities", T.StructType([
        T.StructField("Informative", T.DoubleType()), T.StructField("Emotional", T.DoubleType())])),
    T.StructField("Error", T.StringType()),
])
ENRICHED = T.StructType(list(RAW_ITEM.fields) + [T.StructField("sentiment", SENTIMENT),
                                                 T.StructField("content_type", CONTENT_TYPE)])

TRAINING = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("subreddit", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("created_utc", T.DoubleType()),
    T.StructField("existing_sentiment", T.StringType()),
    T.StructField("informative_emotional_label", T.StringType()),
    T.StructField("labeler", T.StringType()), T.StructField("labeling_notes", T.StringType()),
])
