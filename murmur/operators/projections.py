"""Projections: the pipeline's per-row shaping, as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions.text import cut, epoch_to_day, first, nonblank, py_collapse, split_list


def prj_sanitize(df: DataFrame) -> DataFrame:
    """Cut title / selftext / body to 500 / 10,000 / 5,000 characters (code points)."""
    out = df
    for c, n in (("title", P.SANITIZE_TITLE), ("selftext", P.SANITIZE_SELFTEXT), ("body", P.SANITIZE_BODY)):
        if c in df.columns:
            out = out.withColumn(c, F.substring(c, 1, n))
    return out


def content_hash() -> Column:
    """md5 of title+selftext (no separator) for posts, of body for comments; taken before cutting."""
    post = F.concat(F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("selftext"), F.lit("")))
    return F.md5(F.when(F.col("type") == "post", post).otherwise(F.coalesce(F.col("body"), F.lit(""))))


def prj_content_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("content_hash", content_hash())


def pipeline_text() -> Column:
    """Enrichment job: title for posts, body for comments."""
    return F.when(F.col("type") == "post", F.col("title")).when(F.col("type") == "comment", F.col("body"))


def search_text(n: int | None = None) -> Column:
    """Search job: title + ' ' + selftext for posts, body for comments; whole, or the first ``n``."""
    t = (F.when(F.col("type") == "post", F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "),
                                                   F.coalesce(F.col("selftext"), F.lit(""))))
         .when(F.col("type") == "comment", F.coalesce(F.col("body"), F.lit(""))).otherwise(F.lit("")))
    return first(t, n)


def display_text() -> Column:
    return F.when(F.col("type") == "post", F.col("title")).when(F.col("type") == "comment", F.col("body"))


def post_date() -> Column:
    return epoch_to_day("created_utc")


def prj_flatten(df: DataFrame) -> DataFrame:
    """Nested sentiment / content-type structs -> flat columns."""
    base = [c for c in ["type", "id", "subreddit", "created_utc", "score"] if c in df.columns]
    return df.select(
        *base,
        F.col("sentiment.Sentiment").alias("sentiment_type"),
        F.col("sentiment.SentimentScore.Positive").alias("sentiment_positive"),
        F.col("sentiment.SentimentScore.Negative").alias("sentiment_negative"),
        F.col("sentiment.SentimentScore.Neutral").alias("sentiment_neutral"),
        F.col("sentiment.SentimentScore.Mixed").alias("sentiment_mixed"),
        F.col("content_type.Classification").alias("content_type"),
        F.col("content_type.Confidence").alias("content_confidence"),
        F.col("content_type.Probabilities.Informative").alias("prob_informative"),
        F.col("content_type.Probabilities.Emotional").alias("prob_emotional"),
    )


def combined_class(sentiment: Column, content: Column) -> Column:
    """The six sentiment x content labels, everything else MIXED_OTHER."""
    ok = sentiment.isin(*P.CHART_SENTIMENTS) & content.isin(*P.CONTENT_TYPES)
    return F.when(ok, F.concat_ws("_", sentiment, content)).otherwise(F.lit(P.OTHER_COMBINED))


def combined_display(sentiment: Column, content: Column) -> Column:
    """Dashboard badge: SENTIMENT_CONTENT, only the sentiment when the content type is missing
    (N/A), UNKNOWN or DISABLED; missing sentiment shows UNKNOWN."""
    s = F.coalesce(nonblank(sentiment), F.lit(P.UNKNOWN))
    c = F.coalesce(nonblank(content), F.lit(P.MISSING_CONTENT_TYPE))
    return F.when(c.isin(P.MISSING_CONTENT_TYPE, P.UNKNOWN, P.DISABLED), s).otherwise(F.concat(s, F.lit("_"), c))


def truncate_display(text: Column, fallback: Column | None = None, n: int = P.DISPLAY_CUT) -> Column:
    """First 100 characters + '...' when longer; empty falls back to the title, then 'No content'."""
    t = nonblank(text)
    if fallback is not None:
        t = F.coalesce(t, nonblank(fallback))
    t = F.coalesce(t, F.lit(P.NO_CONTENT))
    return cut(t, n, "...")


def absolute_url(url: Column, host: str = P.SITE_HOST) -> Column:
    """Prefix the site host when the URL does not start with http; null / empty stay as they are."""
    return F.when((url.isNull()) | (url == "") | url.startswith("http"), url).otherwise(F.concat(F.lit(host), url))


def relative_age(ts_seconds: Column, as_of: float) -> Column:
    """'Nd ago' / 'Nh ago' / 'Nm ago' with floors, like the dashboard helper."""
    diff = F.lit(float(as_of)) - ts_seconds
    hours = F.floor(diff / 3600)
    days = F.floor(hours / 24)
    mins = F.floor(diff / 60)
    return (F.when(days > 0, F.concat(days.cast("string"), F.lit("d ago")))
            .when(hours > 0, F.concat(hours.cast("string"), F.lit("h ago")))
            .otherwise(F.concat(mins.cast("string"), F.lit("m ago"))))


def clean_text(text: Column, n: int = P.CLEAN_TEXT_CUT) -> Column:
    """Collapse whitespace runs (Python's set), strip, cut at 1,000 + '...'."""
    return cut(py_collapse(text), n, "...")


def training_text() -> Column:
    """Extraction picks title for posts, body otherwise (posts store selftext, not body)."""
    return F.when(F.col("type") == "post", F.coalesce(F.col("title"), F.lit(""))).otherwise(
        F.coalesce(F.col("body"), F.lit("")))


def prj_training_row(df: DataFrame, text: str = "text") -> DataFrame:
    """Training record with three empty label columns; blank sentiment -> UNKNOWN."""
    return df.select(
        F.col("id"), clean_text(F.col(text)).alias("text"), F.col("subreddit"), F.col("type"),
        F.col("score"), F.col("created_utc"),
        F.coalesce(nonblank(F.col("sentiment.Sentiment")), F.lit("UNKNOWN")).alias("existing_sentiment"),
        F.lit("").alias("informative_emotional_label"), F.lit("").alias("labeler"),
        F.lit("").alias("labeling_notes"))


def timeframe_hours(tf: Column) -> Column:
    """1h..30d -> hours; anything else -> 24."""
    m = F.create_map(*[x for k, v in P.TIMEFRAME_HOURS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, tf), F.lit(P.TIMEFRAME_DEFAULT_HOURS))


def label_index(label: Column) -> Column:
    return F.when(label == P.LABELS[0], F.lit(0)).when(label == P.LABELS[1], F.lit(1))


def index_label(idx: Column) -> Column:
    return F.when(idx == 0, F.lit(P.LABELS[0])).when(idx == 1, F.lit(P.LABELS[1]))


def prj_split_list(df: DataFrame, s: str, out: str = "item") -> DataFrame:
    """Comma list column -> one row per trimmed, non-blank item (with its position)."""
    return df.select("*", F.posexplode(split_list(s)).alias(f"{out}_pos", out))
