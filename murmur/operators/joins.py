"""Joins hidden in the original's loops, made explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.patterns import words_in
from murmur.operators.projections import post_date


def ticker_list(spark, keywords: str | None) -> DataFrame:
    """The configured comma list -> (ticker, source): trimmed, non-blank items in list order; an
    unset list falls back to the default symbols, tagged as such."""
    from murmur import params as P
    from murmur.functions.text import split_list
    if not keywords:
        return spark.createDataFrame([(t, P.FALLBACK_SOURCE) for t in P.FALLBACK_TICKERS], "ticker string, source string")
    cfg = spark.createDataFrame([(keywords,)], "keywords string")
    return cfg.select(F.explode(split_list("keywords")).alias("ticker"), F.lit("configured").alias("source"))


def ticker_lists(configured: DataFrame) -> DataFrame:
    """Rows with a comma list (keywords) -> one row per (ticker, source): the trimmed, non-blank items,
    or the tagged default symbols where the list is unset."""
    from murmur import params as P
    from murmur.functions.text import split_list
    unset = F.coalesce(F.col("keywords"), F.lit("")) == ""
    default = F.array(*[F.lit(t) for t in P.FALLBACK_TICKERS])
    return (configured.withColumn("ticker", F.explode(F.when(unset, default).otherwise(split_list("keywords"))))
            .withColumn("source", F.when(unset, F.lit(P.FALLBACK_SOURCE)).otherwise(F.lit("configured"))))


def ticker_symbols(tickers) -> list[str]:
    return sorted({t.strip().upper() for t in tickers if t and t.strip()})


def join_ticker_mentions(items: DataFrame, tickers, columns=("title", "selftext"), match: str = "substring") -> DataFrame:
    """(item, ticker) for every ticker the item's text contains, all symbols in one pass.

    ``substring`` (the original's LIKE '%T%'): the symbols are a constant array; each item keeps
    those its bound, upper-cased texts contain, so nothing is joined or shuffled. ``tickers`` is a
    configured list. ``word``: tokenise, explode, equi-join on the token; ``tickers`` may also be
    a DataFrame (ticker) of any size, and Spark chooses the join by the size of its sides."""
    if match == "word":
        tk = tickers if isinstance(tickers, DataFrame) else items.sparkSession.createDataFrame(
            [(t,) for t in ticker_symbols(tickers)], "ticker string")
        toks = F.array_distinct(F.concat(*[F.split(F.upper(F.coalesce(F.col(c), F.lit(""))), "[^A-Z0-9.]+")
                                           for c in columns]))
        return items.select("*", F.explode(toks).alias("ticker")).join(tk.select("ticker").distinct(), "ticker", "inner")
    symbols = F.array(*[F.lit(t) for t in ticker_symbols(tickers)]).cast("array<string>")
    texts = F.array(*[F.upper(F.coalesce(F.col(c), F.lit(""))) for c in columns])
    found = F.flatten(F.transform(texts, lambda x: F.filter(symbols, lambda t: F.contains(x, t))))
    return items.select("*", F.explode(F.array_distinct(found)).alias("ticker"))


def ticker_table(tickers: DataFrame) -> DataFrame:
    """A symbol table of any size (ticker): trimmed, upper case, no blank ones."""
    return tickers.select(F.upper(F.trim("ticker")).alias("ticker")).where(F.octet_length("ticker") > 0).distinct()


def join_ticker_table(items: DataFrame, tickers: DataFrame, keep=("id",), columns=("title", "selftext"), total: str | None = None) -> DataFrame:
    """(``keep``, ticker) for every ticker of a *table* that the item's text contains (the original's
    LIKE '%T%'): an equi-join on the texts' windows of the tickers' lengths, no item x ticker loop.
    ``total``: items counted by (``keep``, ticker), in a column of this name."""
    texts = [F.upper(F.coalesce(F.col(c), F.lit(""))) for c in columns]
    return words_in(items, texts, ticker_table(tickers), list(keep), total)


def agg_mentions_trend(enriched: DataFrame, tickers) -> DataFrame:
    """(ticker, day, sentiment) -> count over all tickers at once; ``tickers``: a list, or a table."""
    if isinstance(tickers, DataFrame):
        items = enriched.select("title", "selftext", post_date().alias("post_date"), F.col("sentiment.Sentiment").alias("sentiment_type"))
        return join_ticker_table(items, tickers, ("post_date", "sentiment_type"), total="post_count").select("ticker", "post_date", "sentiment_type", "post_count")
    m = join_ticker_mentions(enriched.select("title", "selftext", "created_utc", "sentiment"), tickers)
    return m.groupBy("ticker", post_date().alias("post_date"),
                     F.col("sentiment.Sentiment").alias("sentiment_type")).agg(F.count(F.lit(1)).alias("post_count"))


def join_comments_of_accepted(accepted_posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Keep comments of accepted posts only; the community comes from the post. Spark broadcasts the
    posts when they are small in bytes; otherwise a shuffle join on post id, where AQE splits
    skewed partitions."""
    a = accepted_posts.select(F.col("id").alias("_pid"), F.col("subreddit").alias("_psub"))
    j = comments.join(a, comments.post_id == a._pid, "inner")
    return j.withColumn("subreddit", F.col("_psub")).drop("_pid", "_psub")


def join_enrichment(items: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach materialised scores (id, sentiment, content_type) to the items by id. When the
    scores are computed from the same rows, prefer the in-place projection (no join)."""
    return items.join(scores, "id", "left")


def dedup_ids(new_items: DataFrame, seen_ids: DataFrame) -> DataFrame:
    """Drop items already ingested (left anti join on id; the seen side needs no distinct)."""
    return new_items.join(seen_ids.select("id"), "id", "left_anti")

