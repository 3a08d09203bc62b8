"""Sorts and limits. ORDER BY + LIMIT plans as TakeOrderedAndProject: a per-task top-N and one
bounded merge, never a global sort. ``id`` breaks every tie so the result is deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.operators import filters as flt
from murmur.operators.projections import display_text


def top_recent(enriched: DataFrame, ticker: str = "ALL", item_type: str = "all", n: int = P.RECENT_ROWS) -> DataFrame:
    d = flt.flt_item_type(flt.flt_ticker(enriched, ticker), item_type)
    return (d.orderBy(F.col("created_utc").desc(), F.col("id")).limit(n)
            .select("id", display_text().alias("display_text"), "subreddit",
                    F.col("sentiment.Sentiment").alias("sentiment_type"), "url", "type", "created_utc"))


def srt_rollup(rollup: DataFrame) -> DataFrame:
    """Presentation order: day desc, community, count desc. Only at the final sink: a range
    shuffle anywhere earlier would be wasted."""
    return rollup.orderBy(F.col("post_date").desc(), F.col("subreddit"), F.col("post_count").desc())
