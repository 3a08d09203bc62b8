"""Predicates. Each returns a filtered DataFrame; predicates are plain Columns so Catalyst can
combine them, push the simple ones (comparisons, IsNotNull, partition columns) into the scan
and keep the text tests in the same codegen stage."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.functions.patterns import AUTOMATON_BYTES, holds_any, words_in
from murmur.functions.text import all_of, any_of, contains_any, py_strip

def post_text() -> Column:
    """lower(title + " " + selftext), the text the keyword tests read."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("selftext"), F.lit(""))))


# --- ingest / search predicates (raw items) -------------------------------------------------

def since_mark(mark: float | None) -> Column:
    """Keep created_utc >= mark (the original skips strictly older rows); no mark keeps all."""
    return F.lit(True) if mark is None else F.col("created_utc") >= F.lit(float(mark))


def flt_hwm(df: DataFrame, mark: float | None) -> DataFrame:
    return df.filter(since_mark(mark))


def has_keyword(keywords: Iterable[str], match: str = "substring") -> Column:
    return contains_any(post_text(), [k.lower() for k in keywords], match)


def flt_keyword_any(df: DataFrame, keywords, match: str = "substring") -> DataFrame:
    return df.filter(has_keyword(keywords, match))


def flt_keyword_table(df: DataFrame, words: DataFrame, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``flt_keyword_any`` with the words of a table (one column): one pass over the texts by an automaton
    while the list has at most ``limit`` bytes, beyond it a semi join with the window index (by ``id``)."""
    word = words.columns[0]
    words = words.select(F.lower(word).alias("word")).where(F.octet_length("word") > 0).distinct()
    if (words.agg(F.sum(F.octet_length("word"))).first()[0] or 0) <= limit:
        return df.filter(holds_any(post_text(), [r[0] for r in words.collect()], df.sparkSession))
    return df.join(words_in(df, [post_text()], words, ["id"]).select("id"), "id", "left_semi")


def has_ignored(words: Iterable[str]) -> Column:
    return contains_any(post_text(), [w.lower() for w in words if w])


def flt_ignore_any(df: DataFrame, words) -> DataFrame:
    return df.filter(~has_ignored(words))


def flt_post_score(df: DataFrame, min_score: int = P.INGEST_MIN_POST_SCORE) -> DataFrame:
    return df.filter(F.col("score") >= min_score)


def flt_post_length(df: DataFrame, min_length: int = P.INGEST_MIN_POST_LENGTH) -> DataFrame:
    return df.filter(F.length(F.coalesce(F.col("selftext"), F.lit(""))) >= min_length)


def comment_quality(min_score: int, min_length: int) -> Column:
    return (F.col("score") >= min_score) & (F.length(F.coalesce(F.col("body"), F.lit(""))) >= min_length)


def flt_comment_quality(df: DataFrame, min_score: int = P.INGEST_MIN_COMMENT_SCORE,
                        min_length: int = P.INGEST_MIN_COMMENT_LENGTH) -> DataFrame:
    return df.filter(comment_quality(min_score, min_length))


def flt_relevance(df: DataFrame, enabled: bool = True, terms=P.RELEVANCE_TERMS) -> DataFrame:
    """Relevance check (switchable). The rule scorer is Catalyst, so it sits after the cheap filters."""
    return df.filter(S.relevance("title", "selftext", terms)) if enabled else df


REQUIRED_FIELDS = ["type", "id", "subreddit", "created_utc", "score"]


def flt_required_fields(df: DataFrame) -> DataFrame:
    return df.filter(all_of(F.col(c).isNotNull() for c in REQUIRED_FIELDS))


def flt_nonempty_text(df: DataFrame, text: str = "text", blank_trimmed: bool = False) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return df.filter((py_strip(t) if blank_trimmed else t) != "")


# --- dashboard / API predicates ---------------------------------------------------------------

def mentions_ticker(ticker: str, columns=("title", "selftext")) -> Column:
    """UPPER(col) contains the ticker for any column (comments have neither title nor selftext,
    so with the default columns they never match)."""
    t = ticker.upper()
    return any_of(F.coalesce(F.contains(F.upper(F.col(c)), F.lit(t)), F.lit(False)) for c in columns)


def flt_ticker(df: DataFrame, ticker: str = "ALL", columns=("title", "selftext")) -> DataFrame:
    if not ticker or ticker.upper() == "ALL":
        return df
    return df.filter(mentions_ticker(ticker, columns))


def flt_company_alias(df: DataFrame, aliases: Iterable[str], columns=("title", "body")) -> DataFrame:
    return df.filter(any_of(mentions_ticker(a, columns) for a in aliases))


def flt_item_type(df: DataFrame, item_type: str = "all") -> DataFrame:
    t = P.API_ITEM_TYPES[item_type]
    return df if t is None else df.filter(F.col("type") == t)


def flt_timeframe(df: DataFrame, hours: Column | int, as_of: float) -> DataFrame:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return df.filter(F.col("created_utc") >= F.lit(float(as_of)) - h * 3600)


# --- enriched-table predicates -------------------------------------------------------------------

def classified(exclude_unknown: bool = False) -> Column:
    c = F.col("content_type.Classification")
    p = F.col("sentiment.Sentiment").isNotNull() & c.isNotNull() & (c != "DISABLED")
    return p & (c != "UNKNOWN") if exclude_unknown else p


def flt_classified(df: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    return df.filter(classified(exclude_unknown))


def flt_confident(df: DataFrame, min_confidence: float = P.CONFIDENT_MIN) -> DataFrame:
    c = F.col("content_type.Classification")
    return df.filter(c.isNotNull() & c.isin(*P.CONTENT_TYPES)
                     & (F.col("content_type.Confidence") >= min_confidence))


def flt_extraction(df: DataFrame, min_score: int = P.EXTRACT_MIN_SCORE,
                   min_length: int = P.EXTRACT_MIN_LENGTH) -> DataFrame:
    """score >= min and the type's text long enough and sentiment known (posts are measured by
    title, comments by body)."""
    long_enough = (((F.col("type") == "post") & (F.length("title") >= min_length))
                   | ((F.col("type") == "comment") & (F.length("body") >= min_length)))
    return df.filter((F.col("score") >= min_score) & long_enough
                     & F.col("sentiment.Sentiment").isNotNull())


def flt_labelable(df: DataFrame, text: str = "text", min_chars: int = P.LABELABLE_MIN_CHARS) -> DataFrame:
    """Drop texts shorter than 50 after stripping (measured before cleaning)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.filter(F.length(py_strip(t)) >= min_chars)


LABEL_COL = "informative_emotional_label"


def flt_labeled(df: DataFrame, label: str = LABEL_COL, check: bool = False) -> DataFrame:
    """Exactly 'informative' or 'emotional' (case-sensitive: 'Informative' is dropped)."""
    out = df.filter(F.col(label).isin(*P.LABELS))
    if check and out.isEmpty():
        raise ValueError(P.NO_LABELED_DATA)
    return out


def flt_unlabeled(df: DataFrame, label: str = LABEL_COL) -> DataFrame:
    return df.filter(F.coalesce(F.col(label), F.lit("")) == "")


def api_ticker_ok(t) -> Column:
    """Dashboard rule: blank or ALL pass; else <= 10 chars and ^[A-Z]{1,10}$ after upper."""
    t = F.col(t) if isinstance(t, str) else t
    return (t.isNull() | (t == "") | (t == "ALL")
            | ((F.length(t) <= P.API_TICKER_MAX_LENGTH) & F.upper(t).rlike(P.API_TICKER_PATTERN)))


def search_ticker_ok(t) -> Column:
    """Search rule: ^[A-Z]{1,5}$ after strip + upper (blank fails)."""
    t = F.col(t) if isinstance(t, str) else t
    return F.coalesce(F.upper(py_strip(t)).rlike(P.SEARCH_TICKER_PATTERN), F.lit(False))
