"""Batch column scorers.

The original calls hosted models one row at a time. Here every scorer is a function
``Column -> Column`` built from Catalyst higher-order functions (JVM-side, codegen), so it runs
where the data is, with no Python crossing. The interfaces match what the pipeline stores, so a
vectorised model (``pyspark.ml`` or an iterator ``pandas_udf``) can be swapped in.

Sentiment (lexicon): tokens = split(lower(text), '[^a-z]+'); p, n = tokens in the positive /
negative list; m = min(p, n); d = p + n + 1. Positive = (p-m)/d, Negative = (n-m)/d,
Mixed = 2m/d, Neutral = 1/d. Label = largest; ties go POSITIVE, NEGATIVE, MIXED, NEUTRAL.

Content type (cue words): i, e = informative / emotional cue counts;
Informative = (i+0.5)/(i+e+1), Emotional = 1 - Informative; ties go to informative (index 0).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions.text import col, contains_any, first


def tokens(text) -> Column:
    return F.split(F.lower(col(text)), "[^a-z]+")


def count_in(toks: Column, words: Iterable[str]) -> Column:
    words = list(words)
    return F.size(F.filter(toks, lambda x: x.isin(words))).cast("bigint")


def sentiment_counts(text, lexicon: P.Lexicon = P.Lexicon()) -> Column:
    t = tokens(text)
    return F.struct(count_in(t, lexicon.positive).alias("p"), count_in(t, lexicon.negative).alias("n"))


def sentiment_from_counts(p: Column, n: Column) -> Column:
    m = F.least(p, n)
    d = (p + n + 1).cast("double")
    pos, neg, mix, neu = (p - m) / d, (n - m) / d, (m * 2) / d, F.lit(1.0) / d
    best = F.greatest(pos, neg, mix, neu)
    label = (F.when(pos == best, "POSITIVE").when(neg == best, "NEGATIVE")
             .when(mix == best, "MIXED").otherwise("NEUTRAL"))
    return F.struct(label.alias("Sentiment"), F.struct(
        pos.alias("Positive"), neg.alias("Negative"), neu.alias("Neutral"), mix.alias("Mixed"))
        .alias("SentimentScore"))


def sentiment(text, lexicon: P.Lexicon = P.Lexicon()) -> Column:
    """Text -> struct<Sentiment, SentimentScore<Positive, Negative, Neutral, Mixed>>; null text -> null."""
    t = tokens(text)
    s = sentiment_from_counts(count_in(t, lexicon.positive), count_in(t, lexicon.negative))
    return F.when(col(text).isNotNull(), s)


def scoring_error(text, rejects: str | None = None) -> Column:
    """Why a text cannot be scored (null when it can): scorers reject empty input, and texts that
    hold ``rejects`` if one is named."""
    t = col(text)
    blank = F.when(t.isNull() | (F.trim(t) == ""), F.lit("empty text"))
    return blank if rejects is None else blank.when(F.contains(t, F.lit(rejects)), F.lit(P.REJECTED_TEXT))


def content_prediction(text, informative=P.INFORMATIVE_CUES, emotional=P.EMOTIONAL_CUES) -> Column:
    """Text -> model-style prediction struct<predicted_class, confidence, probabilities<informative, emotional>>."""
    t = tokens(text)
    return prediction_from_counts(count_in(t, informative), count_in(t, emotional))


def prediction_from_counts(i: Column, e: Column) -> Column:
    pi = (i.cast("double") + 0.5) / (i + e + 1).cast("double")
    pe = F.lit(1.0) - pi
    cls = F.when(pi >= pe, F.lit(P.LABELS[0])).otherwise(F.lit(P.LABELS[1]))
    return F.struct(cls.alias("predicted_class"), F.greatest(pi, pe).alias("confidence"),
                    F.struct(pi.alias("informative"), pe.alias("emotional")).alias("probabilities"))


def class_result(pred: Column) -> Column:
    """Normalise a prediction into the stored layout: upper-case class (default UNKNOWN),
    confidence and probabilities default 0.0."""
    return F.struct(
        F.upper(F.coalesce(pred["predicted_class"], F.lit("UNKNOWN"))).alias("Classification"),
        F.coalesce(pred["confidence"], F.lit(0.0)).alias("Confidence"),
        F.struct(F.coalesce(pred["probabilities"]["informative"], F.lit(0.0)).alias("Informative"),
                 F.coalesce(pred["probabilities"]["emotional"], F.lit(0.0)).alias("Emotional"))
        .alias("Probabilities"),
        F.lit(None).cast("string").alias("Error"))


def class_fallback(result: Column, error: Column, enabled: bool = True) -> Column:
    """Scorer error -> UNKNOWN / 0.0 / Error; scorer switched off -> DISABLED / 0.0."""
    null_probs = F.lit(None).cast("struct<Informative:double,Emotional:double>")
    if not enabled:
        return F.struct(F.lit("DISABLED").alias("Classification"), F.lit(0.0).alias("Confidence"),
                        null_probs.alias("Probabilities"), F.lit(None).cast("string").alias("Error"))
    failed = F.struct(F.lit("UNKNOWN").alias("Classification"), F.lit(0.0).alias("Confidence"),
                      null_probs.alias("Probabilities"), error.alias("Error"))
    return F.when(error.isNotNull(), failed).otherwise(result)


def content_type(text, enabled: bool = True) -> Column:
    """Text -> stored content_type struct, with the fallback rules applied."""
    return class_fallback(class_result(content_prediction(text)), scoring_error(text), enabled)


def relevance(title, selftext, terms=P.RELEVANCE_TERMS, cuts: P.TextCuts = P.WHOLE_TEXT) -> Column:
    """Rule scorer for the relevance check: too short (< 50 chars of title+selftext) is not
    relevant; otherwise relevant when title or text mention a finance term. Whole texts are read
    unless ``cuts`` says otherwise (``P.MODEL_CUTS``: what the original sent to its hosted model)."""
    ti, st = F.coalesce(col(title), F.lit("")), F.coalesce(col(selftext), F.lit(""))
    long_enough = F.length(F.concat(ti, st)) >= P.RELEVANCE_MIN_CHARS
    probe = F.lower(F.concat(first(ti, cuts.relevance_title), F.lit(" "), first(st, cuts.relevance_text)))
    return long_enough & contains_any(probe, terms)


# what Python's json module accepts: NaN and Infinity, but double quotes only
_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def parse_decision(reply, strict: bool = False) -> Column:
    """Model reply -> relevant? A JSON object counts when its ``decision`` is the string RELEVANT; a
    decision that is no string, and any other JSON value, make the original's lookup fail, and its
    catch-all keeps the post. A reply that is not JSON as a whole counts when it contains RELEVANT
    (so 'IRRELEVANT' passes; ``strict`` fixes that); empty -> false."""
    r = F.trim(col(reply))
    # inside brackets a whole JSON value is one element; anything after it breaks the array
    is_json = F.size(F.from_json(F.concat(F.lit("["), r, F.lit("]")), "array<string>", _JSON)) == 1
    is_obj = is_json & r.startswith("{")
    decision = F.try_element_at(F.from_json(r, "map<string, variant>"), F.lit("decision"))
    has = F.array_contains(F.json_object_keys(r), F.lit("decision"))
    no_string = has & F.coalesce(F.schema_of_variant(decision) != "STRING", F.lit(True))
    relevant = F.upper(F.coalesce(F.get_json_object(r, "$.decision"), F.lit(""))) == "RELEVANT"
    if strict:
        loose = F.regexp_like(F.upper(r), F.lit(r"(^|[^A-Z])RELEVANT"))
    else:
        loose = F.contains(F.upper(r), F.lit("RELEVANT"))
    return (F.when(col(reply).isNull() | (r == ""), F.lit(False))
            .when(is_obj, no_string | relevant).when(is_json, F.lit(True)).otherwise(loose))


def error_policy(error) -> Column:
    """Scorer error -> keep the row? access denied / validation -> drop; throttled / unknown -> keep."""
    e = F.coalesce(col(error), F.lit(""))
    throttled = F.contains(e, F.lit(P.ERROR_THROTTLED[0])) | F.contains(e, F.lit(P.ERROR_THROTTLED[1]))
    return (F.when(F.contains(e, F.lit(P.ERROR_ACCESS_DENIED)), F.lit(False))
            .when(throttled, F.lit(True))
            .when(F.contains(e, F.lit(P.ERROR_VALIDATION)), F.lit(False))
            .otherwise(F.lit(True)))


def normalize_label(reply) -> Column:
    """Labeling reply -> informative (checked first) / emotional / unknown; no reply -> error."""
    r = F.lower(F.trim(col(reply)))
    return (F.when(col(reply).isNull(), F.lit("error"))
            .when(F.contains(r, F.lit("informative")), F.lit("informative"))
            .when(F.contains(r, F.lit("emotional")), F.lit("emotional"))
            .otherwise(F.lit("unknown")))


def score_columns(df, text: Column, *, sentiment_out: str | None = None, content_out: str | None = None,
                  prediction_out: str | None = None, lexicon: P.Lexicon = P.Lexicon(),
                  cues: tuple = (P.INFORMATIVE_CUES, P.EMOTIONAL_CUES), classifier_enabled: bool = True):
    """DataFrame form of the scorers, the one to use in jobs: the token array is built once per
    text and the word counts are materialised in their own columns before the score formulas use
    them. (The Column forms above repeat the count expression in every branch, and expressions
    with lambdas are not shared by subexpression elimination: about 2.5x slower.)"""
    lists = ([lexicon.positive, lexicon.negative] if sentiment_out else []) + (list(cues) if content_out or prediction_out else [])
    some = sorted({w for words in lists for w in words})
    # one pass over all tokens leaves the few that any list holds
    d = df.withColumn("_tk", F.filter(tokens(text), lambda x: x.isin(some)))
    cols = []
    if sentiment_out:
        d = d.withColumn("_sp", count_in(F.col("_tk"), lexicon.positive)).withColumn(
            "_sn", count_in(F.col("_tk"), lexicon.negative))
        cols += ["_sp", "_sn"]
    if content_out or prediction_out:
        d = d.withColumn("_ci", count_in(F.col("_tk"), cues[0])).withColumn(
            "_ce", count_in(F.col("_tk"), cues[1]))
        cols += ["_ci", "_ce"]
    d = d.drop("_tk")
    if sentiment_out:
        d = d.withColumn(sentiment_out, F.when(text.isNotNull(), sentiment_from_counts(F.col("_sp"), F.col("_sn"))))
    if content_out or prediction_out:
        pred = prediction_from_counts(F.col("_ci"), F.col("_ce"))
        if prediction_out:
            d = d.withColumn(prediction_out, pred)
        if content_out:
            d = d.withColumn(content_out, class_fallback(class_result(pred), scoring_error(text), classifier_enabled))
    return d.drop(*cols)
