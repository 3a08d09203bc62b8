"""Hand-written edge rows, one per decision in SURVEY 2.14 / FIXTURES C."""

import json
import os

from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.operators import aggregations as A
from murmur.operators import filters as flt
from murmur.operators import ml as ML
from murmur.operators import monitor as M
from murmur.operators import projections as PR
from murmur.operators import windows as WN
from murmur.schema import RAW_ITEM
from murmur.sources import files, sinks


def item(spark, **kw):
    base = {f.name: None for f in RAW_ITEM.fields}
    base.update(kw)
    return spark.createDataFrame([tuple(base[f.name] for f in RAW_ITEM.fields)], RAW_ITEM)


def test_comment_never_matches_ticker_by_default(spark):
    d = item(spark, type="comment", id="c1", body="MIT rocks")
    assert flt.flt_ticker(d, "MIT").count() == 0
    assert flt.flt_ticker(d, "MIT", columns=("title", "selftext", "body")).count() == 1


def test_row_equal_to_mark_is_kept(spark):
    d = item(spark, type="post", id="p1", created_utc=100.0)
    assert flt.flt_hwm(d, 100.0).count() == 1
    assert flt.flt_hwm(d, 100.5).count() == 0
    assert flt.flt_hwm(d, None).count() == 1


def test_wrapped_and_bare_batches_read_the_same(spark, tmp_dir):
    x = {"type": "post", "id": "p1", "title": "t", "selftext": "s", "subreddit": "a", "created_utc": 1.5, "score": 3}
    os.makedirs(f"{tmp_dir}/w")
    os.makedirs(f"{tmp_dir}/b")
    with open(f"{tmp_dir}/w/one.json", "w") as f:
        json.dump({"metadata": {"timestamp": "t", "total_items": 1, "processed_subreddits": ["a"], "keywords": ["k"]},
                   "data": [x]}, f, indent=2)
    with open(f"{tmp_dir}/b/one.json", "w") as f:
        json.dump([x], f, indent=2)
    w = files.read_raw_batches(spark, f"{tmp_dir}/w").collect()
    b = files.read_raw_batches(spark, f"{tmp_dir}/b").collect()
    assert w == b and len(w) == 1 and w[0]["id"] == "p1" and w[0]["created_utc"] == 1.5


def test_reply_irrelevant_counts_as_relevant_unless_strict(spark):
    d = spark.createDataFrame([("IRRELEVANT",), ('{"decision": "relevant"}',), ('{"decision": "IRRELEVANT"}',), ("",),
                               ('"no"',), ("{bad RELEVANT",), ('{"decision":null}',), ('{"decision":5}',), ("NaN",),
                               ('{"decision":"IRRELEVANT"} extra',), ("{'decision': 'x'}",), ('{"other": 1}',)], "r string")
    got = d.select(S.parse_decision("r").alias("a"), S.parse_decision("r", strict=True).alias("b")).collect()
    assert [(g.a, g.b) for g in got] == [(True, False), (True, True), (False, False), (False, False),
                                          (True, True), (True, True), (True, True), (True, True), (True, True),
                                          (True, False), (False, False), (False, False)]


def test_label_case_is_exact(spark):
    d = spark.createDataFrame([("Informative",), ("informative",), ("emotional",), ("needs_review",)], "informative_emotional_label string")
    assert [r[0] for r in flt.flt_labeled(d).collect()] == ["informative", "emotional"]


def test_python_whitespace_collapse(spark):
    d = spark.createDataFrame([("a b　c\u001cd  ",)], "t string")
    assert d.select(PR.clean_text(F.col("t"))).first()[0] == "a b c d"


def test_long_text_cut_with_ellipsis(spark):
    d = spark.createDataFrame([("x" * 1001,), ("y" * 1000,)], "t string")
    got = [r[0] for r in d.select(PR.clean_text(F.col("t"))).collect()]
    assert got == ["x" * 1000 + "...", "y" * 1000]


def test_emoji_counts_as_one_character(spark):
    d = spark.createDataFrame([("a" * 499 + "\U0001F600" + "zz",)], "title string")
    out = PR.prj_sanitize(d).first()["title"]
    assert out == "a" * 499 + "\U0001F600"


def test_csv_round_trip_keeps_commas_quotes_newlines(spark, tmp_dir):
    from murmur.schema import TRAINING
    row = ("p1", 'he said "hi", then\nleft', "s", "post", 3, 1.5, "UNKNOWN", "", "", "")
    d = spark.createDataFrame([row], TRAINING)
    sinks.write_training_csv(d, f"{tmp_dir}/csv")
    back = files.read_training_csv(spark, f"{tmp_dir}/csv").collect()
    assert tuple(back[0]) == row


def test_scorer_error_falls_back_to_unknown(spark):
    d = spark.createDataFrame([("",), ("data price",)], "t string")
    got = d.select(S.content_type(F.col("t")).alias("c")).collect()
    assert got[0].c.Classification == "UNKNOWN" and got[0].c.Confidence == 0.0 and got[0].c.Error
    assert got[1].c.Classification == "INFORMATIVE"
    off = d.select(S.content_type(F.col("t"), enabled=False).alias("c")).first().c
    assert off.Classification == "DISABLED" and off.Confidence == 0.0


def test_empty_summary(spark):
    d = spark.createDataFrame([], "type string, score bigint, created_utc double, sentiment struct<Sentiment:string>")
    r = A.agg_summary(d).first()
    assert r.total_items == 0 and r.posts == 0 and r.average_score == 0.0 and r.timeframe_coverage == "No data"


def test_budget_overshoot_keeps_first_post_with_all_comments(spark):
    posts = spark.createDataFrame([("a", "p1", 10.0, 13), ("a", "p2", 5.0, 1)], "subreddit string, id string, created_utc double, n_items bigint")
    kept = WN.item_budget(posts, 10).collect()
    assert [(r.id, r.items_before) for r in kept] == [("p1", 0)]


def test_comment_cap_applies_before_quality(spark):
    rows = [("c%02d" % i, "p1", float(i), 0 if i < 10 else 99, "x" * 100) for i in range(12)]
    d = spark.createDataFrame(rows, "id string, post_id string, created_utc double, score bigint, body string")
    capped = WN.comment_cap(d).filter(flt.comment_quality(3, 30))
    assert capped.count() == 0


def test_quota_scenario(spark):
    ts = [i * 60.0 for i in range(12)] + [11 * 60.0 + 61 * 60.0]
    d = spark.createDataFrame([(i, 7, t) for i, t in enumerate(ts)], "event_id bigint, user_id bigint, ts_s double")
    got = [r.accepted for r in WN.sliding_quota(d, "user_id", "ts_s", 10).orderBy("event_id").collect()]
    assert got == [True] * 10 + [False, False, True]
    assert got == WN.quota_reference([(7, t) for t in ts], 10)


def test_alarm_needs_consecutive_buckets(spark):
    s = spark.createDataFrame([("e", 0, 5), ("e", 600, 5)], "source string, bucket_start bigint, n bigint")
    assert M.alarm(s, "n", 1.0, 2, 300).count() == 0
    s2 = spark.createDataFrame([("e", 0, 5), ("e", 300, 5)], "source string, bucket_start bigint, n bigint")
    assert [r.alarm_bucket_start for r in M.alarm(s2, "n", 1.0, 2, 300).collect()] == [300]


def test_unpredicted_class_gets_zero_precision(spark):
    pred = spark.createDataFrame([("informative", "emotional"), ("emotional", "emotional")], "actual string, predicted string")
    rep = {r["class"]: r for r in ML.agg_class_report(ML.agg_confusion(pred)).collect()}
    assert rep["informative"].precision == 0.0 and rep["informative"].recall == 0.0
    assert rep["emotional"].precision == 0.5 and rep["emotional"].recall == 1.0


def test_relevance_short_text_is_not_relevant(spark):
    d = spark.createDataFrame([("dividend", "tiny"), ("profit margin " * 5, "x"), ("a title", "x" * 900 + " dividend")],
                              "title string, selftext string")
    assert [r[0] for r in d.select(S.relevance("title", "selftext")).collect()] == [False, True, True]  # whole texts
    assert [r[0] for r in d.select(S.relevance("title", "selftext", cuts=P.MODEL_CUTS)).collect()] == [False, True, False]


def test_timeframe_map_default(spark):
    d = spark.createDataFrame([("7d",), ("bogus",), (None,)], "tf string")
    assert [r[0] for r in d.select(PR.timeframe_hours(F.col("tf"))).collect()] == [168, 24, 24]


def test_ticker_rules(spark):
    d = spark.createDataFrame([("AAPL",), ("brk.b",), ("ALL",), ("",), ("ABCDEFGHIJK",), (" msft ",)], "t string")
    got = d.select(flt.api_ticker_ok("t").alias("a"), flt.search_ticker_ok("t").alias("s")).collect()
    assert [(g.a, g.s) for g in got] == [(True, True), (False, False), (True, True), (True, False),
                                          (False, False), (False, True)]


def test_sentiment_lexicon_ties(spark):
    lex = P.Lexicon(positive=("good",), negative=("bad",))
    d = spark.createDataFrame([("good bad",), ("good",), ("nothing",)], "t string")
    got = [r.s for r in d.select(S.sentiment(F.col("t"), lex).alias("s")).collect()]
    assert [g.Sentiment for g in got] == ["MIXED", "POSITIVE", "NEUTRAL"]
    for g in got:
        sc = g.SentimentScore
        assert abs(sc.Positive + sc.Negative + sc.Neutral + sc.Mixed - 1.0) < 1e-12


def test_corrupt_batch_record_does_not_fail_the_read(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/mixed")
    good = {"metadata": {"timestamp": "t"}, "data": [{"type": "post", "id": "p1", "subreddit": "a",
                                                      "created_utc": 1.0, "score": 1}]}
    with open(f"{tmp_dir}/mixed/part.json", "w") as f:
        f.write(json.dumps(good) + "\n" + "{not json\n" + json.dumps([{"type": "comment", "id": "c1"}]) + "\n")
    got = files.read_raw_batches(spark, f"{tmp_dir}/mixed", multi_line=False).collect()
    assert sorted(r.id for r in got) == ["c1", "p1"]  # the bad line is skipped, the rest read


def test_quota_fast_path_matches_row_walk():
    import random

    import numpy as np
    rnd = random.Random(7)
    for _ in range(500):
        limit = rnd.randint(1, 5)
        ts = sorted(rnd.uniform(0, 30000) for _ in range(rnd.randint(1, 40)))
        cut = rnd.randint(0, len(ts))
        a, carried = WN.quota_segment([], np.array(ts[:cut]), limit, 3600.0)
        b, _ = WN.quota_segment(carried, np.array(ts[cut:]), limit, 3600.0)
        assert list(a) + list(b) == WN.quota_reference([(1, t) for t in ts], limit)


def test_ticker_list_parsing_and_fallback(spark):
    from murmur.operators.joins import ticker_list
    got = [(r.ticker, r.source) for r in ticker_list(spark, " AAPL, ,MSFT ,BRK.B,").collect()]
    assert got == [("AAPL", "configured"), ("MSFT", "configured"), ("BRK.B", "configured")]
    fb = ticker_list(spark, None).collect()
    assert [r.ticker for r in fb] == P.FALLBACK_TICKERS and {r.source for r in fb} == {"fallback_default"}


def test_word_mode_mentions(spark):
    from murmur.operators.joins import join_ticker_mentions
    d = spark.createDataFrame([("p1", "MITIGATE risk", ""), ("p2", "mit and gnu", "")], "id string, title string, selftext string")
    sub = sorted((r.id, r.ticker) for r in join_ticker_mentions(d, ["MIT"]).collect())
    word = sorted((r.id, r.ticker) for r in join_ticker_mentions(d, ["MIT"], match="word").collect())
    assert sub == [("p1", "MIT"), ("p2", "MIT")] and word == [("p2", "MIT")]
