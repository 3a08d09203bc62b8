"""Long word lists: automaton and window index against ``in``."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from murmur.functions import patterns
from murmur.operators import filters as flt
from murmur.operators import joins as J


def texts(seed, n=120):
    rng = random.Random(seed)
    out = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 300))) for _ in range(n)]
    return [*out, None, "", "a" * 3000, "x" * 511 + "abcab" + "y" * 600, "é" * 700 + "ab"]


@pytest.mark.parametrize("stretch", [4, 512])
def test_automaton_finds_what_in_finds(stretch, monkeypatch):
    monkeypatch.setattr(patterns, "STRETCH", stretch)
    monkeypatch.setattr(patterns, "PIECE_BYTES", 2000)
    for seed, words in enumerate([["abcab", "bca", "é é"], ["aaaaaaaaaaaaaaaa"], ["abcabc", "cabé"], [], [""], ["é"], ["zz", "abc" * 9], ["ab", "b"]]):
        column = texts(seed)
        got = patterns.Automaton([w.encode() for w in words]).found(pa.array(column, pa.string()))
        assert got.tolist() == [any(w in (t or "") for w in words if w) for t in column], words


def test_automaton_of_5000_words_costs_little_more_than_50():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(5, 12))).encode() for _ in range(5000)]
    column = pa.array([" ".join(rng.choice(["tion", "er", "an", "the", "in"]) + rng.choice("aeiou") for _ in range(400)) for _ in range(2000)])
    took = {}
    for n in (50, 5000):
        a = patterns.Automaton(words[:n])
        runs = []
        for _ in range(5):
            t0 = time.process_time()
            a.found(column)
            runs.append(time.process_time() - t0)
        took[n] = min(runs)
    assert took[5000] < 2 * took[50], took


def test_words_in_100_000_symbols(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = {"".join(rng.choice(letters, 5)) for _ in range(95_000)} | {a + b + c for a in "ABCDEFGHIJKLM" for b in letters for c in letters}
    symbols |= {"É1", "LONGER SYMBOL", "Q"}
    docs = [(i, "".join(rng.choice([*letters, *"ABCD", " "], int(rng.integers(0, 400)))), "".join(rng.choice(letters, 3))) for i in range(150)]
    docs += [(200, "xx É1 longer symbol", None), (201, None, "q"), (202, "", ""), (200, "q", "q"), (None, "Q" * 50, "É")]
    df = spark.createDataFrame([(i, a, b, "x") for i, a, b in docs], "id bigint, title string, selftext string, word string").repartition(5)
    tickers = spark.createDataFrame([(t,) for t in [*symbols, " ", None, " q "]], "ticker string").repartition(4)
    found = J.join_ticker_table(df, tickers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = []
    for i, a, b in docs:
        up = [(a or "").upper(), (b or "").upper()]
        windows = {t[k:k + n] for t in up for n in (1, 2, 3, 5, 13) for k in range(len(t) - n + 1)}
        want += [(i, w) for w in windows & symbols]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want)) and len(want) > 3000


def test_keyword_table_by_automaton_and_by_index(spark):
    rng = random.Random(7)
    words = ["Merger", "earn", "éa", " ", None, "spin off"] + ["".join(rng.choice("xyz") for _ in range(6)) for _ in range(200)]
    titles = ["MERGER talk", "learning", "a spin", "off", None, "ÉA", "nothing", "spin Off now", ""] + ["".join(rng.choice("xyz") for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "spin" if i == 3 else None) for i, t in enumerate(titles)], "id bigint, title string, selftext string")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    by_automaton = sorted(r.id for r in flt.flt_keyword_table(df, table.where("word <> ' '")).collect())
    by_index = sorted(r.id for r in flt.flt_keyword_table(df, table.where("word <> ' '"), limit=0).collect())
    plain = [i for i, t in enumerate(titles) if any(w.lower() in f"{(t or '').lower()} {'spin' if i == 3 else ''}" for w in words if w and w != " ")]
    assert by_automaton == by_index == plain and len(plain) > 10
    assert flt.flt_keyword_table(df, table.limit(0)).count() == 0 == flt.flt_keyword_table(df, table.limit(0), limit=-1).count()


def test_mentions_are_counted_before_the_join(spark):
    rows = [(1, "ABC abd", "abc", 0.0, "POSITIVE"), (2, "abc", None, 60.0, "POSITIVE"), (2, "abc", None, 60.0, "POSITIVE"),
            (3, None, "xABDx", 90000.0, None), (4, "", "nothing", None, "NEGATIVE"), (5, "abd", "abd", None, "NEGATIVE")]
    df = spark.createDataFrame([(i, a, b, t, None if s is None else (s,)) for i, a, b, t, s in rows],
                               "id bigint, title string, selftext string, created_utc double, sentiment struct<Sentiment:string>")
    tickers = spark.createDataFrame([("abc",), ("ABD",), ("abd ",), (None,), ("",), ("LONGER THAN ANY",)], "ticker string")
    found = J.agg_mentions_trend(df, tickers)
    got = {(r.ticker, str(r.post_date), r.sentiment_type): r.post_count for r in found.collect()}
    assert got == {("ABC", "1970-01-01", "POSITIVE"): 3, ("ABD", "1970-01-01", "POSITIVE"): 1, ("ABD", "1970-01-02", None): 1, ("ABD", "None", "NEGATIVE"): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" in plan and plan.index("Join") < plan.index("count(1)")


class Sent:
    def __init__(self, value):
        self.value = value


def told(columns, keep, words, monkeypatch, limit):
    monkeypatch.setattr(patterns, "WINDOW_BYTES", limit)
    mask = np.full(1 << (patterns.FILTER_BITS - 6), 2**64 - 1, np.uint64)  # lets all through
    batch = pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(keep)], names=[*"ab"[:len(columns)], "id"])
    lengths = sorted({len(w.encode()) for w in words})
    return list(patterns._told(Sent(mask), lengths, len(columns), ["id", "word"])([batch]))


def test_windows_leave_the_task_in_small_batches(monkeypatch):
    rng = random.Random(3)
    a, b = ([None if i % 50 == 7 else "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(0, 400))) for i in range(400)] for _ in range(2))
    b[:200] = a[:200]  # a window of both texts comes once
    out = told([a, b], list(range(400)), ["abc", "abcdefgh", "z"], monkeypatch, 4000)
    assert len(out) > 30 and max(x.nbytes for x in out) < 60 * 4000
    got = sorted((i, w) for x in out for i, w in zip(x["id"].to_pylist(), x["word"].to_pylist()))
    want = {(i, raw[k:k + n]) for i in range(400) for t in (a[i], b[i]) for raw in [(t or "").encode()] for n in (1, 3, 8) for k in range(len(raw) - n + 1)}
    assert got == sorted(want)


def test_windows_of_a_text_longer_than_a_stretch(monkeypatch):
    rng = random.Random(5)
    long = "".join(rng.choice("ab") for _ in range(5000))
    out = told([[long, "", long[:30]]], [7, 8, 9], ["a" * 12, "ab"], monkeypatch, 64)
    got = sorted((i, w) for x in out for i, w in zip(x["id"].to_pylist(), x["word"].to_pylist()))
    assert got == sorted({(i, t[k:k + n].encode()) for i, t in ((7, long), (9, long[:30])) for n in (2, 12) for k in range(len(t) - n + 1)})
