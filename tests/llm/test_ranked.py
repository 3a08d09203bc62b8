import math
import re

import numpy as np
import pytest

import __spark_entry__ as E
from murmur.llm import ranked
from tests.conftest import SF001, SF0001
from tests.llm.brute import LOWER
from tests.llm.cases import SCHEMA, empty, odd, rows
from tools.check_oracles import compare, duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, top=20):
    """Sorted (item, rank, doc, score); items and docs: (id, text)."""
    split = [(i, terms(t)) for i, t in docs]
    n_docs, length, df, query = sum(bool(t) for _, t in split), sum(len(t) for _, t in split), {}, {}
    for _, t in split:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    for i, t in items:
        query.setdefault(i, []).extend(terms(t))
    w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for x, d in df.items()}
    counts = [{x: t.count(x) for x in set(t)} for _, t in split]
    out = []
    for i, q in query.items():
        found = []
        for (d, t), tf in zip(split, counts):
            m = 100 - 25 + (25 * len(t) * n_docs // length if length else 0)
            score = sum(w[x] * (10**9 * tf[x] // (1000 * tf[x] + 12 * m)) for x in q if x in tf)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=str)


def got(items, docs, **how):
    return sorted((tuple(r) for r in ranked.search(items, docs, **how).collect()), key=str)


def small(spark, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "straße", "ЖЗ"]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=p / p.sum()))
    docs = [(k, text(rng.integers(0, 60))) for k in range(300)]
    docs += [(1000 - k, docs[7][1]) for k in range(200)] + [(k, docs[9][1].upper()) for k in range(5)]  # ties beyond the top, equal ids
    docs += [(None, docs[7][1]), (None, None), (400, ""), (401, "... !"), (402, "w1 " * 50_000)]
    items = [(k, text(rng.integers(0, 12))) for k in range(30)] + [(3, "w1-w1,W2"), (None, docs[7][1]), (77, None), (78, "nowhere"), (79, docs[7][1])]
    frame = lambda d: spark.createDataFrame(rows([(i, t, "s") for i, t in d]), SCHEMA)
    return items, docs, frame(items).withColumnRenamed("doc_id", "item_id"), frame(docs).repartition(5)


@pytest.fixture(scope="module")
def wanted(spark):
    items, docs, left, right = small(spark)
    return brute(items, docs), left, right


def test_ranks_of_brute_force(wanted):
    want, left, right = wanted
    assert got(left, right) == want
    assert len({r[0] for r in want}) > 25 and any(r[2] is None for r in brute([(0, "w39")], [(None, "w39"), (1, "x")]))


@pytest.mark.parametrize("how", [{"TERMS": 3}, {"DOCS": 7}, {"ITEMS": 4}, {"MOST_WEIGHT": 5000}])
def test_tiles_of_every_size_give_the_same(wanted, how, monkeypatch):
    want, left, right = wanted
    for k, v in how.items():
        monkeypatch.setattr(ranked, k, v)
    if "TERMS" in how or "MOST_WEIGHT" in how:
        monkeypatch.setattr(ranked.tiles, "__defaults__", (ranked.TERMS, ranked.MOST_WEIGHT))
    assert got(left, right) == want


def test_blocks_of_items_give_the_same(wanted):
    want, left, right = wanted
    assert got(left, right, limit=60) == want
    assert got(left, right, top=3) == [r for r in want if r[1] <= 3]


def test_tiles_stay_exact():
    """Every weight is dealt whole, and no item's weights in a tile exceed the bound."""
    rng = np.random.default_rng(0)
    item, slot = np.repeat(np.arange(5), 40), np.tile(np.arange(40), 5)
    weight = rng.integers(1, 300, 200) ** 2
    weight[17] = 10**6
    of = ranked.tiles(item, slot, weight, 16, 10**5)
    total = np.zeros((5, 40), np.int64)
    for t in of:
        assert len(t.slots) <= 16 and np.bincount(t.item, t.weight).max() <= 10**5
        np.add.at(total, (t.item, t.slots[t.column]), t.weight)
    assert (total[item, slot] == weight).all()
    most = 2**53 // 10**6
    assert most * (10**6 - 1) < 2**53
    big = ranked.tiles(np.zeros(3, int), np.arange(3), np.array([3 * most, most, 5]))
    scores = ranked.tile_scores(big, 1, 3, np.zeros(3, int), np.arange(3), np.array([999_999, 999_998, 7]), 1)
    assert scores[0, 0] == 3 * most * 999_999 + most * 999_998 + 35


def test_ties_take_the_first_columns():
    s = np.array([[5, 7, 5, 5, 0, 7], [0, 0, 0, 0, 0, 1], [2, 2, 2, 2, 2, 2]])
    i, j = ranked.best_of_tile(s, 3)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (0, 5), (1, 5), (2, 0), (2, 1), (2, 2)]


def test_odd_rows(spark):
    items, docs = odd(spark).withColumnRenamed("doc_id", "item_id"), odd(spark)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(items, docs) == brute(plain, plain)
    nothing = empty(spark).withColumnRenamed("doc_id", "item_id")
    assert got(nothing, docs) == [] and got(items, empty(spark)) == [] and got(nothing, empty(spark)) == []
    assert ranked.search(nothing, docs).dtypes == ranked.search(items, docs).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_query(spark):
    name = "op13_ranked_search"
    r = compare(spark, duck(SF001), name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["ok"], r
    load = lambda t, i: [(r[i], r["text"]) for r in spark.read.parquet(f"{SF0001}/{t}.parquet").collect()]
    want = brute(load("benchmark", "item_id"), load("documents", "doc_id"))
    assert sorted((tuple(r) for r in E.queries()[name](spark, SF0001).collect()), key=str) == want and want
