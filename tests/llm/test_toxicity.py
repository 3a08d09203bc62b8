import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from murmur.llm import toxicity
from tests.conftest import SF001
from tests.llm.cases import empty, odd


def test_pairs_of_terms_count_where_neither_does_alone():
    rng = random.Random(2)
    noise = [f"n{k}" for k in range(200)]
    def text(insult, group):
        w = [rng.choice(noise) for _ in range(30)] + ["insult"] * insult + ["group"] * group
        rng.shuffle(w)
        return " ".join(w)
    marks = [(rng.random() < 0.5, rng.random() < 0.5) for _ in range(1500)]
    texts, label = [text(a, b) for a, b in marks], np.array([float(a and b) for a, b in marks])
    m = toxicity.fit(pa.array(texts[:1000]), label[:1000])
    assert ((m.score(pa.array(texts[1000:])) >= 0.7) == label[1000:]).mean() > 0.97


def test_pairs_of_terms_that_are_alone_as_frequent_in_both_labels():
    rng = random.Random(5)
    noise = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(300)]
    marks = [divmod(k, 2) for k in range(4)] * 400
    def text(insult, group):
        w = [rng.choice(noise) for _ in range(30)] + ["insult"] * insult + ["group"] * group
        rng.shuffle(w)
        return " ".join(w)
    # toxic with both or none: each alone is in half of the rows of either label
    texts, label = [text(a, b) for a, b in marks], np.array([float(a == b) for a, b in marks])
    m = toxicity.fit(pa.array(texts[:1200]), label[:1200])
    assert ((m.score(pa.array(texts[1200:])) >= 0.7) == label[1200:]).mean() > 0.97
    assert m.known.sum() <= 8  # the noise stays out


def test_held_out_rows_of_the_table(spark):
    from murmur.llm.registry import table
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [[r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0)]
    assert np.mean(toxic) > 0.5 and np.mean(clean) < 0.02
    again = toxicity.train(docs, labels)
    assert (model.weight == again.weight).all() and model.bias == again.bias


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None)], "doc_id bigint, toxic int")
    got = toxicity.score(odd(spark), toxicity.train(odd(spark), labels)).collect()
    assert len(got) == 15 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    none = toxicity.train(empty(spark), labels)
    assert not none.known.any() and toxicity.score(empty(spark), none).count() == 0


def xor_rows(n):
    rng = random.Random(9)
    noise = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(150)]
    rows = []
    for k in range(n):
        insult, group = k // 2 % 2, k % 2
        words = [rng.choice(noise) for _ in range(20)] + ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(insult == group)))
    return rows


def test_pairs_counted_by_spark_are_those_of_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 64)  # several blocks
    rows = xor_rows(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    marks = np.array([float(r[2]) for r in learnt])
    # the rule, pair by pair
    at = [set(toxicity.terms(np.array([0, len(r[1])]), np.frombuffer(r[1].encode(), np.uint8))[1].tolist()) for r in learnt]
    seen = {p: {i for i, has in enumerate(at) if p in has} for p in set().union(*at)}
    toxic = {i for i, m in enumerate(marks) if m}
    n, ones = len(marks), len(toxic)
    often = {p: s for p, s in seen.items() if len(s) >= toxicity.MIN_DOCS}
    alone = set()
    for p, s in often.items():
        share, bad = len(s) / n, len(s & toxic)
        if abs(bad / ones - (len(s) - bad) / (n - ones)) > toxicity.MIN_Z * (share * (1 - share) * (1 / ones + 1 / (n - ones))) ** 0.5:
            alone.add(p)
    need = math.log(len(often) * (len(often) - 1) / 2 / toxicity.PAIR_CHANCE)
    want = set(alone)
    for a, b in itertools.combinations(sorted(often), 2):
        k = len(often[a] & often[b])
        t = len(often[a] & often[b] & toxic)
        if k >= toxicity.MIN_DOCS and not (a in alone and b in alone):
            odds = [math.log((len(often[x] & toxic) + 0.5) / (len(often[x] - toxic) + 0.5)) for x in (a, b)]
            q = min(max(1 / (1 + math.exp(math.log(ones / (n - ones)) - sum(odds))), toxicity.PAIR_SHARE[0]), toxicity.PAIR_SHARE[1])
            evidence = (t * math.log(t / k / q) if t else 0) + ((k - t) * math.log((k - t) / k / (1 - q)) if t < k else 0)
            if evidence > need:
                want |= {a, b}
    assert want and set(np.flatnonzero(model.known).tolist()) == want
    # and the same machine as of rows in one process
    local = toxicity.fit(pa.array([r[1] for r in learnt]), marks)
    assert (local.weight == model.weight).all() and (local.factor == model.factor).all() and local.bias == model.bias


def test_scores_of_a_plain_loop():
    texts = ["Insult the group", "", None, "group group insulting", "none of it"]
    rng = np.random.default_rng(3)
    size = 1 << toxicity.HASH_BITS
    model = toxicity.Model(-0.3, rng.normal(size=size), rng.normal(size=(size, toxicity.FACTORS)), rng.random(size) < 0.8)
    got = model.score(pa.array(texts))
    for text, score in zip(texts, got):
        raw = (text or "").encode()
        places = [p for p in toxicity.terms(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))[1] if model.known[p]]
        z = model.bias + sum(model.weight[p] for p in places)
        z += sum(model.factor[a] @ model.factor[b] for a, b in itertools.combinations(places, 2))
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-9


def test_repeated_ids_in_the_fit(spark):
    rows = xor_rows(300)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(0, "zz " * 50)] * 40, "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, 0)] * 40, "doc_id bigint, toxic int")
    once = spark.createDataFrame([(k, min(t, "zz " * 50) if k == 0 else t) for k, t, _ in rows], "doc_id bigint, text string")
    a, b = toxicity.train(docs, labels), toxicity.train(once, labels)
    assert a.bias == b.bias and (a.weight == b.weight).all()
