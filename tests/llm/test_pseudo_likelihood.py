import random

import numpy as np

from murmur.llm import pseudo_likelihood as P
from tests.llm.cases import empty, odd


def test_words_that_fit_both_sides_score_higher(spark):
    rng = random.Random(4)
    def sentence():
        a, b = rng.choice([("red", "apple"), ("blue", "sea"), ("green", "leaf")])
        return f"the {a} {b} is {a} ."
    texts = [" ".join(sentence() for _ in range(40)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    net, classes = P.train(df)
    shuffled = []
    for t in texts[:50]:
        w = t.split()
        rng.shuffle(w)
        shuffled.append(" ".join(w))
    probe = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:50])] + [(100 + i, t) for i, t in enumerate(shuffled)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in P.score(probe, net, classes).collect()}
    assert all(got[i]["mean_log_prob"] > got[100 + i]["mean_log_prob"] + 0.5 for i in range(50))
    assert all(np.isclose(r["log_prob"], r["n_words"] * r["mean_log_prob"]) for r in got.values())


def made_up(words=500, rare=40):
    """Classes of a small corpus: ``words`` in the head, ``rare`` beyond it."""
    rng = np.random.default_rng(0)
    word = rng.integers(-2**63, 2**63 - 1, words + rare)
    n = np.sort(rng.integers(2, 90, words + rare))[::-1].astype(float)
    c = P.Classes.layout(word[:words], n[:words], int(n.sum()), words + rare)
    for w, k in zip(word[words:], n[words:]):
        c.mass[c.tail + w % c.tails] += k
    return word, n, c


def test_probabilities_add_up():
    word, n, c = made_up()
    _, z = P.Network.start(c).forward(np.zeros((3, 2 * P.SIDE), int))
    assert np.allclose(np.exp(z).sum(axis=1), 1, atol=1e-4)
    _, of, within, hit = c.place_and_class(word)
    assert hit.tolist() == [True] * 500 + [False] * 40
    within = within + np.where(hit, 0, np.log(n))
    unseen = sum(np.exp(z[0][k]) * P.UNSEEN / c.mass[k] for k in range(c.tail, len(c.mass)))
    assert np.isclose(np.exp(z[0][of] + within).sum() + unseen, 1, atol=1e-3)


def test_gradients_against_differences():
    _, _, c = made_up()
    rng = np.random.default_rng(1)
    context, target = rng.integers(0, c.inputs, (P.BATCH, 2 * P.SIDE)), rng.integers(0, len(c.mass), P.BATCH)
    net = P.Network.start(c)
    net = P.Network(*(x.astype(float) for x in net.parameters()))
    loss = lambda m: -m.forward(context)[1][np.arange(P.BATCH), target].mean()
    after = P.Network(*(x.copy() for x in net.parameters()))
    after.train(context, target, 0)
    for name, scale, spots in (("embed", 16, [(context[0, 0], 1), (context[9, 3], 4)]), ("offset", 1, [(1, 2), (3, 0)]), ("hidden", 1, [(3,)]),
                               ("out", 1, [(2, target[5])]), ("bias", 1, [(target[7],)])):
        for at in spots:
            gradient = (getattr(net, name)[at] - getattr(after, name)[at]) / P.RATE / scale
            up, down = (P.Network(*(x.copy() for x in net.parameters())) for _ in range(2))
            getattr(up, name)[at] += 1e-5
            getattr(down, name)[at] -= 1e-5
            assert np.isclose(gradient, (loss(up) - loss(down)) / 2e-5, rtol=1e-3, atol=1e-8), name


def test_scores_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(P, "HEAD", 20)  # most words are beyond the head
    rng = random.Random(8)
    texts = [" ".join(f"W{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(60))) for _ in range(80)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    net, words = P.train(df)
    c = words.classes
    key = lambda w: int(P.hashes(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8))[0][0])
    n = {}
    for t in texts:
        for w in (t or "").split():
            n[key(w)] = n.get(key(w), 0) + 1
    assert {r["word"]: r["n"] for r in words.counts.collect()} == n and len(n) > 100 and len(c.head) == 20
    assert sorted(n[w] for w in c.head.tolist()) == sorted(n.values())[-20:]
    own = c.inputs // 2
    place = lambda w: int(c.head_place[c.head.tolist().index(w)]) if w in c.head else own + w % (c.inputs - own)
    of = lambda w: int(c.head_class[c.head.tolist().index(w)]) if w in c.head else c.tail + w % c.tails
    mass = [0.0] * c.tail + [P.UNSEEN] * c.tails
    for w, k in n.items():
        mass[of(w)] += k
    assert np.allclose(mass, c.mass)
    # a document of words that the corpus does not have is scored too
    probe = spark.createDataFrame([*enumerate(texts), (500, "never seen w1 before")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in P.score(probe, net, words).collect()}
    for i, t in [*enumerate(texts), (500, "never seen w1 before")]:
        w = [key(x.lower()) for x in (t or "").split()]
        total = 0.0
        for at, x in enumerate(w):
            around = [place(w[at + o]) if 0 <= at + o < len(w) else 0 for o in (-2, -1, 1, 2)]
            h = np.tanh(net.hidden + sum(net.embed[p] * net.offset[k] for k, p in enumerate(around)))
            z = h @ net.out + net.bias
            total += z[of(x)] - np.log(np.exp(z).sum()) + np.log(n.get(x, P.UNSEEN) / mass[of(x)])
        assert got[i]["n_words"] == len(w) and np.isclose(got[i]["log_prob"], total, rtol=1e-4, atol=1e-4)


def test_sizes_grow():
    small, large = P.sizes(10_000), P.sizes(100_000_000)
    assert all(b > a for a, b in zip(small, large)) and P.rounds(10**12) > P.rounds(10**8) > P.rounds(10**6)
    assert large[1] <= 16 * 100_000_000 ** 0.5  # the model stays far smaller than the vocabulary


def test_odd_rows(spark):
    got = P.score(odd(spark), *P.train(odd(spark))).collect()
    assert len(got) == 15
    assert all((r["n_words"] == 0) == (r["mean_log_prob"] is None) and r["log_prob"] <= 0 for r in got)
    assert P.score(empty(spark), *P.train(empty(spark))).count() == 0
