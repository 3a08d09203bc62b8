import numpy as np

from murmur.llm import embeddings
from tests.llm.brute import Sets


def brute(rows):
    ids, sets, links = [i for i, _ in rows], Sets(len(rows)), [0] * len(rows)
    good = [k for k, (_, v) in enumerate(rows) if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[k][1] for k in good], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    for a in range(len(good)):
        for b in range(a):
            if near[a, b]:
                sets.join(good[a], good[b])
                links[good[a]] += 1
                links[good[b]] += 1
    least = {}
    for k in range(len(rows)):
        least.setdefault(sets.root(k), []).append(ids[k])
    return [(ids[k], links[k], min((i for i in least[sets.root(k)] if i is not None), default=None)) for k in range(len(rows))]


def test_finds_the_links_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 16)  # lists are split
    rng = np.random.default_rng(1)
    rows = []
    for k in range(40):
        c = rng.normal(size=8)
        for _ in range(int(rng.choice([1, 2, 60], p=[0.5, 0.4, 0.1]))):
            rows.append((len(rows), [float(np.float32(v)) for v in c + rng.normal(size=8) * 0.12]))
    rows += [(len(rows) + k, rows[0][1]) for k in range(5)]
    rows += [(None, None), (9001, []), (9002, [0.0] * 8), (9003, [float("nan")] * 8), (9004, [1.0, None] + [0.0] * 6), (9005, [1.0, 2.0]),
             (9006, [float("inf")] * 8), (None, [5.0] * 8), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, node string, copies int").repartition(3)
    got = embeddings.near_duplicates(df).collect()
    want = brute(rows)
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    found, all_ = sum(r["n_links"] for r in got), sum(n for _, n, _ in want)
    assert len(got) == len(rows) and 0.97 * all_ <= found <= all_
    alone = {i for i, n, c in want if n == 0}
    assert all(r["n_links"] == 0 for r in got if r["vec_id"] in alone)
    assert sorted((str(r["vec_id"]), str(r["component_id"])) for r in got) == sorted((str(i), str(c)) for i, _, c in want)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    exact = embeddings.near_duplicates(df, nearest=32).collect()  # all pivots shared: every pair is compared
    assert sorted(map(key, ((r["vec_id"], r["n_links"], r["component_id"]) for r in exact))) == sorted(map(key, want))


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_dense_cluster_of_distinct_vectors(spark):
    """A third of the vectors are distinct near copies of one centre; another length has copies too."""
    rng = np.random.default_rng(8)
    for n, noise in ((3000, 0.0219), (12000, 0.0219)):  # expected cosine of a pair in the cluster: 0.97
        m = n // 3
        centre = rng.normal(size=64)
        x = np.concatenate([centre / np.linalg.norm(centre) + rng.normal(size=(m, 64)) * noise, rng.normal(size=(n - m, 64))])
        u = x / np.linalg.norm(x, axis=1)[:, None]
        near = u[:m] @ u[:m].T >= 0.95
        want = near.sum(axis=1) - 1
        rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(n + i, [1.0, 2.0, 3.0]) for i in range(3)] + [(n + 9, [3.0, 1.0])]
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(8)
        got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
        found = sum(got[i]["n_links"] for i in range(m))
        assert 0.9 * want.sum() <= found <= want.sum() and want.sum() > 0.8 * m * m
        assert all(got[i]["n_links"] <= want[i] for i in range(m)) and all(got[i]["n_links"] == 0 for i in range(m, n))
        sets = Sets(n)
        for i in range(m):
            for j in np.flatnonzero(near[i, :i])[:1].tolist():
                sets.join(i, j)
        assert [got[i]["component_id"] for i in range(n)] == [sets.root(i) for i in range(n)]
        assert [(got[n + i]["n_links"], got[n + i]["component_id"]) for i in range(3)] == [(2, n)] * 3 and got[n + 9]["n_links"] == 0


def test_pivots_are_apart():
    rng = np.random.default_rng(1)
    x = embeddings.unit(np.concatenate([rng.normal(size=(1, 16)) + rng.normal(size=(700, 16)) * 0.1, rng.normal(size=(100, 16))]))
    p = embeddings.spread(x, 50, 0.95)
    c = p @ p.T
    assert len(p) == 50 and (c[~np.eye(50, dtype=bool)] <= 2 * 0.95 ** 2 - 1).all() and len(embeddings.spread(x[:1], 50, 0.95)) == 1
