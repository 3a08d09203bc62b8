import random

import numpy as np
import pytest

from murmur.llm import simhash
from tests.llm import brute
from tests.llm.cases import SCHEMA, empty, odd, rows


def test_gray_rank_orders_the_gray_code():
    ranks = np.arange(1 << 10, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


def clustered(rng, n):
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            out.append(x)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
    return out[:n]


@pytest.mark.parametrize("n", [1, 8, 9, 65, 700])
def test_index_finds_all_near_pairs(n):
    prints = np.unique(np.array(clustered(random.Random(n), n), np.uint64))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    a, b = simhash.Index(prints).pairs(4)
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 4}
    assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want


def test_links_join_the_components_also_of_split_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 16)
    prints = clustered(random.Random(5), 500)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in set(prints)], "print bigint")
    from murmur.llm.graph import components
    got = {r["node"] % (1 << 64): r["root"] for r in components(simhash.near_links(df)).collect()}
    root = brute.near_groups(prints)
    for i, p in enumerate(prints):
        assert got.get(p, p) == got.get(prints[root[i]], prints[root[i]])
    assert len({got.get(p, p) for p in prints}) == len({prints[r] for r in root})


def test_documents(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    docs = sorted(odd(spark).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    prints = [brute.fingerprint(r["text"]) for r in docs]
    root = brute.near_groups(prints)
    want = sorted((str(r["doc_id"]), p, str(docs[k]["doc_id"])) for r, p, k in zip(docs, prints, root))
    assert sorted((str(r["doc_id"]), r["print"] % (1 << 64), str(r["component_id"])) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_representatives_keep_one_row_of_a_group(spark):
    df = odd(spark)
    kept = simhash.representatives(df)
    assert kept.schema == df.schema
    ids = [r["doc_id"] for r in kept.collect()]
    named = [i for i in ids if i is not None]
    want = {r["component_id"] for r in simhash.near_duplicates(df.where("doc_id IS NOT NULL")).collect()}
    assert sorted(named) == sorted(want) and ids.count(None) == 2


def test_representatives_keep_rows_of_one_id(spark):
    """Rows of one id with unrelated texts are different documents; copies under one id are one."""
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    data = [(1, text(1), "a"), (1, text(2), "a"), (2, text(3), "a"), (3, text(1), "b"), (1, text(1), "c"), (4, text(2), "a"), (None, text(1), "a"), (0, None, "a"), (5, "", "b")]
    df = spark.createDataFrame(rows(data), SCHEMA).repartition(3)
    out = simhash.representatives(df)
    assert out.schema == df.schema
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect()) == sorted([("1", text(1)), ("1", text(2)), ("2", text(3)), ("None", text(1)), ("0", "")])
    assert simhash.representatives(empty(spark)).count() == 0
    odd_ = simhash.representatives(odd(spark))
    assert odd_.columns == df.columns and odd_.where("doc_id IS NULL").count() == 2
