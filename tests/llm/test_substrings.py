import random

import pytest

from murmur.llm import recompress, substrings
from tests.llm import brute
from tests.llm.cases import SCHEMA, empty, odd, rows


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["na"] * 20
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([19, 20, 21, 55, 300]))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(passages), "na " * rng.randint(0, 50), "la di " * rng.randint(0, 30),
                             " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))]) for _ in range(rng.randint(0, 6))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    return texts + texts[:10] + [None, ""]


@pytest.mark.parametrize("seed", [1, 2])
def test_removes_what_brute_force_removes(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame(rows([(i, t, "s") for i, t in enumerate(texts)]), SCHEMA).repartition(5)
    got = {r["doc_id"]: r for r in substrings.substring_dedup(df).collect()}
    for i, (w, gone) in enumerate(brute.removed_words(texts)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (len(w), sum(gone), kept)
    assert sum(r["n_removed"] for r in got.values()) > 1000


def test_equal_words_make_equal_symbols_within_their_context():
    import numpy as np

    from murmur.llm._words import RangeHash, mix
    rng = np.random.default_rng(3)
    words = mix(rng.integers(0, 50, 3000).astype(np.uint64) + np.uint64(1))
    words[2000:2400] = words[500:900]
    first = np.array([0, 1500, 3000])
    doc = np.repeat([0, 1], 1500)
    for level in recompress.rounds(words, doc, first, RangeHash(words), 8):
        def inside(lo, hi, level=level):
            return {(s - lo, e - lo) for s, e, a, z in zip(level.start, level.end, level.low, level.high) if a >= lo and z <= hi}
        assert inside(500, 900) == inside(2000, 2400)


def test_odd_rows_and_whole_rows(spark):
    df = odd(spark)
    got = substrings.substring_dedup(df).collect()
    assert len(got) == 15
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["n_removed"] == 0 and all(r["n_removed"] == 60 and r["kept"] == "" for r in by[2])
    assert by[7][0]["n_removed"] == 30_000 - 1 and by[8][0]["n_removed"] == 0 and by[3][0]["n_words"] == 0
    out = substrings.without_repeats(df, length_col="n_chars")
    assert out.schema == df.schema
    back = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    assert {(3, None, None), (5, " \n\t ", 4), (2, "", 0), (7, "x", 1)} <= back
    assert substrings.substring_dedup(empty(spark)).count() == 0
