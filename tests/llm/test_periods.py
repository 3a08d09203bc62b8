import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from murmur.llm import periods
from tests.conftest import SF0001
from tests.llm.brute import WORD
from tests.llm.cases import empty, odd


def brute_runs(w):
    """(start, length, period) of every run, period by period; an array comparison for each."""
    codes = {}
    x = np.array([codes.setdefault(v, len(codes)) for v in w], int)
    best = {}
    for p in range(1, len(w) // 4 + 1):
        unequal = [-1, *np.flatnonzero(x[p:] != x[:-p]).tolist(), len(x) - p]
        for i, j in zip(unequal, unequal[1:]):
            if j - i > 1 and j + p - i - 1 >= max(6, 4 * p):
                best.setdefault((i + 1, j + p), p)  # periods ascend: the smallest one stays
    return sorted((s, e - s, p) for (s, e), p in best.items())


def brute(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute_runs(w)
    gone = set()
    for s, n, p in runs:
        gone.update(range(s + p, s + n))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode(), " ".join(x for i, x in enumerate(w) if i not in gone).encode())


def cases(seed=3):
    rng = random.Random(seed)
    out = ["", None, "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b"]
    for _ in range(150):  # few words, many runs
        out.append(" ".join(rng.choice("ab") for _ in range(rng.randrange(90))))
    for _ in range(150):  # powers with something changed, runs inside runs, runs side by side
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 63, 64, 100])
            base = [rng.choice("abcdefgh"[:rng.randrange(1, 9)]) for _ in range(p)]
            if rng.random() < 0.4:
                base = (base[:3] * p)[:p - 1] + ["z"]
            if rng.random() < 0.3:
                base = ["x"] * (p - 1) + ["y"]
            n = int(p * rng.uniform(2, 9))
            parts += [base[k % p] for k in range(n)]
            if rng.random() < 0.5:
                parts += [f"u{rng.random()}" for _ in range(rng.randrange(4))]
            if parts and rng.random() < 0.5:
                parts[rng.randrange(len(parts))] = "q"
        out.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    a, b = "a", "a b"
    for _ in range(14):
        a, b = b, b + " " + a  # Fibonacci words: no run of four
    morse = "".join("ab"[bin(k).count("1") & 1] for k in range(4096))
    out += [b, b + " " + b, " ".join(morse), " ".join(morse[:300] * 5), " ".join(morse[:1024] * 4 + "b" * 40 + "ab" * 50), "x " * 5000, "x y " * 3000 + "x"]
    nested = (("a b " * 8 + "c ") * 6 + "d ") * 5
    return out + [nested, nested * 4, ("w " * 100 + "v ") * 9]


@pytest.fixture(scope="module")
def wanted():
    return [(i, t, brute(i, t)) for i, t in enumerate(cases())]


@pytest.mark.parametrize("scale", [1, 8])
def test_runs_of_brute_force(wanted, scale, monkeypatch):
    monkeypatch.setattr(periods, "SCALE", scale)  # 1: every period by synchronising sets
    ids, texts = [i for i, _, _ in wanted], [t for _, t, _ in wanted]
    got = list(periods.collapse(ids, pa.array(texts, pa.string())))
    for (i, t, want), g in zip(wanted, got, strict=True):
        assert g == want, (i, t)
    assert sum(r[2][0] for r in wanted) > 500 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids)


def test_one_text_at_a_time_gives_the_same(wanted):
    for i, t, want in wanted[::7]:
        assert next(periods.collapse([i], pa.array([t], pa.string()))) == want


def test_positions_depend_on_their_context_only():
    """Equal stretches of 2t words have synchronising positions at equal places, and no t neighbours without
    one unless they are highly periodic."""
    rng = np.random.default_rng(5)
    part = rng.integers(0, 50, 400).astype(np.uint64)
    words = np.concatenate([rng.integers(0, 50, 333).astype(np.uint64), part, rng.integers(0, 50, 77).astype(np.uint64), part])
    names = periods.mix(words)
    for t in (1, 2, 4, 8, 16, 32):
        sync = periods.synchronising(names, np.zeros(len(names), bool), t)
        inside = lambda lo: {int(s) - lo for s in sync if lo <= s <= lo + 400 - 2 * t}
        assert inside(333) == inside(333 + 400 + 77)
        assert np.diff(sync).max(initial=0) <= t + 1
        names = periods._doubled(names, t)


def test_odd_rows(spark):
    df = odd(spark)
    got = periods.periodic_runs(df).collect()
    want = [(r["doc_id"], *brute(r["doc_id"], r["text"])) for r in df.collect()]
    assert sorted(map(str, ((r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["runs"].encode(), r["collapsed"].encode()) for r in got))) == sorted(map(str, want))
    assert all(r["exponent_milli"] == (1000 * r["length"] // r["period"] if r["n_runs"] else None) for r in got)
    assert periods.periodic_runs(empty(spark)).count() == 0


def test_query(spark):
    got = {r["doc_id"]: tuple(r) for r in E.queries()["op12_periodic_runs"](spark, SF0001).collect()}
    for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect():
        n, s, length, p, runs, kept = brute(r["doc_id"], r["text"])
        assert got[r["doc_id"]] == (r["doc_id"], n, s, length, p, 1000 * length // p if n else None, hashlib.sha256(runs).hexdigest(), hashlib.sha256(kept).hexdigest())
