import hashlib

import pytest

import __spark_entry__ as E
from murmur.llm import lines
from tests.conftest import SF001
from tests.llm.brute import LOWER
from tests.llm.cases import SCHEMA, empty, odd, rows
from tools.check_oracles import compare, duck


def brute(docs, min_chars=40, min_docs=5):
    """[(id, n_lines, n_dropped, kept)] of (id, text)"""
    split = [(i, (t or "").split("\n")) for i, t in docs]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = {}
    for i, ls in split:
        for x in ls:
            held.setdefault(key(x), set()).add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, ls in split:
        kept = [x for x in ls if last.get(key(x), i) in (i, None)]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def got(df, **how):
    return sorted(map(str, map(tuple, lines.line_dedup(df, **how).collect())))


def test_drops_common_lines_but_in_the_last_document(spark):
    common, other = "this very common line stands in many documents", "ÄNOTHER line that is rather long and has ümlauts"
    docs = [(i, f"own {i}\n\t{common.upper() if i % 2 else common} \x0b\nend {i}\n") for i in range(60)]  # all rows hold one line
    docs += [(100 + i, f"{other}\nx{i}\n{other.replace('L', 'l')}") for i in range(5)] + [(200 + i, f"{other.replace('Ä', 'ä')}") for i in range(4)]
    docs += [(300, f"{common}\n{common}\n\n{common}"), (301, "\n\n"), (302, common[:39]), (303, common.replace(" ", " "))]
    docs += [(400 + i, f"{'a' * 40}\n{'b' * 39}") for i in range(5)] + [(500, f"{'a' * 40}\n" * 20_000)]
    df = spark.createDataFrame(rows([(i, t, "s") for i, t in docs]), SCHEMA).repartition(7)
    want = brute(docs)
    assert got(df) == sorted(map(str, want)) and sum(r[2] for r in want) > 60
    assert got(df, min_chars=39, min_docs=3) == sorted(map(str, brute(docs, 39, 3)))
    out = lines.without_repeats(df)
    assert out.schema == df.schema
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {i: kept for i, _, _, kept in want}


def test_odd_rows(spark):
    df = odd(spark)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert got(df) == sorted(map(str, brute(docs)))
    assert got(df, min_chars=1, min_docs=1) == sorted(map(str, brute(docs, 1, 1)))
    line = "a line of forty characters and a few more"
    null_ids = [(None, f"{line}\n{k}") for k in range(3)] + [(k, line) for k in range(4)] + [(3, line), (3, f"{line}\nmore")]
    df = spark.createDataFrame(rows([(i, t, "s") for i, t in null_ids]), SCHEMA)
    assert got(df) == sorted(map(str, brute(null_ids)))
    assert lines.line_dedup(empty(spark)).count() == 0 and lines.without_repeats(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = lines.line_dedup(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


@pytest.mark.parametrize("name", ["op11_line_dedup"])
def test_matches_oracle_and_brute_force(spark, name):
    r = compare(spark, duck(SF001), name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["ok"], r
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(docs)}
    rows_ = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in E.queries()[name](spark, SF001).collect()}
    assert rows_ == want and sum(d for _, d, _ in want.values()) > 0
