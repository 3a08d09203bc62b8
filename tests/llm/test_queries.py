"""The registered queries on the given tables: oracle SQL, and the pipeline against plain versions."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from murmur.llm import bpe
from tests.conftest import SF001, SF0001
from tests.llm import brute
from tests.llm.test_mixing import brute as brute_mix
from tools.check_oracles import compare, duck


@pytest.mark.parametrize("name", ["op9_quality_rules", "op10_source_mixing"])
def test_matches_oracle(spark, name):
    r = compare(spark, duck(SF001), name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["ok"], r


def test_names():
    q = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in q) for k in range(1, 14)] == [1] * 13 and "pipeline" in q
    assert set(corpus_pipeline.ORACLE_SQL or {}) <= set(q)


def test_simhash_and_substrings(spark):
    docs = pq.read_table(f"{SF0001}/documents.parquet").sort_by("doc_id").to_pylist()
    prints = [brute.fingerprint(d["text"]) for d in docs]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in E.queries()["op2_simhash_near_dedup"](spark, SF0001).collect()}
    assert got == {d["doc_id"]: (f"{p:016x}", docs[g]["doc_id"]) for d, p, g in zip(docs, prints, brute.near_groups(prints))}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in E.queries()["op1_substring_dedup"](spark, SF0001).collect()}
    for d, (w, gone) in zip(docs, brute.removed_words([d["text"] for d in docs])):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert got[d["doc_id"]] == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_pipeline(spark):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{SF0001}/documents.parquet").to_pylist()}
    good = sorted(r[0] for r in duck(SF0001).execute(E.oracle_sql()["op9_quality_rules"].replace("SELECT *, NOT base_failed", "SELECT doc_id, NOT base_failed"))
                  .fetchall() if r[1])
    groups = brute.near_groups([brute.fingerprint(docs[i]["text"]) for i in good])
    first = [i for k, i in enumerate(good) if groups[k] == k]
    texts = {}
    for i, (w, gone) in zip(first, brute.removed_words([docs[i]["text"] for i in first])):
        texts[i] = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else docs[i]["text"]
    mix = brute_mix([(i, t, docs[i]["source"]) for i, t in texts.items()])
    ranks = bpe.load(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for (i, _), (size, _, taken) in mix.items():
        ids = np.array(library.encode_ordinary(texts[i]), "<u4")
        want += [(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest())] * (taken // size if size else 0)
    rows = [r for r in map(tuple, E.queries()["pipeline"](spark, SF0001).collect()) if r[1]]
    assert sorted(rows) == sorted(want) and len(want) > len(first)
