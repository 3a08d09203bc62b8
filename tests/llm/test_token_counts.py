import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmur.llm import token_counts as T
from tests.llm.cases import empty, odd

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_rule_of_the_largest_share(tokens, cuts):
    end = np.cumsum(tokens).astype(int) if tokens else np.zeros(0, int)
    begin = end - np.array(tokens, int)
    edges = np.cumsum([1 + c for c in cuts]) if cuts else np.zeros(0, int)  # sections with gaps between them
    lo, hi = edges[:-1:2] if len(edges) % 2 else edges[::2], edges[1::2]
    lo = lo[:len(hi)]
    counted, crossing = T.attribute(begin, end, lo, hi)
    want, cross = [0] * len(lo), [0] * len(lo)
    for a, z in zip(begin, end):
        share = [max(0, min(z, h) - max(a, b)) for b, h in zip(lo, hi)]
        if any(share):
            want[int(np.argmax(share))] += 1
            if max(share) < z - a:
                for k, s in enumerate(share):
                    cross[k] += s > 0
    assert counted.tolist() == want and crossing.tolist() == cross


def test_lines_partition_texts_and_counts_add_up(spark):
    got = T.token_counts(odd(spark), PATH, PATTERN)
    total = got.groupBy("doc_id", "doc_tokens").agg(F.sum("n_tokens").alias("n"), F.max("end").alias("end")).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd(spark).collect() if r["doc_id"] not in (None, 2)}
    for r in total:
        if r["doc_id"] in texts:
            assert r["n"] == r["doc_tokens"] and r["end"] == len(texts[r["doc_id"]])
    nine = got.where("doc_id = 9").collect()
    assert len(nine) == 40 and all(r["end"] - r["begin"] == 4 for r in nine)
    assert T.token_counts(empty(spark), PATH, PATTERN).count() == 0


def test_given_sections_and_the_rule(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma", [(0, 6), (6, 16)]), (2, "x", None)],
                               "doc_id bigint, text string, parts array<struct<begin: bigint, end: bigint>>")
    rows = T.token_counts(df, PATH, PATTERN, sections_col="parts").orderBy("section").collect()
    encoder, length = T.load(open(PATH, "rb").read(), PATTERN)
    begin, end = T.token_spans("alpha beta gamma", encoder, length)
    crosses = [(b, e) for b, e in zip(begin, end) if b < 6 < e]  # " beta" begins with the blank before the cut
    assert len(crosses) == 1 and crosses[0][0] == 5
    assert [r["doc_id"] for r in rows] == [1, 1] and sum(r["n_tokens"] for r in rows) == len(begin)
    assert rows[0]["n_tokens"] == sum(e <= 5 for e in end) and [r["n_crossing"] for r in rows] == [1, 1]


def test_spans_of_characters():
    encoder, length = T.load(open(PATH, "rb").read(), PATTERN)
    begin, end = T.token_spans("é日本 ab", encoder, length)
    assert begin[0] == 0 and end[-1] == 6 and (begin < end).all()
