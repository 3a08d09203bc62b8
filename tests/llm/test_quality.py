import re
from collections import Counter

from murmur.llm import quality
from tests.llm.cases import empty, odd


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j + k for j in range(len(w) - 2) if grams[tuple(w[j:j + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered))


def test_measures_and_verdict(spark):
    got = quality.score(odd(spark)).collect()
    assert len(got) == 15
    texts = Counter((r["doc_id"], *brute(r["text"])) for r in odd(spark).collect())
    assert texts == Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert any(r["kept"] for r in got)


def test_repetition_coverage_rejects_what_the_base_rule_passes(spark):
    once = " ".join(f"u{k}" for k in range(100))
    twice = " ".join(f"v{k}" for k in range(24))
    df = spark.createDataFrame([(1, once), (2, f"{once} {twice} {twice} {twice}")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality.score(df).collect()}
    assert got[1]["kept"] and got[1]["dup_5gram_chars"] == 0
    assert not got[2]["base_failed"] and got[2]["dup_5gram_chars"] == 2 * len(twice.replace(" ", "")) and not got[2]["kept"]


def test_keep_returns_whole_rows(spark):
    df = odd(spark)
    kept = quality.keep(df)
    assert kept.schema == df.schema
    assert kept.count() == quality.score(df).where("kept").count() > 0
    assert quality.keep(empty(spark)).count() == quality.score(empty(spark)).count() == 0
