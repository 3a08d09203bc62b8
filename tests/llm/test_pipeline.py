"""The pipeline's stages on odd rows, an empty table, rows of one id, and emptied texts."""

import corpus_pipeline as C
from murmur.llm import simhash, substrings
from tests.conftest import SF0001
from tests.llm.cases import SCHEMA, empty, odd, rows


def test_stages_on_odd_rows(spark, tmp_path):
    docs = odd(spark)
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF0001)
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_each_stage_on_an_empty_table(spark):
    for name, stage in C.STAGES:
        assert stage(spark, empty(spark), SF0001).count() == 0, name


def test_rows_of_one_id_with_unrelated_texts_stay(spark):
    texts = [" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma")]
    docs = spark.createDataFrame(rows([(1, texts[0], "a"), (1, texts[1], "a"), (2, texts[2], "a"), (3, texts[2], "a")]), SCHEMA)
    kept = simhash.representatives(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2])])


def test_a_text_that_is_only_a_repeated_passage_is_kept_as_an_empty_row(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    own = " ".join(f"v{k}" for k in range(300))
    docs = spark.createDataFrame(rows([(1, f"{own} {passage}", "a"), (2, passage, "a")]), SCHEMA)
    kept = {r["doc_id"]: r["text"] for r in substrings.without_repeats(docs, length_col="n_chars").collect()}
    assert kept == {1: f"{own} {passage}", 2: ""}


def test_clean_documents_stay_in_the_first_stages(spark):
    texts = [" ".join(f"{w}{k * 31 % 97}" for k in range(80)) for w in ("north", "south", "east")]
    clean = spark.createDataFrame(rows([(k, t, "a") for k, t in enumerate(texts)]), SCHEMA)
    out = clean
    for _, stage in C.STAGES[:3]:
        out = stage(spark, out, SF0001)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == list(enumerate(texts))
