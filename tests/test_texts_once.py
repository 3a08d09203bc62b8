"""Whole texts are shuffled, written and read no more often than a job needs."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmur.operators import ml as ML
from murmur.plans import fixtures as X
from murmur.plans import jobs, q_stream
from murmur.sources import adapter, files, sinks


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture()
def tables(spark, tmp_dir):
    docs = [(i, None if i == 3 else f"text {i}\nof a post", "src" if i % 2 else "other", 20) for i in [*range(12), 5]]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string, n_chars bigint").write.parquet(f"{tmp_dir}/documents.parquet")
    events = spark.createDataFrame([(i, float(i or 0)) for i in [*range(50), 10, None]], "event_id bigint, value double")
    events.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("event_id")).cast("timestamp_ntz")).write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(i, 1, 0) for i in (1, 2, 2)], "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(i, 0, "user", f"comment {i}") for i in range(5)], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    return tmp_dir


def test_posts_shuffle_texts_once(spark, tables, no_broadcast):
    posts = adapter.posts(spark, tables)
    plan = posts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # documents, events, labels
    got = sorted(r.id for r in posts.collect())
    assert got == sorted(["p5", "p5", "p2", *(f"p{i}" for i in range(10) if i != 5)])  # a document and an event that come twice


def test_enriched_table_is_compressed_well(spark, tables, tmp_dir):
    sinks.write_enriched_table(adapter.enriched(spark, tables), f"{tmp_dir}/table", "r1")
    names = [f for _, _, fs in os.walk(f"{tmp_dir}/table") for f in fs if f.endswith(".parquet")]
    assert names and all("zstd" in f for f in names)
    assert files.read_enriched_table(spark, f"{tmp_dir}/table").count() == 18


def test_raw_batches_are_compressed_and_read_back(spark, tmp_dir):
    d = spark.createDataFrame([(f"p{i}", "a\nb" * i, "s") for i in range(7)], "id string, title string, subreddit string")
    sinks.write_raw_batches(d, f"{tmp_dir}/raw", "t", ["k"], batch_size=2)
    assert all(f.endswith(".json.gz") for f in os.listdir(f"{tmp_dir}/raw") if f.startswith("part-"))
    back = files.read_raw_batches(spark, f"{tmp_dir}/raw", multi_line=False).select("id", "title", "subreddit")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, d.collect()))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_slices_are_moved_and_may_be_empty(spark, tmp_dir, fmt):
    d = spark.createDataFrame([(i, t) for i, t in enumerate([0.0, 1.0, 2.0, 99.0, 100.0])], "id bigint, t double")
    seen = []

    def run_once(src):
        seen.append(spark.read.schema("id bigint").format(fmt).option("recursiveFileLookup", True).load(src).count())

    q_stream.arrivals(d, "t", tmp_dir, run_once, fmt=fmt, n=4, replay_first=True)
    assert seen == [3, 3, 3, 5, 8]  # two slices without rows, then the first again
    assert not [n for n in os.listdir(f"{tmp_dir}/staging") if n.startswith("_slice=")]


def test_bounded_listing_reads_the_texts_once(spark, tables):
    batch = jobs.job_ingest(adapter.items(spark, tables), X.INGEST).batch
    assert "selftext" in batch.columns
    posts_n = jobs.ingest_candidates(adapter.items(spark, tables), X.INGEST)[0]
    plan = posts_n._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(text" not in plan  # the accepted posts are there already


def test_split_of_stored_rows(spark):
    d = spark.createDataFrame([(f"p{i}", "informative" if i % 3 else "emotional") for i in range(90)], f"id string, {ML.LABEL} string")
    stored = ML.store_rows(d)
    split = ML.ml_split(stored, stored=True)
    assert sorted(split.inputFiles()) == sorted(stored.inputFiles())
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, ML.ml_split(d).collect()))


def test_raw_batches_are_packed_where_the_items_are(spark, tmp_dir):
    d = spark.range(0, 23, numPartitions=3).select(F.concat(F.lit("p"), "id").alias("id"), F.lit("t").alias("selftext"), F.concat(F.lit("in"), F.spark_partition_id()).alias("subreddit"))
    n = sinks.write_raw_batches(d, f"{tmp_dir}/raw", "t", ["k"], batch_size=3)
    docs = spark.read.json(f"{tmp_dir}/raw").select("metadata.total_items", "metadata.processed_subreddits", F.size("data").alias("n"), F.array_distinct("data.subreddit").alias("of"), F.col("_metadata.file_name")).collect()
    assert all(len(x.of) == 1 for x in docs) and len({x.file_name for x in docs}) == 3  # no item left its task
    assert sorted(x.n for x in docs) == [1, 2, 2, *[3] * 6] and n == 9
    assert {(x.total_items, *x.processed_subreddits) for x in docs} == {(23, "in0", "in1", "in2")}
    back = files.read_raw_batches(spark, f"{tmp_dir}/raw", multi_line=False)
    assert sorted(r.id for r in back.collect()) == sorted(f"p{i}" for i in range(23))
    assert sinks.write_raw_batches(d.limit(0), f"{tmp_dir}/none", "t", ["k"]) == 0 == files.read_raw_batches(spark, f"{tmp_dir}/none", multi_line=False).count()


def test_documents_go_on_across_arrow_batches():
    ids = [str(i) for i in range(20)]
    batches = [pa.RecordBatch.from_arrays([pa.array([{"id": i, "score": None} for i in ids[a:b]], pa.struct({"id": pa.string(), "score": pa.int64()}))], names=["it"])
               for a, b in ((0, 2), (2, 2), (2, 13), (13, 20))]
    got = [doc for b in sinks._packed(5)(batches) for doc in b.column(0).to_pylist()]
    assert [len(x) for x in got] == [5, 5, 5, 5] and [y["id"] for x in got for y in x] == ids
    assert [len(x) for b in sinks._packed(7)(batches) for x in b.column(0).to_pylist()] == [7, 7, 6]
    assert [*sinks._packed(7)([])] == []
