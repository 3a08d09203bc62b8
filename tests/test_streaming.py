"""Failure model of the streaming sinks: replays do not duplicate, restarts only read new files."""

from pyspark.sql import functions as F

from murmur.schema import RAW_ITEM
from murmur.sources import adapter, files, sinks
from murmur.streaming import jobs as SJ
from murmur.streaming.files import drain_to_parquet
from tests.conftest import SF0001


def _items(spark):
    it = adapter.items(spark, SF0001)
    return it.select(*[f.name for f in RAW_ITEM.fields if f.name in it.columns])


def test_replayed_batch_rewrites_instead_of_appending(spark, tmp_dir):
    df = _items(spark)
    w = SJ.hwm_batch_writer(f"{tmp_dir}/out", f"{tmp_dir}/mark", None)
    w(df, 0)
    w(df, 0)  # the same micro-batch again, as after a failure between write and commit
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == df.count() and out.select("id").distinct().count() == df.count()
    mark = spark.read.parquet(f"{tmp_dir}/mark").agg(F.max("mark")).first()[0]
    assert mark == df.agg(F.max("created_utc")).first()[0]


def test_restart_reads_only_new_files(spark, tmp_dir):
    df = _items(spark)
    first, second = df.filter("type = 'post'"), df.filter("type = 'comment'")
    sinks.write_raw_batches(first, f"{tmp_dir}/src/arrival=a", "t", ["k"], batch_size=100)
    stream = lambda: files.raw_stream(spark, f"{tmp_dir}/src", max_files=3)
    drain_to_parquet(stream(), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == first.count()
    sinks.write_raw_batches(second, f"{tmp_dir}/src/arrival=b", "t", ["k"], batch_size=100)
    drain_to_parquet(stream(), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")  # restart from the same checkpoint
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == df.count() and out.select("id").distinct().count() == df.count()


def test_late_rows_dropped_by_mark(spark, tmp_dir):
    df = _items(spark)
    w = SJ.hwm_batch_writer(f"{tmp_dir}/out", f"{tmp_dir}/mark", None)
    new, old = df.filter("created_utc >= 1704153600"), df.filter("created_utc < 1704153600")
    w(new, 0)
    w(old, 1)  # arrives after the mark moved past it: strictly older rows are dropped
    assert spark.read.parquet(f"{tmp_dir}/out").count() == new.count()


def test_deltas_add_up_with_replays_and_compaction(spark, tmp_dir):
    keys, sums = ["k"], {"n": "bigint"}
    rows = lambda b: spark.createDataFrame([(f"k{i % 3}" if i % 7 else None, 1) for i in range(b + 5)], "k string, n bigint")
    write, want = SJ.delta_writer(tmp_dir, keys, sums, every=3), {}
    for b in range(8):
        write(rows(b), b)
        if b in (1, 3, 4, 6, 7):
            write(rows(b), b)  # the driver died before the commit: the same batch again
        for r in rows(b).collect():
            want[r.k] = want.get(r.k, 0) + 1
        got = {r.k: r.n for r in SJ.read_deltas(spark, tmp_dir, keys, sums, rows(0).schema).collect()}
        assert got == want, b
    assert sorted(sinks.folder_names(spark, f"{tmp_dir}/delta"))[0] == "batch_id=6" and [
        n for n in sinks.folder_names(spark, f"{tmp_dir}/base") if n.startswith("upto")] == ["upto=6"]


def test_half_written_base_is_not_read(spark, tmp_dir):
    rows = spark.createDataFrame([("a", 1)], "k string, n bigint")
    write = SJ.delta_writer(tmp_dir, ["k"], {"n": "bigint"}, every=2)
    for b in range(3):
        write(rows, b)
    p, fs = sinks._path(spark, f"{tmp_dir}/base/upto=2/_SUCCESS")
    fs.delete(p, False)
    assert SJ.read_deltas(spark, tmp_dir, ["k"], {"n": "bigint"}, rows.schema).first()["n"] == 3
    write(rows, 2)  # the replay completes it
    write(rows, 3)
    assert SJ.read_deltas(spark, tmp_dir, ["k"], {"n": "bigint"}, rows.schema).first()["n"] == 4
