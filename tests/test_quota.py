"""The quota as a parallel scan and as keyed state: equal to the walk over the requests in order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import windows as WN
from murmur.streaming import jobs as SJ


def times(kind, n, seed=0):
    rng = np.random.default_rng(seed)
    if kind == "steady":
        return np.arange(n) * 7.0
    if kind == "random":
        return np.sort(rng.uniform(0, n * 40.0, n)).round(3)
    bursts = np.concatenate([start + rng.uniform(0, 300, n // 8) for start in rng.uniform(0, n * 300.0, 8)])
    return np.sort(np.floor(bursts))  # equal times too


@pytest.mark.parametrize("kind", ["steady", "random", "bursts"])
@pytest.mark.parametrize("limit", [1, 3, 10])
def test_block_maps_compose(kind, limit):
    ts = times(kind, 800, limit)
    rng = np.random.default_rng(limit)
    want = WN.quota_reference([(0, t) for t in ts], limit)
    cuts = [0, *sorted(set(rng.integers(1, len(ts), 9).tolist())), len(ts)]
    state, got, known = [], [], 0
    for a, z in zip(cuts, cuts[1:]):
        flags, kept = WN.quota_segment(state, ts[a:z], limit, 3600.0)
        alone = WN.quota_exit(None, ts[a:z], limit, 3600.0)
        assert alone is None or alone == kept
        known += alone is not None
        assert WN.quota_exit(state, ts[a:z], limit, 3600.0) == kept
        got, state = got + flags.tolist(), kept
    assert got == want and (kind != "steady" or not known)


def test_known_exit_of_sparse_requests():
    ts = np.array([0.0, 1, 2, 3, 9000, 18000, 27000, 27001, 27002, 27003])
    assert WN.quota_exit(None, ts, 3, 3600.0) == WN.quota_exit([-5.0, -4.0, -3.0], ts, 3, 3600.0) == [27000.0, 27001.0, 27002.0]


@pytest.mark.parametrize("kind", ["steady", "random", "bursts"])
def test_one_client_is_many_tasks(spark, kind):
    ts = times(kind, 2000)
    rows = [(i, 7, float(t)) for i, t in enumerate(ts)] + [(5000 + i, i % 5, float(i * 900)) for i in range(40)]
    d = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts_s double").repartition(5)
    got = {r.event_id: r.accepted for r in WN.sliding_quota(d, limit=10, block_rows=100).collect()}
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    assert got == dict(zip([r[0] for r in ordered], WN.quota_reference([(k, t) for _, k, t in ordered], 10)))
    blocks = WN.quota_segments(d, "user_id", "ts_s", 3600.0, 100).filter("user_id = 7").groupBy("_seg", "_block").count().collect()
    assert len(blocks) >= 8 and sum(r["count"] for r in blocks) == 2000
    if kind == "steady":  # one segment: its blocks go to several tasks
        assert max(r["count"] for r in blocks) <= 200
        assert WN.quota_segments(d, "user_id", "ts_s", 3600.0, 100).filter("user_id = 7").repartition(8, "user_id", "_seg", "_block").select(
            F.spark_partition_id().alias("p")).distinct().count() >= 3


def test_no_requests(spark):
    d = spark.createDataFrame([], "event_id bigint, user_id bigint, ts_s double")
    assert WN.sliding_quota(d).collect() == []


def feed(spark, folder, parts, **how):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts_s double").coalesce(1).write.parquet(f"{folder}/in/arrival={i}")
        stream = spark.readStream.schema("event_id bigint, user_id bigint, ts_s double").parquet(f"{folder}/in")
        SJ.stm_quota(stream, f"{folder}/out", f"{folder}/ckpt", **how)  # a restart each time


def test_stream_out_of_order_and_restarts(spark, tmp_dir):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 4)), float(round(t, 3))) for i, t in enumerate(np.sort(rng.uniform(0, 30_000, 400)))]
    arrives = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 500))
    parts = [arrives[a:a + 100] for a in range(0, 400, 100)] + [[(None, None, 60_000.0)]]
    feed(spark, tmp_dir, parts, limit=3, delay_s=600.0)
    got = {r.event_id: r.accepted for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == dict(zip([r[0] for r in rows], WN.quota_reference([(k, t) for _, k, t in rows], 3)))
    assert 0 < sum(got.values()) < 400


def test_stream_late_requests_have_no_verdict_and_idle_clients_expire(spark, tmp_dir):
    parts = [[(1, 1, 100.0), (2, 1, 101.0), (3, 2, 50.0)], [(4, 3, 9000.0)], [(5, 1, 102.0), (6, 1, 9001.0)], [(None, None, 50_000.0)], [(None, None, 60_000.0)]]
    feed(spark, tmp_dir, parts, limit=1, delay_s=60.0)
    got = {r.event_id: r.accepted for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 6: True}  # 5 came 8838 s after the watermark
    states = spark.read.format("statestore").load(f"{tmp_dir}/ckpt")
    assert states.count() == 0


def test_stream_calls_do_not_grow_with_the_clients(spark, tmp_dir):
    rng = np.random.default_rng(8)
    rows = [(2**60 + i, 2**60 + int(rng.integers(0, 60)), float(round(t, 3))) for i, t in enumerate(np.sort(rng.uniform(0, 20_000, 700)))]
    arrives = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 500))
    parts = [arrives[:350] + [(None, None, 0.0)], arrives[350:], [(None, None, 22_000.0)]]
    feed(spark, tmp_dir, parts, limit=2, delay_s=600.0, groups=4)
    assert 0 < spark.read.format("statestore").load(f"{tmp_dir}/ckpt").count() <= 4  # a row for each group
    feed_last = spark.createDataFrame([(None, None, 90_000.0)], "event_id bigint, user_id bigint, ts_s double").coalesce(1)
    feed_last.write.parquet(f"{tmp_dir}/in/arrival=9")
    SJ.stm_quota(spark.readStream.schema(feed_last.schema).parquet(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", limit=2, delay_s=600.0, groups=4)
    got = [(r.event_id, r.user_id, r.ts_s, r.accepted) for r in spark.read.parquet(f"{tmp_dir}/out").collect()]
    want = WN.quota_reference([(k, t) for _, k, t in rows], 2)
    assert sorted(got) == [(*r, a) for r, a in zip(rows, want)] and 0 < sum(want) < 700
