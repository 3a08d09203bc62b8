"""Ids of earlier runs as bits: the rows of the anti join, with less exchanged."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from murmur.operators import dedup as D
from tests.conftest import SF0001
from tools.check_oracles import compare, duck


@pytest.mark.parametrize("words", [1, 1 << 12])  # one word a segment: nearly every id is a possible hit
def test_rows_of_the_anti_join(spark, words):
    rng = random.Random(4)
    seen_ids = [f"s{k}" for k in range(20000)]
    new_ids = rng.sample(seen_ids, 300) + [f"n{k}" for k in range(700)] + ["n1", "s1", None, None]
    new = spark.createDataFrame([(i, k) for k, i in enumerate(new_ids)], "id string, at int")
    seen = spark.createDataFrame([(i,) for i in seen_ids + [None]], "id string")
    got = D.dedup_ids_by_bits(new, seen, D.id_bits(seen, words=words), words=words)
    want = D.dedup_ids(new, seen)
    assert sorted(r["at"] for r in got.collect()) == sorted(r["at"] for r in want.collect())
    maybe = D.may_hold(new, D.id_bits(seen, words=words), words=words).where("_maybe").count()
    assert maybe >= 301 and (maybe < 310 if words > 1 else maybe > 900)


def test_runs_are_merged_and_repeated(spark, tmp_dir):
    for run, lo in (("a", 0), ("b", 50), ("b", 50)):
        D.write_id_bits(spark.range(lo, lo + 50).select(F.col("id").cast("string")), tmp_dir + "/bits", run)
    bits = spark.read.parquet(tmp_dir + "/bits")
    assert bits.select("run").distinct().count() == 2
    asked = spark.range(0, 200).select(F.col("id").cast("string"))
    held = {int(r["id"]) for r in D.may_hold(asked, bits).where("_maybe").collect()}
    assert held >= set(range(100)) and len(held) < 105


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], "id string"), spark.createDataFrame([("a",), (None,)], "id string")
    assert D.dedup_ids_by_bits(some, none, D.id_bits(none)).count() == 2
    assert D.dedup_ids_by_bits(none, some, D.id_bits(some)).count() == 0


def test_bits_are_tested_before_the_exchange(spark, tmp_dir):
    spark.range(1000).select(F.col("id").cast("string")).write.parquet(tmp_dir + "/seen")
    seen = spark.read.parquet(tmp_dir + "/seen")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.dedup_ids_by_bits(seen, seen, D.id_bits(seen))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):]
    sides = join.split("hashpartitioning(id")[1:]
    assert len(sides) == 2 and all("BroadcastHashJoin" in s and "Filter" in s for s in sides)


@pytest.mark.parametrize("name", ["dedup_ids_by_bits", "stm_dedup_content", "dedup_ids"])
def test_queries(spark, name):
    r = compare(spark, duck(SF0001), name, E.queries()[name], E.oracle_sql()[name], SF0001)
    assert r["ok"], r


def test_model_folder_follows_the_training_rows(spark, monkeypatch):
    from murmur.plans import q_ml
    rows = q_ml.labeled_only(spark, SF0001)
    first = q_ml._train(spark, SF0001)
    assert q_ml._train(spark, SF0001) == first
    monkeypatch.setattr(q_ml, "labeled_only", lambda s, f: rows.limit(rows.count() - 1))
    assert q_ml._train(spark, SF0001) != first
