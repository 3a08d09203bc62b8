"""Schema inference over runs, and batch runs that are killed and resumed."""

import json

import pytest
from pyspark.sql import functions as F

from murmur.sources import runs, schemas


def lines(spark, path, rows):
    spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string").repartition(2).write.mode("overwrite").text(path)


def test_schema_grows_widens_and_keeps(spark, tmp_dir):
    log, data = f"{tmp_dir}/log", f"{tmp_dir}/data"
    first = [{"id": 1, "n": 5, "ok": True, "of": {"a": 1, "x": [1, 2]}, "none": None, "big": 2**70}, {"id": 2, "gone": "z"}, "{broken", "[1]", "{}"]
    second = [{"id": 3, "n": 2.5, "ok": "yes", "of": {"a": "t", "b": False, "x": [0.5]}, "new": {}}, {"id": 4, "none": None, "of": None, "list": []}]
    third = [{"id": "five", "of": "now text", "n": None, "a.b": 1}]
    for run, rows in enumerate([first, second, third]):
        lines(spark, f"{data}/run={run}", rows)
        schemas.crawl(spark, f"{data}/run={run}", log, run)
    assert schemas.schema_of(spark, log, 0).simpleString() == "struct<big:double,gone:string,id:bigint,n:bigint,none:string,of:struct<a:bigint,x:array<bigint>>,ok:boolean>"
    two = "struct<big:double,gone:string,id:bigint,list:array<string>,n:double,new:string,none:string,of:struct<a:string,b:boolean,x:array<double>>,ok:string>"
    assert schemas.schema_of(spark, log, 1).simpleString() == two
    d = schemas.read_evolving_json(spark, data, log)
    assert {f.name: f.dataType.simpleString() for f in schemas.schema_of(spark, log)} == {
        "a.b": "bigint", "big": "double", "gone": "string", "id": "string", "list": "array<string>", "n": "double", "new": "string", "none": "string", "of": "string", "ok": "string"}
    got = {r["id"]: r for r in d.filter("id is not null").collect()}
    assert (got["1"]["n"], got["3"]["n"], got["1"]["ok"], got["five"]["of"]) == (5.0, 2.5, "true", "now text")
    assert json.loads(got["1"]["of"]) == {"a": 1, "x": [1, 2]} and got["2"]["gone"] == "z" and got["five"]["a.b"] == 1
    change = {(r["run"], r["field"]): (r["old_type"], r["new_type"]) for r in schemas.changes(spark, log).collect()}
    assert change[1, "n"] == ("bigint", "double") and change[2, "of"] == ("struct", "string") and change[0, "gone"] == (None, "string") and (1, "id") not in change
    schemas.crawl(spark, f"{data}/run=1", log, 1)  # a replay changes nothing
    assert schemas.schema_of(spark, log, 1).simpleString() == two


def test_merge_is_associative():
    order = [schemas.BOOL, schemas.LONG, schemas.DOUBLE, schemas.TEXT, schemas.OBJECT, schemas.LIST, 0]
    for a in order:
        for b in order:
            for c in order:
                assert (a | b) | c == a | (b | c) and a | b == b | a and a | a == a
    assert schemas._type(schemas.LONG | schemas.BOOL, (), {}).simpleString() == "string"


def test_no_files_no_fields(spark, tmp_dir):
    lines(spark, f"{tmp_dir}/in", [""])
    schemas.crawl(spark, f"{tmp_dir}/in", f"{tmp_dir}/log", 0)
    assert schemas.schema_of(spark, f"{tmp_dir}/log").simpleString() == "struct<>" and schemas.changes(spark, f"{tmp_dir}/log").count() == 0


def test_killed_run_resumes(spark, tmp_dir):
    rows = spark.range(200).select(F.concat(F.lit("p"), "id").alias("id"), F.col("id").alias("n"))
    calls = []

    def work(fail_at):
        def run(d):
            calls.append(1)
            bad = F.when(F.lit(len(calls) > fail_at), F.raise_error(F.lit("killed"))).otherwise(F.lit("done"))
            return d.select("id", (F.col("n") * 2).alias("twice"), F.concat(F.lit(f"call {len(calls)} "), bad.cast("string")).alias("by"))
        return run

    with pytest.raises(Exception, match="killed"):
        runs.run_slices(rows, tmp_dir, work(3), n_slices=8)
    assert len(runs.open_slices(spark, tmp_dir, 8)) == 5
    committed = {r.id: r.by for r in spark.read.parquet(*[f"{tmp_dir}/output/slice={k}" for k in range(3)]).collect()}
    # the input may have changed meanwhile: the run goes on with what it was dealt
    done = runs.run_slices(rows.limit(3), tmp_dir, work(10**9), n_slices=5)
    got = {r.id: r for r in done.collect()}
    assert done.count() == len(got) == 200 and all(r.twice == 2 * int(r.id[1:]) for r in got.values())
    assert {i: got[i].by for i in committed} == committed and runs.open_slices(spark, tmp_dir, 8) == []
    again = len(calls)
    assert runs.run_slices(rows, tmp_dir, work(10**9)).count() == 200 and len(calls) == again + 1  # for the schema only


def test_slices_without_rows(spark, tmp_dir):
    rows = spark.range(2).select(F.col("id").cast("string").alias("id"))
    assert runs.run_slices(rows, f"{tmp_dir}/a", lambda d: d, n_slices=20, at_most=0).count() == 0
    assert runs.run_slices(rows, f"{tmp_dir}/a", lambda d: d).count() == 2
    assert runs.run_slices(rows.limit(0), f"{tmp_dir}/b", lambda d: d, n_slices=2).count() == 0
