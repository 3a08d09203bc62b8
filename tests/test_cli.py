"""The command line chains the jobs through files, as a user of the original pipeline would."""

from murmur import cli
from murmur import params as P
from murmur.operators import aggregations as A
from murmur.plans import fixtures as X
from murmur.plans import jobs
from murmur.sources import adapter, files, sinks
from tests.conftest import SF001


def test_cli_pipeline(spark, tmp_dir):
    it = adapter.items(spark, SF001)
    sinks.write_raw_batches(it, f"{tmp_dir}/raw", "t", ["k"], batch_size=300)
    it.write.parquet(f"{tmp_dir}/items")

    for _ in range(2):  # a replay of a run changes nothing
        cli.main(["enrich", "--input", f"{tmp_dir}/raw", "--output", f"{tmp_dir}/enriched", "--run", "r1"])
    direct = jobs.job_enrich(files.read_raw_batches(spark, f"{tmp_dir}/raw"))
    assert spark.read.parquet(f"{tmp_dir}/enriched").count() == direct.count()

    cli.main(["rollup", "--input", f"{tmp_dir}/enriched", "--output", f"{tmp_dir}/dual", "--kind", "dual"])
    got = spark.read.parquet(f"{tmp_dir}/dual")
    want = A.agg_dual_class(direct)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0

    cli.main(["dashboard", "--input", f"{tmp_dir}/enriched", "--output", f"{tmp_dir}/dash", "--ticker", "MIT"])
    assert spark.read.text(f"{tmp_dir}/dash").first()[0].startswith('{"trend_data":')

    cli.main(["search", "--input", f"{tmp_dir}/items", "--output", f"{tmp_dir}/search", "--ticker", "MIT",
              "--timeframe", "30d", "--as-of", str(X.AS_OF), "--communities", ",".join(f"src{k}" for k in range(20))])
    assert '"ticker":"MIT"' in spark.read.text(f"{tmp_dir}/search").first()[0]

    def ingest(run):
        cli.main(["ingest", "--input", f"{tmp_dir}/items", "--output", f"{tmp_dir}/ingest", "--keywords", "mit,worth,the", "--ignore",
                  "license,http", "--no-relevance", "--run", run, "--communities", ",".join(f"src{k}" for k in range(20))])
        return files.read_raw_batches(spark, f"{tmp_dir}/ingest/batch", multi_line=False)

    first = ingest("1").count()
    assert first >= P.INGEST_POST_LIMIT
    mark = sinks.stored_mark(spark, f"{tmp_dir}/ingest/mark", before="2")
    again = ingest("2").subtract(spark.createDataFrame([], files.read_raw_batches(spark, f"{tmp_dir}/ingest/batch", multi_line=False).schema))
    assert mark is not None and again.filter(f"created_utc < {mark}").count() <= first  # the second run began at the stored mark
    assert sinks.stored_mark(spark, f"{tmp_dir}/ingest/mark", before="3") >= mark

    cli.main(["extract", "--input", f"{tmp_dir}/enriched", "--output", f"{tmp_dir}/train_csv", "--limit", "500"])
    ex = files.read_training_csv(spark, f"{tmp_dir}/train_csv")
    assert 0 < ex.count() <= 500

    cli.main(["label", "--input", f"{tmp_dir}/train_csv", "--output", f"{tmp_dir}/labeled"])
    import glob
    final = [p for p in glob.glob(f"{tmp_dir}/labeled/ai_labeled_*")][0]
    lab = files.read_training_csv(spark, final)
    assert lab.count() == ex.count() and lab.filter("informative_emotional_label = ''").count() == 0

    cli.main(["train", "--input", final, "--output", f"{tmp_dir}/model"])
    assert spark.read.parquet(f"{tmp_dir}/model/runs").count() == len(P.TrainParams().passes)
    cli.main(["score", "--input", final, "--output", f"{tmp_dir}/scored", "--model", f"{tmp_dir}/model"])
    cli.main(["score", "--input", final, "--output", f"{tmp_dir}/scored2", "--model", f"{tmp_dir}/model"])
    a, b = (spark.read.parquet(f"{tmp_dir}/{x}").select("id", "predicted_class", "confidence") for x in ("scored", "scored2"))
    assert a.count() == lab.count() and a.exceptAll(b).count() == 0
    cli.main(["enrich", "--input", f"{tmp_dir}/raw", "--output", f"{tmp_dir}/enriched", "--run", "r2", "--model", f"{tmp_dir}/model"])
    runs = {r["run"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/enriched").groupBy("run").count().collect()}
    assert runs == {"r1": direct.count(), "r2": direct.count()}  # the first run is still there
