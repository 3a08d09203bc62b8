"""Registered queries: split, training, prediction, evaluation and metrics."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.operators import filters as flt
from murmur.operators import ml as ML
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import r6, scored_cte, with_items
from murmur.plans.q_relational import LABELED_SQL, TRAINING_ROWS_SQL, labeled
from murmur.operators.aggregations import r6 as r6_col
from murmur.session import checkpoint_root, scratch_path
from murmur.sources import sinks

LAB = "informative_emotional_label"
KEEP = f"{LAB} IN ('informative', 'emotional')"
PRED_CTES = [TRAINING_ROWS_SQL, LABELED_SQL, scored_cte("lscored", "labeled", "text", where=KEEP),
             f"pred AS (SELECT id, {LAB} AS actual, lower(c_label) AS predicted FROM lscored)",
             "conf AS (SELECT actual, predicted, count(*) AS n FROM pred GROUP BY 1, 2)",
             """pc AS (SELECT cls,
    cast(coalesce((SELECT sum(n) FROM conf WHERE actual = c.cls), 0) AS bigint) AS support,
    cast(coalesce((SELECT sum(n) FROM conf WHERE predicted = c.cls), 0) AS double) AS npred,
    cast(coalesce((SELECT sum(n) FROM conf WHERE actual = c.cls AND predicted = c.cls), 0) AS double) AS tp
  FROM (SELECT actual AS cls FROM conf UNION SELECT predicted FROM conf) c)""",
             """m AS (SELECT cls, support,
    CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE tp / cast(support AS double) END AS recall FROM pc)""",
             "m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE precision * recall * 2 / (precision + recall) END AS f1 FROM m)"]


def labeled_only(spark, sf):
    return flt.flt_labeled(labeled(spark, sf))


def fixed_predictions(spark, sf):
    """A fixed predictions table: human label vs the cue-word scorer's class on the same text."""
    d = labeled_only(spark, sf)
    d = S.score_columns(d, F.col("text"), prediction_out="_pred", cues=X.CUES)
    return d.select("id", F.col(LAB).alias("actual"), F.col("_pred.predicted_class").alias("predicted"))


@query("ml_split", with_items(
    f"SELECT id, {LAB}, CASE WHEN row_number() OVER (PARTITION BY {LAB} ORDER BY md5(concat('{P.SPLIT_SEED}', id)), id) "
    f"<= round({P.SPLIT_TEST_SIZE} * count(*) OVER (PARTITION BY {LAB})) THEN 'test' ELSE 'train' END AS split "
    f"FROM labeled WHERE {KEEP}", TRAINING_ROWS_SQL, LABELED_SQL))
def q_ml_split(spark, sf):
    return ML.ml_split(labeled_only(spark, sf).select("id", LAB)).select("id", LAB, "split")


@query("agg_confusion", with_items("SELECT actual, predicted, n FROM conf", *PRED_CTES[:5]))
def q_agg_confusion(spark, sf):
    return ML.agg_confusion(fixed_predictions(spark, sf))


@query("agg_accuracy", with_items(
    f"SELECT {r6('avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM pred", *PRED_CTES[:4]))
def q_agg_accuracy(spark, sf):
    return ML.agg_accuracy(fixed_predictions(spark, sf))


WAVG = ", ".join(f"{r6(f'coalesce(sum({m} * support) / cast(sum(support) AS double), 0.0)')} AS {m}"
                 for m in ("precision", "recall", "f1"))


@query("agg_prf_weighted", with_items(f"SELECT {WAVG} FROM m2", *PRED_CTES))
def q_agg_prf_weighted(spark, sf):
    return ML.agg_prf_weighted(ML.agg_confusion(fixed_predictions(spark, sf)))


@query("agg_class_report", with_items(
    f"SELECT cls AS class, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1, support FROM m2 "
    f"UNION ALL SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')}, cast(sum(support) AS bigint) FROM m2 "
    f"UNION ALL SELECT 'weighted avg', {WAVG.replace(' AS precision', '').replace(' AS recall', '').replace(' AS f1', '')}, "
    f"cast(sum(support) AS bigint) FROM m2", *PRED_CTES))
def q_agg_class_report(spark, sf):
    return ML.agg_class_report(ML.agg_confusion(fixed_predictions(spark, sf)))


def _train(spark, sf, again=False):
    """Folder of the model trained on the labeled rows: like the original, training runs once, and
    prediction, evaluation and reports load what it saved. The folder is in the shared scratch root and
    named for the application and a digest of the training rows, so a changed table is trained anew;
    ``again``: train into a folder of its own whatever is there."""
    rows = ML.store_rows(labeled_only(spark, sf))  # read by the digest and the split
    if again:
        path = scratch_path(spark, "model")
    else:
        row = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("sum")).first()
        digest = hashlib.md5(f"{P.TrainParams()} {seen['n']} {seen['sum']}".encode()).hexdigest()[:16]
        path = f"{checkpoint_root(spark)}/murmur/model-{spark.sparkContext.applicationId}-{digest}"
    if again or not sinks.path_exists(spark, f"{path}/runs/_SUCCESS"):
        s = ML.ml_split(rows, stored=True)  # compares stored rows with a threshold; read by the features and every pass
        train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
        test.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/test")
        test = spark.read.schema(test.schema).parquet(f"{path}/test")
        _, runs = ML.ml_train(train, test, P.TrainParams(), path)
        runs.write.mode("overwrite").parquet(f"{path}/runs")
    return path


@query("ml_train")
def q_ml_train(spark, sf):
    """Runs table: validation accuracy per pass with the hyperparameters (the model is saved with
    its label map in the shared folder). Every call trains."""
    return spark.read.parquet(f"{_train(spark, sf, again=True)}/runs")


EPOCH_SQL = "SELECT cast(substr(id, 2) AS bigint) % 3 + 1 AS epoch, " + r6("avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END)") + " AS accuracy FROM pred WHERE id LIKE 'p%' GROUP BY 1"


@query("agg_best_epoch", with_items(f"SELECT cast(epoch AS integer) AS epoch, accuracy FROM ({EPOCH_SQL}) ORDER BY accuracy DESC, epoch LIMIT 1", *PRED_CTES[:4]))
def q_agg_best_epoch(spark, sf):
    """Of a runs table with three passes (the fixed predictions dealt by id), the best."""
    p = fixed_predictions(spark, sf).filter(F.col("id").like("p%"))
    epoch = (F.substring("id", 2, 20).cast("bigint") % 3 + 1).cast("int")
    runs = p.groupBy(epoch.alias("epoch")).agg(r6_col(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).alias("accuracy"))
    return ML.agg_best_epoch(runs)


@query("ml_predict")
def q_ml_predict(spark, sf):
    """The saved model, loaded again, on the test rows."""
    path = _train(spark, sf)
    p = ML.ml_predict(ML.load_model(path), spark.read.parquet(f"{path}/test"))
    return p.select("id", "predicted_class", "confidence", F.col("probabilities.informative").alias("p_informative"),
                    F.col("probabilities.emotional").alias("p_emotional"))


@query("ml_evaluate", with_items(
    f"SELECT (SELECT {r6('avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END)')} FROM pred) AS accuracy, {WAVG} FROM m2", *PRED_CTES))
def q_ml_evaluate(spark, sf):
    return ML.evaluate(fixed_predictions(spark, sf))
