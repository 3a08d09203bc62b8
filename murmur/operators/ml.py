"""Training, prediction and evaluation with ``pyspark.ml``; metrics as aggregates.

The original fine-tunes a transformer on one machine. Here the classifier is a distributed
``RegexTokenizer -> HashingTF -> IDF -> LogisticRegression`` pipeline; predictions stay
distributed and every metric is an aggregate over a (classes x classes) confusion table, so
nothing is collected but a handful of numbers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import params as P
from murmur.operators.aggregations import r6
from murmur.operators.projections import index_label, label_index
from murmur.session import checkpoint_root

LABEL = "informative_emotional_label"
BUCKET_BITS = 16  # the hash space is cut into 2^16 buckets to find each label's split point


# ------------------------------------------------------------------ split

def split_hash(id_col: str, seed: int) -> tuple[Column, Column]:
    """(60-bit integer, full hex) of md5(seed || id): uniform, stable under repartitioning."""
    hexd = F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))
    return F.conv(F.substring(hexd, 1, 15), 16, 10).cast("bigint"), hexd


def store_rows(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own in the shared scratch folder, read again."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/murmur/split-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ml_split(df: DataFrame, label: str = LABEL, id_col: str = "id", test_size: float = P.SPLIT_TEST_SIZE,
             seed: int = P.SPLIT_SEED, stored: bool = False) -> DataFrame:
    """Exact stratified split: per label, the round(test_size * n) rows with the smallest
    md5(seed || id) go to test. Distributed: counts per (label, hash bucket) find the bucket
    holding each label's cut (a prefix sum over at most 2^16 rows per label); only the rows of that
    bucket are ranked, which gives one threshold per label, and every row is compared with its
    label's threshold in place: whole rows are never shuffled. The rows are read three times, so they
    are written once to the shared scratch folder first (``df`` may hold joins and text filters), unless
    they are ``stored`` already."""
    h, hexd = split_hash(id_col, seed)
    if not stored:
        df = store_rows(df)
    d = df.withColumn("_h", h).withColumn("_hex", hexd).withColumn(
        "_b", F.shiftright(F.col("_h"), 60 - BUCKET_BITS))
    per_bucket = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    wl = W.partitionBy(label)
    wcum = W.partitionBy(label).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    cut = (per_bucket
           .withColumn("_n", F.sum("_nb").over(wl))
           .withColumn("_k", F.round(F.col("_n") * test_size).cast("bigint"))
           .withColumn("_before", F.coalesce(F.sum("_nb").over(wcum), F.lit(0)))
           .filter((F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_nb") >= F.col("_k")))
           .select(label, F.col("_b").alias("_cut_b"), (F.col("_k") - F.col("_before")).alias("_need")))
    # both tables that are broadcast have one row per label
    rank = F.row_number().over(W.partitionBy(label).orderBy("_h", "_hex", id_col))
    at = F.struct("_h", "_hex", F.col(id_col))
    last = (d.select(label, "_h", "_hex", "_b", id_col).join(F.broadcast(cut), label).filter(F.col("_b") == F.col("_cut_b"))
            .withColumn("_r", rank).filter(F.col("_r") <= F.col("_need")).groupBy(label).agg(F.max(at).alias("_last")))
    is_test = F.coalesce(at <= F.col("_last"), F.lit(False))
    return (d.join(F.broadcast(last), label, "left").withColumn("split", F.when(is_test, "test").otherwise("train"))
            .drop("_h", "_hex", "_b", "_last"))


# ------------------------------------------------------------------ train / predict

def feature_pipeline(p: P.TrainParams) -> Pipeline:
    tok = RegexTokenizer(inputCol="text", outputCol="_tokens", pattern="[^a-z]+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=p.num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    return Pipeline(stages=[tok, tf, idf])


def classifier(p: P.TrainParams, max_iter: int) -> LogisticRegression:
    return LogisticRegression(featuresCol="_features", labelCol="label_index", maxIter=max_iter,
                              regParam=p.reg_param, family="binomial")


def ml_train(train: DataFrame, valid: DataFrame, p: P.TrainParams = P.TrainParams(),
             save_to: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit the text features once, then one classifier per pass count (maxIter = pass x
    max_iter / passes); score the validation rows after each and keep the best (earliest on
    ties). Returns the best pipeline and the runs table (pass, validation accuracy,
    hyperparameters). The feature frame is persisted while the passes iterate over it."""
    train = train.withColumn("label_index", label_index(F.col(LABEL)).cast("double"))
    feats = feature_pipeline(p).fit(train)
    cached = feats.transform(train).select("_features", "label_index").persist()
    runs, models = [], {}
    per_pass = max(1, p.max_iter // max(p.passes))
    try:
        for k in p.passes:
            m = PipelineModel(stages=list(feats.stages) + [classifier(p, per_pass * k).fit(cached)])
            models[k] = m
            acc = agg_accuracy(ml_predict(m, valid).select(F.col(LABEL).alias("actual"),
                                                           F.col("predicted_class").alias("predicted"))).first()["accuracy"]
            runs.append((k, float(acc or 0.0), per_pass * k, p.reg_param, p.num_features))
    finally:
        cached.unpersist()
    spark = train.sparkSession
    runs_df = spark.createDataFrame(runs, "epoch int, accuracy double, max_iter int, reg_param double, num_features int")
    best = agg_best_epoch(runs_df).first()["epoch"]
    model = models[best]
    if save_to:
        model.write().overwrite().save(f"{save_to}/pipeline")
        spark.createDataFrame([(json.dumps({"label_map": P.LABEL_MAP,
                                            "reverse_label_map": {str(v): k for k, v in P.LABEL_MAP.items()}}),)],
                              "mapping string").write.mode("overwrite").text(f"{save_to}/label_mapping")
    return model, runs_df


def load_model(path: str) -> PipelineModel:
    """The pipeline that :func:`ml_train` saved under ``path``."""
    return PipelineModel.load(f"{path}/pipeline")


def ml_predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """class = argmax, confidence = max probability, both probabilities (index order)."""
    out = model.transform(df).withColumn("_p", vector_to_array(F.col("probability")))
    pr = F.col("_p")
    keep = [c for c in df.columns]
    return out.select(
        *keep,
        index_label(F.when(pr[0] >= pr[1], F.lit(0)).otherwise(F.lit(1))).alias("predicted_class"),
        F.array_max(pr).alias("confidence"),
        F.struct(pr[0].alias("informative"), pr[1].alias("emotional")).alias("probabilities"))


# ------------------------------------------------------------------ metrics

def agg_confusion(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return pred.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def agg_accuracy(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return pred.agg(r6(F.avg((F.col(actual) == F.col(predicted)).cast("double"))).alias("accuracy"))


def per_class(confusion: DataFrame) -> DataFrame:
    """Per class of actual ∪ predicted: precision, recall, F1 and support (0 when undefined)."""
    # one pass: each confusion cell adds to its actual class (support, tp) and its predicted class
    contrib = F.explode(F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("npred"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("npred"),
                 F.lit(0).cast("bigint").alias("tp"))))
    c = (confusion.select(contrib.alias("c")).groupBy("c.cls")
         .agg(F.sum("c.support").alias("support"), F.sum("c.npred").alias("npred"), F.sum("c.tp").alias("tp")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall")), F.lit(0.0))
    return c.withColumn("f1", f1).select("cls", "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))


def agg_prf_weighted(confusion: DataFrame) -> DataFrame:
    pc = per_class(confusion)
    tot = F.sum("support").cast("double")
    return pc.agg(*[r6(F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), tot), F.lit(0.0))).alias(m)
                    for m in ("precision", "recall", "f1")])


def agg_class_report(confusion: DataFrame) -> DataFrame:
    """Per-class rows plus macro and weighted averages, in one aggregate: every class row is sent
    to its own report key and to the two average keys."""
    pc = per_class(confusion)
    keys = F.explode(F.array(F.struct(F.col("cls").alias("k"), F.lit("class").alias("kind")),
                             F.struct(F.lit("macro avg").alias("k"), F.lit("macro").alias("kind")),
                             F.struct(F.lit("weighted avg").alias("k"), F.lit("weighted").alias("kind"))))
    d = pc.select(keys.alias("r"), "precision", "recall", "f1", "support")
    tot = F.sum("support")

    def metric(m: str) -> Column:
        weighted = F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), tot.cast("double")), F.lit(0.0))
        return r6(F.when(F.first("r.kind") == "weighted", weighted).otherwise(F.avg(m))).alias(m)

    return d.groupBy(F.col("r.k").alias("class")).agg(
        *[metric(m) for m in ("precision", "recall", "f1")], tot.cast("bigint").alias("support"))


def agg_best_epoch(runs: DataFrame) -> DataFrame:
    """Best validation accuracy; the earliest pass wins ties (the original keeps a model only on a
    strict improvement)."""
    return runs.agg(F.max_by(F.struct("epoch", "accuracy"), F.struct(F.col("accuracy"), -F.col("epoch"))).alias("b")).select(
        F.col("b.epoch").alias("epoch"), F.col("b.accuracy").alias("accuracy"))


def evaluate(pred: DataFrame) -> DataFrame:
    """Accuracy and weighted P/R/F1 of a predictions frame (actual, predicted)."""
    conf = agg_confusion(pred)
    acc = agg_accuracy(pred)
    prf = agg_prf_weighted(conf)
    return acc.unionByName(prf, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])
