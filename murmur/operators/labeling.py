"""Training-set extraction and labeling as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import params as P
from murmur.functions import scorers as S
from murmur.functions.text import first
from murmur.operators import filters as flt
from murmur.operators.projections import prj_training_row, training_text
from murmur.sources.tables import table

LABEL = flt.LABEL_COL


def extraction(enriched: DataFrame, min_score: int = P.EXTRACT_MIN_SCORE,
               min_length: int = P.EXTRACT_MIN_LENGTH) -> DataFrame:
    return flt.flt_extraction(enriched, min_score, min_length).withColumn("text", training_text())


def top_extraction(df: DataFrame, limit: int = P.EXTRACT_LIMIT) -> DataFrame:
    """score desc, created desc (id breaks ties) and LIMIT: a TakeOrderedAndProject, i.e. a
    per-task top-N and one bounded merge."""
    return df.orderBy(F.col("score").desc(), F.col("created_utc").desc(), F.col("id")).limit(limit)


def training_rows(enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """flt_extraction -> [top_extraction] -> flt_labelable -> prj_clean_text/prj_training_row."""
    d = extraction(enriched)
    if limit is not None:
        d = top_extraction(d, limit)
    return prj_training_row(flt.flt_labelable(d, "text"))


def labels_for(spark, sf_dir: str) -> DataFrame:
    """Human labels from the driver's ``labels``: quality 1 -> informative, 0 -> emotional."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lab.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("id"),
                      F.when(F.col("quality") == 1, "informative").when(F.col("quality") == 0, "emotional")
                      .alias("human_label"))


def labeled_table(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows with the label column filled where a human label exists ('' otherwise)."""
    j = rows.join(labels, "id", "left")
    return j.withColumn(LABEL, F.coalesce(F.col("human_label"), F.lit(""))).drop("human_label")


RULE_CUES = (P.INFORMATIVE_CUES, P.EMOTIONAL_CUES)


def label_replies(df: DataFrame, text: str = "text", cues: tuple = RULE_CUES, cut: int | None = None) -> DataFrame:
    """The labeler's reply for each row: the content scorer's class (stand-in for the hosted
    model; it reads the whole text, or the first ``cut`` characters), or null when the text cannot
    be scored."""
    d = S.score_columns(df.withColumn("_lt", first(text, cut)), F.col("_lt"), prediction_out="_pred", cues=cues)
    return d.withColumn("reply", F.when(S.scoring_error(F.col("_lt")).isNull(), F.col("_pred.predicted_class"))).drop(
        "_lt", "_pred")


def lbl_ai_label(table_df: DataFrame, run_timestamp: str, cues: tuple = RULE_CUES, cut: int | None = None) -> DataFrame:
    """Label the unlabeled rows and merge back: informative / emotional get the labeler and a note,
    anything else becomes needs_review with the error labeler. Labeled rows stay as they are."""
    # in place (one pass over the table): only unlabeled rows are scored and changed
    unl = F.coalesce(F.col(LABEL), F.lit("")) == ""
    d = label_replies(table_df.withColumn("_todo_text", F.when(unl, F.col("text"))), "_todo_text", cues, cut)
    new = F.when(unl, S.normalize_label(F.col("reply")))
    ok = new.isin(*P.LABELS)
    return d.select(
        *[c for c in table_df.columns if c not in (LABEL, "labeler", "labeling_notes")],
        F.when(unl & ok, new).when(unl, F.lit(P.LABEL_NEEDS_REVIEW)).otherwise(F.col(LABEL)).alias(LABEL),
        F.when(unl & ok, F.lit(P.LABELER_OK)).when(unl, F.lit(P.LABELER_ERROR)).otherwise(F.col("labeler")).alias("labeler"),
        F.when(unl & ok, F.lit(P.LABEL_NOTE.format(run_timestamp))).otherwise(F.col("labeling_notes")).alias("labeling_notes"),
        unl.alias("processed_this_run"))


def join_label_merge(all_rows: DataFrame, scored: DataFrame, run_timestamp: str) -> DataFrame:
    """Write labels back by id (left join); only rows that were unlabeled change."""
    ok = F.col("new_label").isin(*P.LABELS)
    j = all_rows.join(scored, "id", "left")
    touched = F.col("new_label").isNotNull()
    return j.select(
        *[c for c in all_rows.columns if c not in (LABEL, "labeler", "labeling_notes")],
        F.when(touched & ok, F.col("new_label")).when(touched, F.lit(P.LABEL_NEEDS_REVIEW))
         .otherwise(F.col(LABEL)).alias(LABEL),
        F.when(touched & ok, F.lit(P.LABELER_OK)).when(touched, F.lit(P.LABELER_ERROR))
         .otherwise(F.col("labeler")).alias("labeler"),
        F.when(touched & ok, F.lit(P.LABEL_NOTE.format(run_timestamp))).otherwise(F.col("labeling_notes"))
         .alias("labeling_notes"),
        touched.alias("processed_this_run"))
