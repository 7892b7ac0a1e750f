"""Reference entry 2 as Spark jobs: features -> split -> balanced forest ->
evaluation -> model artifact -> run log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..operators import ml as M
from ..session import scratch_root, tune
from ..sources.sinks import write_run_log


def run_training(spark: SparkSession, fact: DataFrame, model_path: str | None = None,
                 num_trees: int = P.NUM_TREES, seed: int = P.SEED,
                 log_path: str | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    tune(spark)
    data, features, categorical = M.prepare_features(fact)
    # the split and the encoder read the fact five times, and the split feeds fit,
    # scoring and the distribution: cut the lineage of both once (reliable
    # checkpoint in the shared spark.checkpoint.dir)
    scratch_root(spark)
    data = data.checkpoint()
    split = M.stratified_split(data, seed=seed).checkpoint()
    train = split.filter(~F.col("is_test")).drop("is_test")
    test = split.filter(F.col("is_test")).drop("is_test")
    model = M.fit_forest(train, features, M.fit_encoder(data, categorical), num_trees=num_trees, seed=seed)
    scored = M.predict(model, test)
    confusion = M.confusion_matrix(spark, scored)
    report = M.classification_report(confusion)
    if model_path:
        M.save_model(model, model_path)
    if log_path:
        # K4: one row per metric of this run
        write_run_log(metrics_rows(report, confusion, run_id or uuid.uuid4().hex), log_path)
    return {"model": model, "split": split, "scored": scored, "confusion": confusion,
            "report": report, "accuracy": M.accuracy(scored),
            "distribution": M.class_distribution(split)}


def metrics_rows(report: DataFrame, confusion: DataFrame, run_id: str) -> DataFrame:
    """K4 for training as (run_id, step, metric, value) rows: the accuracy, the
    classes' and means' figures with their support, and the matrix cells."""
    one = report.filter(F.col("class_label") == "accuracy").select(F.lit("accuracy").alias("metric"),
                                                                   F.col("f1_score").alias("value"))
    figures = report.filter(F.col("class_label") != "accuracy").withColumn("support", F.col("support").cast("double"))
    per = figures.unpivot("class_label", ["precision", "recall", "f1_score", "support"], "m", "value").select(
        F.concat_ws(":", "class_label", "m").alias("metric"), "value")
    cells = confusion.select(F.concat_ws(":", F.lit("matrix"), P.LABEL, "prediction").alias("metric"),
                             F.col("n").cast("double").alias("value"))
    return one.unionByName(per).unionByName(cells).select(
        F.lit(run_id).alias("run_id"), F.lit("train").alias("step"), "metric", "value")


def reload_differences(model, path: str, rows: DataFrame) -> DataFrame:
    """K7: rows that the model and its saved copy predict differently, and all rows."""
    first = M.predict(model, rows).select(*rows.columns, F.col("prediction").alias("first_prediction"))
    return M.predict(M.load_model(path), first).agg(
        F.count_if(~F.col("prediction").eqNullSafe(F.col("first_prediction"))).alias("n_differ"), F.count("*").alias("n_rows"))
