"""What a fitted model tells about itself. All tables here are as small as the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.ml.estimators import score_rows
from delaykit.operators.metrics import area_under_roc, score_curve


def feature_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Coefficient or tree importance per feature, by absolute size."""
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(n, float(v)) for n, v in zip(names, values.toArray(), strict=True)]
    return (
        spark.createDataFrame(rows, "featureName string, coefficient double")
        .withColumn("importance", F.abs("coefficient"))
        .orderBy(F.desc("importance"), F.asc("featureName"))
    )


def tree_ensemble_report(spark: SparkSession, model) -> DataFrame:
    """Nodes, depth and weight of each tree."""
    rows = [
        (i, int(t.numNodes), int(t.depth), float(w))
        for i, (t, w) in enumerate(zip(model.trees, model.treeWeights))
    ]
    return spark.createDataFrame(rows, "tree int, n_nodes int, depth int, weight double")


def boosting_loss(model, rows: DataFrame) -> DataFrame:
    """Loss after each boosting iteration on the given rows."""
    losses = model.evaluateEachIteration(rows)
    return rows.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(losses)], "iteration int, loss double"
    )


def training_loss(spark: SparkSession, model) -> DataFrame:
    """Objective per iteration of a model with a training summary."""
    return spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)],
        "iteration int, loss double",
    )


def training_area(model, rows: DataFrame, label: str) -> DataFrame:
    """Exact area under the ROC curve on the given (training) rows."""
    return area_under_roc(score_rows(model, rows), label, "predicted_probability")


def training_roc(model, rows: DataFrame, label: str) -> DataFrame:
    """ROC points, one per distinct score; a model's own summary would thin them out."""
    curve = score_curve(score_rows(model, rows), label, "predicted_probability")
    return curve.select("threshold", "fpr", "tpr")


def training_curve(model, rows: DataFrame, label: str) -> DataFrame:
    """Precision, recall and F0.5 at every distinct score of the given (training) rows."""
    curve = score_curve(score_rows(model, rows), label, "predicted_probability")
    return curve.select("threshold", "precision", "recall", F.col("f05").alias("F05"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
