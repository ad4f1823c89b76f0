"""From search metrics to the chosen model, and its scores on the holdout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.ml.estimators import score_rows
from delaykit.ml.search import SearchResult
from delaykit.operators.metrics import SCORES, confusion_metrics

SETTING = ["family", "params", "threshold"]


def mean_metrics(metrics: DataFrame) -> DataFrame:
    """Mean of the validation scores over the folds, per setting and threshold."""
    return metrics.groupBy(*SETTING).agg(
        *[F.avg(f"val_{s}").alias(f"val_{s}") for s in SCORES],
        F.count(F.lit(1)).alias("n_folds"),
    )


def complete_settings(metrics: DataFrame, n_folds: int | None = None) -> DataFrame:
    """Mean scores of the settings that were scored on every fold.

    A setting that failed on a fold was not tried on the same rows as the others, so it is not
    ranked. ``n_folds`` is the number of folds of the search; unset, the folds that any setting
    was scored on count.
    """
    means = mean_metrics(metrics)
    if n_folds is not None:
        return means.filter(F.col("n_folds") == n_folds)
    folds = metrics.agg(F.countDistinct("cv_fold").alias("__all"))
    return means.join(F.broadcast(folds), F.col("n_folds") == F.col("__all")).drop("__all")


def top_settings(
    metrics: DataFrame, k: int = 20, by: str = "val_f05", n_folds: int | None = None
) -> DataFrame:
    """Grid rows of the k complete settings with the best mean score (top-k report)."""
    best = (
        complete_settings(metrics, n_folds)
        .orderBy(F.desc(by), *[F.asc(c) for c in SETTING])
        .limit(k)
        .select(*SETTING)
    )
    return metrics.join(best, SETTING)


def best_row(metrics: DataFrame, by: str = "val_f05", n_folds: int | None = None) -> DataFrame:
    """One row: the best fold of the complete setting with the best mean score."""
    return top_settings(metrics, 1, by, n_folds).orderBy(F.desc(by), F.asc("cv_fold")).limit(1)


def best_model(found: SearchResult, by: str = "val_f05"):
    """(model, threshold, row) of :func:`best_row`. If no setting is complete, the error tells
    what failed."""
    row = best_row(found.metrics, by, found.n_folds).first()
    if row is None:
        failed = [r.asDict() for r in found.failures.collect()]
        raise RuntimeError(f"no setting was scored on all {found.n_folds} folds; failures: {failed}")
    models = found.models
    return models[row["model_id"]], row["threshold"], row


def holdout_metrics(
    chosen: DataFrame, models: Mapping[str, object], holdout: DataFrame, label: str,
    features: str = "features",
) -> DataFrame:
    """Add test scores to grid rows. All models score the holdout in one pass, for all of their
    thresholds; ``chosen`` holds one row per grid point, so its list is short."""
    wanted: dict[str, list[float]] = {}
    for r in chosen.select("model_id", "threshold").collect():
        wanted.setdefault(r["model_id"], []).append(r["threshold"])
    schema = T.StructType(
        [
            T.StructField("model_id", T.StringType()),
            T.StructField("threshold", T.DoubleType()),
            *[T.StructField(f"test_{s}", T.DoubleType()) for s in SCORES],
        ]
    )
    if not wanted:
        tested = chosen.sparkSession.createDataFrame([], schema)
        return chosen.join(tested, ["model_id", "threshold"])
    scored, names = holdout.select(label, features), {}
    for i, model_id in enumerate(wanted):
        names[model_id] = f"__p{i}"
        kept = [*scored.columns, F.col("predicted_probability").alias(names[model_id])]
        scored = score_rows(models[model_id], scored).select(*kept)
    cells = [
        F.struct(F.lit(m).alias("model_id"), F.col(c).alias("p"), F.lit(t).alias("t"))
        for m, c in names.items()
        for t in sorted(set(wanted[m]))
    ]
    hits = scored.select(F.col(label).alias("y"), F.explode(F.array(*cells)).alias("x")).select(
        "y", "x.model_id", F.col("x.t").alias("threshold"), (F.col("x.p") > F.col("x.t")).alias("hit")
    )
    table = confusion_metrics(hits, "y", "hit", keys=["model_id", "threshold"])
    found = [(r["model_id"], r["threshold"], *[float(r[s]) for s in SCORES]) for r in table.collect()]
    tested = chosen.sparkSession.createDataFrame(found, schema)
    return chosen.join(tested, ["model_id", "threshold"])


def predict_holdout(model, threshold: float, holdout: DataFrame) -> DataFrame:
    """Scored holdout rows with the prediction taken at the chosen threshold."""
    return score_rows(model, holdout).withColumn(
        "prediction", (F.col("predicted_probability") > threshold).cast("double")
    )
