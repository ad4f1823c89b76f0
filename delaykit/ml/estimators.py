"""The five classifier families under one set of names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.config import SAMPLE_SEED

FAMILIES = {
    "lr": LogisticRegression,
    "rf": RandomForestClassifier,
    "svm": LinearSVC,
    "gbt": GBTClassifier,
    "mlp": MultilayerPerceptronClassifier,
}
_SEEDED = {"rf", "gbt", "mlp"}


def make_estimator(
    family: str,
    params: Mapping[str, object],
    label: str,
    features: str = "features",
    seed: int = SAMPLE_SEED,
):
    """Estimator of a family with its search parameters set."""
    settings = dict(params)
    if family in _SEEDED:
        settings.setdefault("seed", seed)
    if family == "lr":
        settings.setdefault("standardization", True)
    if family == "gbt":
        # every job of a round is sent with its lineage, which holds the trees of all rounds since the last cut
        settings.setdefault("checkpointInterval", 1)
    if "layers" in settings:
        settings["layers"] = list(settings["layers"])
    return FAMILIES[family](labelCol=label, featuresCol=features, **settings)


def score_column(model) -> Column:
    """Score compared with a threshold: the positive probability, or for a model without
    probabilities (the linear SVM) the positive margin."""
    has_probability = model.hasParam("probabilityCol")
    source = "probability" if has_probability else "rawPrediction"
    return vector_to_array(F.col(source))[1]


def score_rows(model, df: DataFrame, out: str = "predicted_probability") -> DataFrame:
    return model.transform(df).withColumn(out, score_column(model))


def boosting_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that boosting had after its first rounds."""
    if rounds >= model.getNumTrees:
        return model
    gateway = SparkContext._gateway
    java = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(java.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, tree in enumerate(model.trees[:rounds]):
        trees[i], weights[i] = tree._java_obj, float(model.treeWeights[i])
    short = java.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, 2)
    return GBTClassificationModel(model._java_obj.copyValues(short, java.param.ParamMap()))


def boosting_scores(model: GBTClassificationModel, df: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``df`` with ``p<n>``, the positive probability after the first n rounds, for every n in ``lengths``.
    Every tree is walked once; the margins are sums over the trees so far."""
    kept, margin = df.columns, F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        df = tree.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"__tree{i}").transform(df)
        margin = margin + F.col(f"__tree{i}") * float(weight)
        if i + 1 in lengths:
            df = df.withColumn(f"p{i + 1}", 1 / (1 + F.exp(-2 * margin)))
    # boosting may have been asked for more rounds than it has trees
    for n in lengths:
        if n > model.getNumTrees:
            df = df.withColumn(f"p{n}", 1 / (1 + F.exp(-2 * margin)))
    return df.select(*kept, *[f"p{n}" for n in lengths])


def naive_predictions(df: DataFrame, out: str = "prediction") -> DataFrame:
    """The never-delayed baseline."""
    return df.withColumn(out, F.lit(0.0))
