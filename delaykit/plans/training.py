"""Stage 3: prepare, search over blocking folds, choose, score the holdout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.config import CV_BLOCKS, TRAIN_SHARE, FeatureSet
from delaykit.ml.preparation import build_pipeline, scaler_stage, transformed
from delaykit.ml.search import SearchResult, blocking_search
from delaykit.ml.selection import best_model, predict_holdout
from delaykit.operators.folds import blocking_folds, period_folds
from delaykit.sources.sinks import staged


@dataclass
class Prepared:
    pipeline: PipelineModel
    train: DataFrame
    holdout: DataFrame


def prepare(
    features: DataFrame,
    chosen: FeatureSet,
    is_holdout: Column,
    time: str,
    period: str | None = None,
    blocks: int = CV_BLOCKS,
    train_share: float = TRAIN_SHARE,
    one_hot: bool = True,
    impute: bool = False,
    scale: bool = False,
    carry: Sequence[str] | None = None,
) -> Prepared:
    """Fit the preparation on the training rows, mark their folds, set the holdout aside.

    Folds are equal blocks of time, or one per ``period`` if given. Beside the vectors,
    ``carry`` names the columns to keep (all input columns if unset); the label and the
    time stay anyway. Training rows are written with their labels as numbers, then with their vectors, before
    they are ranked: the cuts, the counts per time, the join and the scaler read them, and none of them encodes a
    row again. Both steps in one would be too long for their code to be compiled. Ranked, they are written
    with their fold, since every fit reads them: the columns a fit does not need are pruned there.
    """
    held = F.coalesce(is_holdout, F.lit(False))  # an unknown condition means training
    train_rows = features.filter(~held)
    pipeline = build_pipeline(train_rows, chosen, one_hot, impute)
    shown = [c for c in features.columns if carry is None or c in {chosen.label, time, period, *carry}]

    encoded = staged(transformed(pipeline, train_rows, shown, in_steps=True), "encoded")
    holdout = transformed(pipeline, features.filter(held), shown)
    if scale:
        scaler = scaler_stage().fit(encoded)
        pipeline = PipelineModel([*pipeline.stages, scaler])
        encoded, holdout = scaler.transform(encoded), scaler.transform(holdout)
    if period:
        ranked = period_folds(encoded, time, period, train_share)
    else:
        ranked = blocking_folds(encoded, time, blocks, train_share)
    train = staged(ranked, "train")
    return Prepared(pipeline, train, holdout)


@dataclass
class Outcome:
    search: SearchResult
    model: object
    threshold: float
    predictions: DataFrame


def train_and_choose(
    prepared: Prepared,
    family: str,
    grid: Sequence[Mapping[str, object]],
    label: str,
    thresholds: Sequence[float],
    features: str = "features",
    parallelism: int = 2,
) -> Outcome:
    search = blocking_search(
        prepared.train, family, grid, label, thresholds, features, parallelism=parallelism
    )
    model, threshold, _ = best_model(search)
    return Outcome(search, model, threshold, predict_holdout(model, threshold, prepared.holdout))
