"""Stage 4: compare models and look at their errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from delaykit.operators.metrics import (
    compare_predictions,
    error_slices,
    join_predictions,
    result_shares,
    vote_columns,
)

VOTES = ["vote_majority", "vote_any", "vote_all"]


def ensemble_report(
    frames: dict[str, DataFrame], keys: Sequence[str], label: str
) -> DataFrame:
    """Scores of each model and of the three vote rules over the rows all models scored."""
    joined = join_predictions(frames, [*keys, label])
    single = [f"{name}_prediction" for name in frames]
    return compare_predictions(joined.withColumns(vote_columns(single)), label, single + VOTES)


def error_report(
    predictions: DataFrame, label: str, features: Sequence[str], prediction: str = "prediction"
) -> tuple[DataFrame, DataFrame]:
    """Shares of the four result types, and their counts by feature value."""
    return (
        result_shares(predictions, label, prediction),
        error_slices(predictions, label, prediction, features),
    )
