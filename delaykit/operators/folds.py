"""Blocking time-series folds: whole blocks of time, each trained on its early part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.config import CV_BLOCKS, TRAIN_SHARE
from delaykit.functions.scalars import Col, as_col
from delaykit.operators.ranks import percent_rank


def block_bounds(blocks: int = CV_BLOCKS, train_share: float = TRAIN_SHARE):
    """(start, end of training, end) of every block on the percent-rank scale."""
    width = 1 / blocks
    return [
        (i * width, i * width + train_share * width, i * width + width) for i in range(blocks)
    ]


def block_columns(
    place: Col, blocks: int = CV_BLOCKS, train_share: float = TRAIN_SHARE
) -> tuple[Column, Column]:
    """Fold number and validation mark for a percent rank.

    Blocks are half open, so a row ranked exactly 1.0 (a unique latest row) is in no fold.
    """
    place = as_col(place)
    fold, is_val = F.lit(None).cast("int"), F.lit(None).cast("boolean")
    for i, (start, middle, end) in enumerate(block_bounds(blocks, train_share)):
        inside = (place >= start) & (place < end)
        fold = F.when(inside, F.lit(i)).otherwise(fold)
        is_val = F.when(inside, place >= middle).otherwise(is_val)
    return fold, is_val


def blocking_folds(
    df: DataFrame,
    time: str,
    blocks: int = CV_BLOCKS,
    train_share: float = TRAIN_SHARE,
    place: str = "time_place",
) -> DataFrame:
    """Add ``place`` (percent rank over time), ``fold`` and ``is_val``."""
    ranked = percent_rank(df, time, place)
    fold, is_val = block_columns(place, blocks, train_share)
    return ranked.withColumn("fold", fold).withColumn("is_val", is_val)


def period_folds(
    df: DataFrame,
    time: str,
    period: str,
    train_share: float = TRAIN_SHARE,
    place: str = "time_place",
) -> DataFrame:
    """One fold per period: the early share trains (inclusive), the rest validates."""
    ranked = percent_rank(df, time, place, keys=[period])
    return ranked.withColumn("fold", F.col(period)).withColumn(
        "is_val", F.col(place) > train_share
    )


def time_split(
    df: DataFrame,
    time: str,
    is_holdout: Column,
    train_share: float = TRAIN_SHARE,
    out: str = "split",
    rank_holdout: bool = True,
) -> DataFrame:
    """Label rows train / validate / test: one cut in time before the holdout.

    The place in time counts the holdout rows too, or only the others if ``rank_holdout``
    is off; rows up to ``train_share`` train (inclusive).
    """
    marked = df.withColumn("__hold", F.coalesce(is_holdout, F.lit(False)))
    ranked = percent_rank(marked, time, "__place", keys=[] if rank_holdout else ["__hold"])
    return ranked.withColumn(
        out,
        F.when(F.col("__hold"), "test")
        .when(F.col("__place") <= train_share, "train")
        .otherwise("validate"),
    ).drop("__hold", "__place")
