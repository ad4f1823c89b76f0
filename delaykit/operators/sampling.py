"""Rebalancing and splitting rows.

The hash forms draw by a hash of the row key: the same rows on every run, on every retry
and in every engine. ``bernoulli`` is Spark's own seeded sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.config import SAMPLE_SEED
from delaykit.functions.scalars import unit_hash
from delaykit.operators.lookup import fits_broadcast, null_safe_join
from delaykit.session import cut_lineage


def bernoulli(
    df: DataFrame, fraction: float, seed: int = SAMPLE_SEED, replace: bool = False
) -> DataFrame:
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: Column | float, salt: str = ""):
    """Rows whose key hash falls below the fraction."""
    bound = F.lit(fraction) if isinstance(fraction, int | float) else fraction
    return df.filter(unit_hash(*keys, salt=salt) < bound)


def downsample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    is_holdout: Column,
    count_holdout: bool = False,
) -> DataFrame:
    """Thin the majority (label 0) of the training rows to about the minority's size.

    Holdout rows all stay. The ratio counts training rows only; ``count_holdout`` adds the
    holdout rows to its numerator. The ratio is a subquery, so one plan does both passes.
    """
    hold = F.coalesce(is_holdout, F.lit(False))
    majority = (F.col(label) == 0) & ~hold
    minority = (F.col(label) == 1) & (F.lit(True) if count_holdout else ~hold)
    if count_holdout:
        minority = minority | hold
    share = df.agg(
        F.try_divide(F.count_if(minority), F.count_if(majority)).alias("f")
    ).scalar()
    other = (F.col(label) == 1) | hold
    return df.filter(other | (majority & (unit_hash(*keys) < share)))


def downsample_by(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    period: str,
    is_holdout: Column | None = None,
) -> DataFrame:
    """Balance the classes inside every period; holdout rows are left out of the result."""
    rows = df if is_holdout is None else df.filter(~F.coalesce(is_holdout, F.lit(False)))
    shares = cut_lineage(
        rows.groupBy(period).agg(
            F.try_divide(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).alias("__f")
        )
    )
    if fits_broadcast(shares):
        shares = F.broadcast(shares)
    joined = null_safe_join(rows, shares, [period])
    keep = (F.col(label) == 1) | ((F.col(label) == 0) & (unit_hash(*keys) < F.col("__f")))
    return joined.filter(keep).drop("__f")


def upsample(
    df: DataFrame, label: str, keys: Sequence[str], out: str | None = None
) -> DataFrame:
    """Repeat minority rows (label 1) until both classes are about the same size.

    With f = n0 / n1 - 1 every minority row gets floor(f) extra copies, and one more where
    its hash falls below the remainder. Copies are made by exploding a copy number, which
    needs no shuffle; ``out`` keeps that number (0 for the original).
    """
    extra = df.agg(
        (F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)) - 1).alias("f")
    ).scalar()
    more = F.greatest(extra, F.lit(0.0))
    whole = F.floor(more).cast("int")
    drawn = whole + (unit_hash(*keys) < (more - whole)).cast("int")
    copies = F.when(F.col(label) == 1, F.coalesce(drawn, F.lit(0))).otherwise(F.lit(0))
    number = out or "__copy"
    result = df.withColumn(number, F.explode(F.sequence(F.lit(0), copies)))
    return result if out else result.drop(number)


def upsample_replace(df: DataFrame, label: str, fraction: float, seed: int = SAMPLE_SEED):
    """Add a seeded sample with replacement of the minority to all rows."""
    minority = df.filter(F.col(label) == 1)
    return df.unionByName(minority.sample(True, fraction, seed))


def hash_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.7, out: str = "part"
) -> DataFrame:
    """Mark rows train / test by key hash: a random split that never changes."""
    return df.withColumn(
        out, F.when(unit_hash(*keys) < train_share, "train").otherwise("test")
    )
