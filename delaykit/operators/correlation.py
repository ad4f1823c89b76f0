"""Pearson and Spearman correlation, in long form, for one or many periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import CORRELATION_PERIODS
from delaykit.functions.scalars import ratio
from delaykit.operators.ranks import average_ranks


def pearson_vs_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Correlation of each feature with the label, strongest first, from one pass."""
    y = F.col(label).cast("double")
    one = df.agg(*[F.corr(F.col(f).cast("double"), y).alias(f) for f in features])
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias("corr")) for f in features]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*").orderBy(
        F.desc(F.abs("corr")), F.asc("feature")
    )


def pearson_matrix(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, row_name, col_name, corr) for all ordered pairs, from one pass.

    Only pairs in one direction are computed; partial moments are combined before the
    shuffle, so it carries one row per key and task.
    """
    keys = list(keys)
    columns = list(columns)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    numbers = df.select(*keys, *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    measures = [F.corr(f"c{i}", f"c{j}").alias(f"p{i}_{j}") for i, j in pairs]
    wide = numbers.groupBy(*keys).agg(*measures) if keys else numbers.agg(*measures)
    cells = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            cells.append(
                F.struct(
                    F.lit(columns[a]).alias("row_name"),
                    F.lit(columns[b]).alias("col_name"),
                    F.col(f"p{i}_{j}").alias("corr"),
                )
            )
    return wide.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*")


def spearman_matrix(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Pearson of average ranks. Ranks come from counts per distinct value, so a value that
    fills a third of a column is one row, and tables of ranks are joined, not sorted lists.

    A null has no rank. A pair of columns is correlated over the rows that have both, by the
    ranks each column has among all its values; Pearson leaves out the same rows.
    """
    numbers = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return pearson_matrix(average_ranks(numbers, columns, keys), columns, keys)


def tag_periods(
    df: DataFrame, period: str, ranges: Mapping[str, tuple[int, int] | None], out: str
) -> DataFrame:
    """One copy of a row per named range its period lies in (``None`` takes all rows)."""
    p = F.col(period)
    tags = [
        F.lit(name) if r is None else F.when(p.between(*r), name) for name, r in ranges.items()
    ]
    return df.withColumn(out, F.explode(F.array_compact(F.array(*tags))))


def _tagged(df, columns, period, ranges):
    needed = df.select(period, *[c for c in columns if c != period])
    return tag_periods(needed, period, ranges, "period_name")


def pearson_by_period(
    df: DataFrame,
    columns: Sequence[str],
    period: str,
    ranges: Mapping[str, tuple[int, int] | None] = CORRELATION_PERIODS,
) -> DataFrame:
    """Pearson matrices of several overlapping ranges of periods from one scan."""
    return pearson_matrix(_tagged(df, columns, period, ranges), columns, ["period_name"])


def spearman_by_period(
    df: DataFrame,
    columns: Sequence[str],
    period: str,
    ranges: Mapping[str, tuple[int, int] | None] = CORRELATION_PERIODS,
) -> DataFrame:
    """Spearman matrices of several ranges; ranks are taken inside each range."""
    return spearman_matrix(_tagged(df, columns, period, ranges), columns, ["period_name"])


def versus(matrix: DataFrame, label: str) -> DataFrame:
    """The label's column of a long matrix, strongest positive first."""
    return (
        matrix.filter(F.col("col_name") == label)
        .drop("col_name")
        .orderBy(F.desc("corr"), F.asc("row_name"))
    )


def yearly_trend(df: DataFrame, year: str, label: str, row_id: str) -> DataFrame:
    """Flights, delays and percentage delayed per year."""
    return df.groupBy(year).agg(
        F.count(row_id).alias("total_flights"),
        F.sum(label).alias("total_delayed_flights"),
    ).withColumn(
        "perc_delay_total", ratio("total_delayed_flights", "total_flights") * 100
    )
