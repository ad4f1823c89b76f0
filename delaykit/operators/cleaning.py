"""De-duplication, null rules, outliers and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.functions.scalars import as_col, clamp_low


def exact_dedup(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that are distinct in all their columns, projected to ``columns``.

    Columns that are not needed afterwards decide as well, so the shuffle carries whole rows:
    a hash in their place would pass over nulls and take two rows for one.
    """
    distinct = df.distinct()
    return distinct if columns is None else distinct.select(*columns)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by one constant per column, keeping the column types."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items()}
    )


def numeric_text(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Parse text measures; unreadable values turn null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in columns})


def drop_above(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows at or below the limit; null or unreadable values go as well."""
    return df.filter(F.col(column).try_cast("double") <= limit)


def mean_impute(
    df: DataFrame, columns: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Fill nulls by column means, all means from one pass; ``where`` limits the rows that
    feed the means (for instance to the training years)."""
    base = df if where is None else df.filter(where)
    means = base.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return fill_constants(df, {c: means[c] for c in columns if means[c] is not None})


def clamp_negative(df: DataFrame, source: str, out: str) -> DataFrame:
    return df.withColumn(out, clamp_low(source))


def first_known(df: DataFrame, out: str, *columns: str, kind: str = "int") -> DataFrame:
    """First non-null of the columns after bringing them to one type."""
    return df.withColumn(out, F.coalesce(*[as_col(c).try_cast(kind) for c in columns]))
