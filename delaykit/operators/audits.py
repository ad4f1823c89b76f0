"""Data audits: nulls, keys, dependencies, parseability, prevalence. One pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _long(row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str) -> DataFrame:
    """Turn one wide row of ``name__field`` columns into one row per name."""
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias(key), *[F.col(f"`{n}__{f}`").alias(f) for f in fields]
                    )
                    for n in names
                ]
            )
        ).alias("r")
    ).select("r.*")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per column that are null, blank, spelled None / NULL, or NaN."""
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    never = F.lit(False)
    counts = []
    for c in columns:
        x, kind = F.col(f"`{c}`"), kinds[c]
        text = isinstance(kind, T.StringType)
        real = isinstance(kind, T.DoubleType | T.FloatType)
        spelled = x.contains("None") | x.contains("NULL") if text else never
        blank = x == "" if text else never
        nan = F.isnan(x) if real else never
        tests = {
            "n_null": x.isNull(),
            "n_blank": blank,
            "n_spelled": spelled,
            "n_nan": nan,
            "n_missing": x.isNull() | blank | spelled | nan,
        }
        counts += [F.count_if(t).alias(f"{c}__{k}") for k, t in tests.items()]
        counts.append(F.count(F.lit(1)).alias(f"{c}__n_rows"))
    fields = ["n_null", "n_blank", "n_spelled", "n_nan", "n_missing", "n_rows"]
    return _long(df.agg(*counts), columns, fields, "column_name")


def reads_as_int(text: Column) -> Column:
    """Does the text read as a whole number once a decimal part is cut off?"""
    trimmed = F.trim(text)
    shaped = trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$")
    whole = F.abs(trimmed.try_cast("double"))
    return F.coalesce(shaped & (whole < 2147483648.0), F.lit(False))


def unparseable_audit(df: DataFrame, columns: Sequence[str], kind: str = "int") -> DataFrame:
    """Rows per column whose value does not read as ``kind`` (null counts as unreadable)."""
    counts = []
    for c in columns:
        x = F.col(f"`{c}`")
        text = x.cast("string")
        readable = reads_as_int(text) if kind == "int" else text.try_cast(kind).isNotNull()
        counts += [
            F.count_if(~readable).alias(f"{c}__n_unparseable"),
            F.count_if(x.isNull()).alias(f"{c}__n_null"),
            F.count(F.lit(1)).alias(f"{c}__n_rows"),
        ]
    return _long(df.agg(*counts), columns, ["n_unparseable", "n_null", "n_rows"], "column_name")


def distinct_counts(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exact distinct combinations (nulls included) for several named column tuples.

    One aggregate serves all tuples: rows are expanded once per tuple, and repeated
    combinations collapse before the shuffle, which goes by the combination itself.
    """
    counts = [
        F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in cols])).alias(f"k{i}")
        for i, cols in enumerate(keys.values())
    ]
    cells = [
        F.struct(F.lit(name).alias("key_name"), F.col(f"k{i}").alias("n_distinct"))
        for i, name in enumerate(keys)
    ]
    return df.agg(*counts).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Does the column tuple identify rows? Row count, distinct keys, surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
    ).select(
        "n_rows",
        "n_keys",
        "n_repeated_keys",
        (F.col("n_rows") == F.col("n_keys")).alias("is_key"),
    )


def dependency_audit(
    df: DataFrame, determinant: str, dependent: str, top: int | None = None
) -> DataFrame:
    """Distinct dependents per determinant, most first; ``top`` makes it a top-k report."""
    pairs = df.select(determinant, dependent).distinct()
    counts = (
        pairs.groupBy(determinant)
        .agg(F.count(dependent).alias("n_dependents"))
        .orderBy(F.desc("n_dependents"), F.asc(determinant))
    )
    return counts if top is None else counts.limit(top)


def unequal_rows(df: DataFrame, left: str, right: str) -> DataFrame:
    """How many rows carry two different values in columns expected to agree."""
    return df.agg(
        F.count_if(F.col(left) != F.col(right)).alias("n_unequal"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def co_nullity(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """The four cases of two conditions holding together, in one pass."""
    a, b = F.coalesce(first, F.lit(False)), F.coalesce(second, F.lit(False))
    return df.agg(
        F.count_if(a & b).alias("n_both"),
        F.count_if(a & ~b).alias("n_first_only"),
        F.count_if(~a & b).alias("n_second_only"),
        F.count_if(~a & ~b).alias("n_neither"),
    )


def prevalence(
    df: DataFrame, flags: Sequence[str], condition: Column, given: str = "given"
) -> DataFrame:
    """Count and share of each 0/1 flag over all rows and over the rows that meet a condition."""
    counts = [
        F.count(F.lit(1)).alias("__all"),
        F.count_if(condition).alias("__given"),
    ]
    for f in flags:
        counts += [
            F.count_if(F.col(f) == 1).alias(f"{f}__n"),
            F.count_if((F.col(f) == 1) & condition).alias(f"{f}__n_given"),
        ]
    one = df.agg(*counts)
    for f in flags:
        one = one.withColumns(
            {
                f"{f}__share": F.try_divide(F.col(f"{f}__n"), F.col("__all")),
                f"{f}__share_given": F.try_divide(F.col(f"{f}__n_given"), F.col("__given")),
            }
        )
    out = _long(one, flags, ["n", "share", "n_given", "share_given"], "flag")
    return out.withColumnsRenamed({"n_given": f"n_{given}", "share_given": f"share_{given}"})


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group, largest first, ties by key."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), *[F.asc(k) for k in keys])
    )


def group_sums(
    df: DataFrame, key: str, value: str, at_least: float | None = None
) -> DataFrame:
    """Sum per group, largest first; ``at_least`` keeps the groups that reach it."""
    sums = df.groupBy(key).agg(F.sum(value).alias("total"))
    if at_least is not None:
        sums = sums.filter(F.col("total") >= at_least)
    return sums.orderBy(F.desc("total"), F.asc(key))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column."""
    measures = []
    for c in columns:
        x = F.col(f"`{c}`").cast("double")
        measures += [
            F.count(x).alias(f"{c}__n"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    return _long(df.agg(*measures), columns, ["n", "mean", "stddev", "min", "max"], "column_name")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, minimum and maximum per column, as text. Distinct values are counted by
    grouping them, column by column in one pass, so no task holds the values of a column."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    )
    each = df.select(F.explode(cells).alias("c")).groupBy("c.column_name", "c.v").agg(F.count(F.lit(1)).alias("k"))
    return each.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("k"))), F.lit(0)).alias("n"),
        F.count("v").alias("n_distinct"), F.min("v").alias("min"), F.max("v").alias("max"),
    )
