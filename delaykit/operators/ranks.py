"""Ranks, percent ranks and running totals over a whole table without a one-task window.

Rows are first counted per distinct value (map-side combined, so a value that holds a third
of all rows becomes one row). The distinct values are cut into ordered buckets; totals per
bucket are few, so their prefix sums are cheap, and the values inside one bucket are added
up in parallel.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.operators.lookup import BROADCAST_BYTES, null_safe_join, plain_key, sized_lookup
from delaykit.session import cut_lineage

BUCKET_VALUES = 500_000  # distinct values that one task sorts
TASK_ROWS = 2_000_000  # narrow rows that one task of a join takes
FEW_VALUES = 1000  # a value that holds one in so many rows is joined by broadcast
_BELOW_ALL = -(2**62)


def _as_number(df: DataFrame, value: str) -> Column:
    """A double that never decreases as the value grows, free of the session zone."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        of_day = F.hour(value) * 3600 + F.minute(value) * 60
        second = F.extract(F.lit("SECOND"), value).cast("double")
        return F.unix_date(F.to_date(value)).cast("double") * 86400 + of_day + second
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return F.col(value).cast("double")


@dataclass(frozen=True)
class Profile:
    """Quantile cuts of a column and the estimated number of its distinct values."""

    cuts: tuple[float, ...]
    n_values: int


def profile(
    df: DataFrame, value: str, keys: Sequence[str] = (), buckets: int | None = None
) -> Profile:
    """One narrow pass; only the cuts and one estimate reach the driver.

    The cuts are approximate quantiles of the rows, so every bucket holds about the same
    share of them (or one value). Their number follows the estimated distinct values, so a
    bucket stays the work of one task however long the column is.
    """
    start = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted, n = max(2, start), 0
    while True:
        row = df.agg(
            F.percentile_approx(
                _as_number(df, value), [i / wanted for i in range(1, wanted)], 2 * wanted
            ).alias("cuts"),
            F.approx_count_distinct(F.xxhash64(*keys, value)).alias("n"),
        ).first()
        n = row["n"]
        needed = n // BUCKET_VALUES + 1
        if buckets or needed <= wanted:
            break
        wanted = needed + needed // 10
    cuts = {float(c) for c in row["cuts"] or [] if c == c and abs(c) != float("inf")}
    return Profile(tuple(sorted(cuts)) or (0.0,), n)


def _with_bucket(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``__bucket``: whole numbers that never decrease as the value grows, null first."""
    splits = [float("-inf"), *cuts, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep")
    bucket = F.when(F.col("__x").isNull(), F.lit(_BELOW_ALL)).otherwise(F.col("__b").cast("long"))
    return (
        cutter.transform(df.withColumn("__x", _as_number(df, value)))
        .withColumn("__bucket", bucket)
        .drop("__x", "__b")
    )


def running_totals(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    keys: Sequence[str] = (),
    buckets: int | None = None,
    known: Profile | None = None,
    neighbours: bool = False,
) -> DataFrame:
    """One row per (keys, value) with, for each measure m, ``m`` (total at this value),
    ``m_before`` (total over smaller values) and ``m_all`` (total over the key).

    Null values sort first, as in a Spark window. Measures must be non-null sums. ``neighbours``
    adds ``m_below``, the total at the next smaller value of the key, null at the smallest; across
    the border of two buckets it comes from the last value of the bucket before.
    """
    keys = list(keys)
    known = known or profile(df, value, keys, buckets)
    names = list(measures)
    per_value = df.groupBy(*keys, value).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    bucketed = _with_bucket(per_value, value, known.cuts)
    part = []
    if keys:
        part = ["__key"]
        bucketed = bucketed.withColumn("__key", plain_key(*keys))

    before = Window.partitionBy(*part).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*part)
    last = [F.max_by(m, value).alias(f"__{m}_last") for m in names] if neighbours else []
    offsets = (
        bucketed.groupBy(*part, "__bucket")
        .agg(*[F.sum(m).alias(f"__{m}") for m in names], *last)
        .select(
            *part,
            "__bucket",
            *[F.coalesce(F.sum(f"__{m}").over(before), F.lit(0)).alias(f"__{m}_off") for m in names],
            *[F.sum(f"__{m}").over(whole).alias(f"{m}_all") for m in names],
            *[F.lag(f"__{m}_last").over(whole.orderBy("__bucket")).alias(f"__{m}_border") for m in names if neighbours],
        )
    )
    inside = Window.partitionBy(*part, "__bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = bucketed.select(
        *part,
        *keys,
        value,
        "__bucket",
        *names,
        *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"__{m}_in") for m in names],
        *[F.lag(m).over(Window.partitionBy(*part, "__bucket").orderBy(value)).alias(f"__{m}_next") for m in names if neighbours],
    )
    joined = local.join(offsets, [*part, "__bucket"])
    return joined.select(
        *keys,
        value,
        *names,
        *[(F.col(f"__{m}_in") + F.col(f"__{m}_off")).alias(f"{m}_before") for m in names],
        *[f"{m}_all" for m in names],
        *[F.coalesce(f"__{m}_next", f"__{m}_border").alias(f"{m}_below") for m in names if neighbours],
    )


def exact_quantiles(
    df: DataFrame, value: str, quantiles: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, q0, q1, ...): exact quantiles with linear interpolation, found by place.

    The values on both sides of each quantile are picked out of the running counts, so no
    task has to hold a whole key. Null values are left out.
    """
    keys = list(keys)
    known = df.filter(F.col(value).isNotNull())
    totals = running_totals(known.select(*keys, value), value, {"__n": F.lit(1)}, keys=keys)
    picks = []
    for i, q in enumerate(quantiles):
        place = (F.col("__n_all") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("__n_before") <= at) & (at < F.col("__n_before") + F.col("__n"))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"__{side}{i}"))
    grouped = totals.groupBy(*keys) if keys else totals
    found = grouped.agg(*picks, F.max("__n_all").alias("__n_all"))
    columns = []
    for i, q in enumerate(quantiles):
        place = (F.col("__n_all") - 1) * F.lit(float(q))
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(*keys, *columns)


def value_ranks(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
    known: Profile | None = None,
) -> DataFrame:
    """Per distinct (keys, value): percent rank and average rank."""
    totals = running_totals(
        df.select(*keys, value), value, {"__n": F.lit(1)}, keys, buckets, known
    )
    before, here, total = F.col("__n_before"), F.col("__n"), F.col("__n_all")
    return totals.select(
        *keys,
        value,
        F.when(total <= 1, F.lit(0.0)).otherwise(before / (total - 1)).alias("__percent_rank"),
        (before + (here + 1) / 2).alias("__average_rank"),
    )


def percent_rank(
    df: DataFrame,
    value: str,
    out: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """``percent_rank()`` over the whole table, or over each key, without a one-task sort.

    If the values look few, their ranks are materialised, measured and broadcast; a column of
    mostly distinct values is joined back by shuffle.
    """
    known = profile(df, value, keys, buckets)
    ranks = value_ranks(df, value, keys, buckets, known).select(
        *keys, value, F.col("__percent_rank").alias(out)
    )
    few = known.n_values * (32 + 32 * len(keys)) <= BROADCAST_BYTES
    return null_safe_join(df, sized_lookup(ranks) if few else ranks, [*keys, value])


def average_ranks(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), buckets: int | None = None,
    limit: int = BROADCAST_BYTES, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(keys, columns): each column as its average rank (ties share the mean of their places),
    over the whole table or inside each key. Null has no rank and stays null.

    The ranks of all columns come from one pass over the counts per value. Columns whose ranks measure
    at most ``limit`` bytes, together, take them by broadcast, and their rows stay where they are. Of the
    others the non-null cells travel: values that hold a thousandth of a column or more are few and are
    broadcast, so what is joined by shuffle has no hot value; a row's cells then meet again under its
    number. Both shuffles are dealt to tasks of about ``task_rows`` cells, whatever the session's number is.
    """
    columns, keys = list(columns), list(keys)
    numbered = cut_lineage(
        df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).withColumns(
            {"__row": F.monotonically_increasing_id(), "__group": plain_key(*keys) if keys else F.lit("")}
        )
    )

    def cells_of(places):
        cells = [F.struct(F.lit(i).alias("c"), F.col(columns[i]).alias("v")) for i in places]
        return numbered.select("__row", *keys, "__group", F.explode(F.array(*cells)).alias("x")).filter("x.v IS NOT NULL").select(
            "__row", *keys, "__group", "x.c", "x.v"
        )

    known = cells_of(range(len(columns))).select("__group", "c", "v")
    totals = running_totals(known, "v", {"__n": F.lit(1)}, ["__group", "c"], buckets)
    rank = F.col("__n_before") + (F.col("__n") + 1) / 2
    ranks = cut_lineage(totals.select("__group", "c", "v", rank.alias("rank"), F.col("__n").alias("n")))
    width = 64 + F.octet_length("__group")
    sizes = sorted((r["b"], r["c"], r["n"]) for r in ranks.groupBy("c").agg(F.sum(width).alias("b"), F.sum("n").alias("n")).collect())
    short, total = [], 0
    for size, place, _ in sizes:
        total += size
        if total <= limit:
            short.append(place)
    long = sorted(c for _, c, _ in sizes if c not in short)
    wide = numbered
    for i in short:
        own = ranks.filter(F.col("c") == i).select(F.col("__group").alias("__k"), F.col("v").alias("__v"), F.col("rank").alias(f"__rank{i}"))
        wide = wide.join(F.broadcast(own), (F.col("__group") == F.col("__k")) & (F.col(columns[i]) == F.col("__v")), "left").drop("__k", "__v")
    shown = [(F.col(f"__rank{i}") if i in short else F.lit(None).cast("double")).alias(f"__rank{i}") for i in range(len(columns))]
    wide = wide.select("__row", *keys, *shown)
    if long:
        n_cells = sum(n for _, c, n in sizes if c in long)
        tasks = max(1, -(-n_cells // task_rows))
        hot = functools.reduce(
            lambda a, b: a | b, [(F.col("c") == c) & (F.col("n") * FEW_VALUES >= n) for _, c, n in sizes if c in long]
        )
        named = ranks.filter(F.col("c").isin(long)).select(*[F.col(x).alias(f"__r_{x}") for x in ("__group", "c", "v")], "rank", hot.alias("hot"))
        same = functools.reduce(lambda a, b: a & b, [F.col(x) == F.col(f"__r_{x}") for x in ("__group", "c", "v")])
        cells, few = cells_of(long), F.broadcast(named.filter("hot"))
        apart = cells.join(few, same, "left_anti").repartition(tasks, "__group", "c", "v")
        rest = named.filter(~F.col("hot")).repartition(tasks, "__r___group", "__r_c", "__r_v")
        ranked = [d.select("__row", *keys, "c", "rank") for d in (cells.join(few, same), apart.join(rest.hint("merge"), same))]
        spread = [F.when(F.col("c") == i, F.col("rank")).alias(f"__rank{i}") for i in range(len(columns))]
        parts = [wide, *[d.select("__row", *keys, *spread) for d in ranked]]
        met = functools.reduce(DataFrame.unionByName, parts).repartition(max(1, -(-2 * n_cells // task_rows)), "__row")
        wide = met.groupBy("__row", *keys).agg(*[F.max(f"__rank{i}").alias(f"__rank{i}") for i in range(len(columns))])
    return wide.select(*keys, *[F.col(f"__rank{i}").alias(c) for i, c in enumerate(columns)])
