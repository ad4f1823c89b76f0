import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from delaykit.operators.folds import block_bounds, blocking_folds, period_folds, time_split
from delaykit.operators.ranks import average_ranks, exact_quantiles, percent_rank, running_totals


def _values(kind, n=900, seed=5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        x = rng.choice([7.0, 7.0, rng.gauss(0, 50), float(rng.randrange(20)), -1e9, None])
        if kind == "timestamp_ntz" and x is not None:
            x = dt.datetime(2019, 1, 1) + dt.timedelta(minutes=max(x, -9999) * 37)
        if kind == "date" and x is not None:
            x = dt.date(2019, 1, 1) + dt.timedelta(days=int(max(x, -999)))
        if kind in ("int", "bigint") and x is not None:
            x = int(max(x, -999))
        if kind == "string" and x is not None:
            x = str(x)
        data.append((i, rng.choice(["p", "p", "p", "q", None]), x))
    return data


@pytest.mark.parametrize("kind", ["double", "int", "timestamp_ntz", "date"])
def test_percent_rank_equals_the_window(spark, kind):
    df = spark.createDataFrame(_values(kind), f"id int, k string, x {kind}")
    plain = df.withColumn("e", F.percent_rank().over(Window.partitionBy().orderBy("x")))
    both = percent_rank(df, "x", "p").join(plain.select("id", "e"), "id")
    assert both.count() == df.count() and both.filter(F.abs(F.col("p") - F.col("e")) > 0).count() == 0

    keyed = df.withColumn("e", F.percent_rank().over(Window.partitionBy("k").orderBy("x")))
    both = percent_rank(df, "x", "p", keys=["k"]).join(keyed.select("id", "e"), "id")
    assert both.count() == df.count() and both.filter(F.abs(F.col("p") - F.col("e")) > 0).count() == 0


def test_nan_ranks_last_and_single_row_is_zero(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 5.0)], "id int, x double")
    assert rows(percent_rank(df, "x", "p").select("id", "p")) == [(1, 0.0), (2, 1.0), (3, 0.5)]
    single = spark.createDataFrame([(1, 1.0)], "id int, x double")
    assert rows(percent_rank(single, "x", "p").select("p")) == [(0.0,)]


def test_all_values_equal(spark, rows):
    df = spark.range(50).withColumn("x", F.lit(3.0))
    assert rows(percent_rank(df, "x", "p").select("p").distinct()) == [(0.0,)]


def test_average_ranks(spark, rows):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 6.0), (2.0, 7.0)], "a double, b double")
    assert rows(average_ranks(df, ["a", "b"]).select("a", "b")) == [(1.5, 1.0), (1.5, 2.0), (3.0, 3.0)]


def test_running_totals_by_key(spark, rows):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("a", 2, 4), ("b", 1, 7)], "k string, v int, m int")
    got = rows(running_totals(df, "v", {"m": F.col("m")}, keys=["k"]))
    assert got == [("a", 1, 5, 0, 9), ("a", 2, 4, 5, 9), ("b", 1, 7, 0, 7)]


def test_rows_meet_no_one_task_window(spark):
    """Only bucket totals pass an unpartitioned window."""
    df = spark.range(1000).select("id", (F.col("id") % 97).cast("double").alias("x"))
    plan = running_totals(df, "x", {"n": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    single = [i for i, x in enumerate(plan.splitlines()) if "Window [" in x and "[x#" in x and "__bucket" not in x]
    assert not single, plan


def test_blocks_are_disjoint_ordered_and_half_open(spark):
    df = spark.range(1000).withColumn("t", F.timestamp_seconds(F.col("id") * 977).cast("timestamp_ntz"))
    folds = blocking_folds(df, "t").cache()
    stats = folds.filter("fold is not null").groupBy("fold", "is_val").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    got = {(r["fold"], r["is_val"]): (r["a"], r["b"]) for r in stats.collect()}
    assert sorted(got) == [(i, v) for i in range(4) for v in (False, True)]
    order = [got[i, v] for i in range(4) for v in (False, True)]
    assert all(x[1] < y[0] for x, y in zip(order, order[1:]))
    # the unique latest row has place 1.0 and belongs to no fold
    assert [r["id"] for r in folds.filter("fold is null").collect()] == [999]


def test_block_bounds():
    assert block_bounds(4)[1][0] == 0.25 and block_bounds(4)[3][2] == 1.0
    assert block_bounds(1) == [(0.0, 0.7, 1.0)]


def test_period_folds_and_time_split(spark):
    df = spark.range(200).select(
        "id",
        (F.col("id") % 2 + 2019).cast("int").alias("y"),
        F.timestamp_seconds(F.col("id") * 5000).cast("timestamp_ntz").alias("t"),
    )
    folds = period_folds(df, "t", "y")
    late = folds.groupBy("fold", "is_val").agg(F.count("*").alias("n")).collect()
    assert {(r["fold"], r["is_val"]): r["n"] for r in late} == {
        (2019, False): 70, (2019, True): 30, (2020, False): 70, (2020, True): 30,
    }
    split = time_split(df, "t", F.col("id") >= 180)
    n = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert n["test"] == 20 and n["train"] == 140 and n["validate"] == 40
    own = time_split(df, "t", F.col("id") >= 180, rank_holdout=False)
    assert {r["split"]: r["count"] for r in own.groupBy("split").count().collect()}["train"] == 126


def test_exact_quantiles_equal_percentile(spark):
    df = spark.createDataFrame(_values("double"), "id int, k string, x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    expected = {
        r["k"]: r["q"]
        for r in df.groupBy("k").agg(F.percentile("x", F.array(*[F.lit(q) for q in qs])).alias("q")).collect()
    }
    got = {r["k"]: [r[f"q{i}"] for i in range(len(qs))] for r in exact_quantiles(df, "x", qs, ["k"]).collect()}
    assert got.keys() == expected.keys()
    for k, values in expected.items():
        assert all(abs(a - b) <= 1e-9 * max(1, abs(b)) for a, b in zip(got[k], values))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clock_changes_do_not_disturb_ranks(spark, zone):
    """Zone-less times in the hour a zone skips keep their order in any session zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start = dt.datetime(2019, 3, 10)
        df = spark.createDataFrame([(i, start + dt.timedelta(minutes=10 * i)) for i in range(60)], "id int, t timestamp_ntz")
        got = [r["id"] for r in percent_rank(df, "t", "p", buckets=30).orderBy("p").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == list(range(60))


def test_many_values_are_joined_by_shuffle(spark, monkeypatch):
    from delaykit.operators import ranks

    df = spark.createDataFrame(_values("double"), "id int, k string, x double")
    expected = {r["id"]: r["p"] for r in percent_rank(df, "x", "p").collect()}
    monkeypatch.setattr(ranks, "BROADCAST_BYTES", 10)
    plan = percent_rank(df, "x", "p")
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()
    assert {r["id"]: r["p"] for r in plan.collect()} == expected
    both = average_ranks(df.select("x", F.col("id").alias("i")), ["x", "i"])
    assert both.count() == df.count()


@pytest.mark.parametrize("limit", [1 << 26, 6000, 0])
def test_average_ranks_in_tasks_of_bounded_size(spark, limit):
    """Short columns by broadcast, long ones by a join without hot values: the same ranks."""
    import pandas as pd

    data = [(n % 3 and f"k{n % 2}" or None, float(n % 3) if n % 4 else None, 5.0 if n % 2 else float(n), n % 5 and float(-n) or None) for n in range(3000)]
    frame = pd.DataFrame(data, columns=["k", "x", "y", "z"])
    df = spark.createDataFrame(data, "k string, x double, y double, z double")
    got = average_ranks(df, ["x", "y", "z"], ["k"], limit=limit, task_rows=500)
    want = frame[["x", "y", "z"]].groupby(frame["k"].fillna("")).rank()
    plain = lambda rows: sorted(str([None if v != v or v is None else v for v in r]) for r in rows)
    assert plain(got.select("x", "y", "z").collect()) == plain(want.astype(float).to_numpy().tolist())
    if not limit:
        sizes = got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(sizes) > 10 and max(sizes) < 1000
