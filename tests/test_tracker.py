import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from delaykit.functions.scalars import minute_of_day
from delaykit.operators.tracker import previous_status

SCHEMA = "day string, tail string, t int, y double, id int"


def track(df, **options):
    out = previous_status(df, "y", "day", "tail", minute_of_day("t"), "prev", tie=["id"], **options)
    return {r["id"]: r["prev"] for r in out.collect()}


def test_gap_rule(spark):
    df = spark.createDataFrame(
        [
            ("d", "A", 930, 1.0, 1), ("d", "A", 1129, 0.0, 2),   # 1 h 59 apart
            ("d", "B", 930, 1.0, 3), ("d", "B", 1130, 0.0, 4),   # 2 h 00 apart
            ("d", "C", 500, 1.0, 5), ("d", "C", 600, 0.0, 6), ("d", "C", 630, 0.0, 7),
            ("e", "B", 1400, 0.0, 8),
        ],
        SCHEMA,
    )
    got = track(df)
    assert got[1] == 0.0          # first flight of the day
    assert got[2] == 0.0          # too close, and nothing before that
    assert got[4] == 1.0
    assert got[7] == 1.0          # falls back two flights without checking that gap
    assert got[8] == 0.0          # a new day starts afresh


def test_time_is_ordered_as_a_number(spark):
    df = spark.createDataFrame([("d", "A", 1000, 0.0, 1), ("d", "A", 700, 1.0, 2)], SCHEMA)
    assert track(df)[1] == 1.0


def _plain(df):
    w = Window.partitionBy("day", "tail").orderBy("m", "id")
    out = df.withColumn("m", minute_of_day("t")).withColumn(
        "prev",
        F.coalesce(
            F.when(F.col("m") - F.lag("m").over(w) >= 120, F.lag("y").over(w)).otherwise(
                F.lag("y", 2).over(w)
            ),
            F.lit(0.0),
        ),
    )
    return {r["id"]: r["prev"] for r in out.collect()}


def test_chunks_equal_one_window(spark):
    """A busy unit, a null unit, null and equal times, empty chunks, single-row chunks."""
    rng = random.Random(3)
    data = []
    for i in range(1500):
        minute = rng.choice([rng.randrange(1440), rng.randrange(60)])
        t = None if rng.random() < 0.02 else minute // 60 * 100 + minute % 60
        tail = None if rng.random() < 0.05 else rng.choice(["hot", "hot", "hot", "b", "c"])
        y = None if rng.random() < 0.05 else float(rng.random() < 0.4)
        data.append((rng.choice(["d1", "d2", "d3"]), tail, t, y, i))
    df = spark.createDataFrame(data, SCHEMA)
    expected = _plain(df)
    for minutes in (15, 60, 1440):
        assert track(df, chunk_minutes=minutes) == expected


def test_no_task_holds_a_whole_unit_day(spark):
    """Rows are partitioned by (unit-day, chunk); only chunk ends meet per unit-day."""
    df = spark.createDataFrame([("d", "A", 930, 1.0, 1)], SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = previous_status(df, "y", "day", "tail", minute_of_day("t"), "prev", tie=["id"])
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [x for x in text.splitlines() if "Exchange hashpartitioning(__unit_day" in x]
    whole = [x for x in lines if "__chunk" not in x]
    assert len(whole) == 1 and len(lines) == 4, text
    below = text[text.index(whole[0]):]
    assert below.index("Aggregate") < below.index("Window")  # one row per chunk is exchanged
    # one window operator for place and both look-backs, per use
    assert text.count("Window [") == 3, text
