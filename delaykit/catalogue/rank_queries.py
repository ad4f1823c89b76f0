"""Percent ranks, folds, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.operators.folds import block_bounds, blocking_folds, period_folds, time_split
from delaykit.operators.ranks import percent_rank
from delaykit.operators.sampling import (
    downsample,
    downsample_by,
    hash_sample,
    hash_split,
    upsample,
)

_HASH = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 13))::UBIGINT / 4503599627370496.0"
def _hold():
    return F.col("YEAR") == s.HOLDOUT



@query(
    "percent_rank_global",
    """SELECT o_orderkey, round(percent_rank() OVER (ORDER BY o_orderdate), 9) AS place FROM orders""",
)
def percent_rank_global(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    ranked = percent_rank(orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "place")
    return ranked.select("o_orderkey", r9("place").alias("place"))


@query(
    "percent_rank_events",
    """SELECT event_id, round(percent_rank() OVER (ORDER BY ts), 9) AS place FROM events""",
)
def percent_rank_events(spark, sf):
    """Nearly unique timestamps: the case in which values do not collapse."""
    (events,) = tables(spark, sf, "events")
    ranked = percent_rank(events.select("event_id", "ts"), "ts", "place")
    return ranked.select("event_id", r9("place").alias("place"))


@query(
    "percent_rank_by_year",
    f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT o_orderkey, "YEAR",
       round(percent_rank() OVER (PARTITION BY "YEAR" ORDER BY DEP_DATETIME_LAG), 9) AS place
FROM plain_orders""",
)
def percent_rank_by_year(spark, sf):
    rows = s.plain_orders(spark, sf).select("o_orderkey", "YEAR", "DEP_DATETIME_LAG")
    ranked = percent_rank(rows, "DEP_DATETIME_LAG", "place", keys=["YEAR"])
    return ranked.select("o_orderkey", "YEAR", r9("place").alias("place"))


@query(
    "percent_rank_measure",
    """SELECT l_orderkey, l_linenumber, l_quantity,
       round(percent_rank() OVER (ORDER BY l_quantity), 9) AS place FROM lineitem""",
)
def percent_rank_measure(spark, sf):
    (lineitem,) = tables(spark, sf, "lineitem")
    ranked = percent_rank(
        lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", "place"
    )
    return ranked.select("l_orderkey", "l_linenumber", "l_quantity", r9("place").alias("place"))


def fold_cases(blocks: int) -> tuple[str, str]:
    bounds = block_bounds(blocks)
    fold = " ".join(
        f"WHEN place >= {a!r}::DOUBLE AND place < {b!r}::DOUBLE THEN {i}"
        for i, (a, _, b) in enumerate(bounds)
    )
    val = " ".join(
        f"WHEN place >= {a!r}::DOUBLE AND place < {b!r}::DOUBLE THEN place >= {m!r}::DOUBLE"
        for a, m, b in bounds
    )
    return f"CASE {fold} END", f"CASE {val} END"


@query(
    "blocking_folds",
    f"""WITH {s.PLAIN_ORDERS_SQL},
p AS (SELECT o_orderkey, percent_rank() OVER (ORDER BY DEP_DATETIME_LAG) AS place
      FROM plain_orders WHERE "YEAR" <> 2001)
SELECT o_orderkey, {fold_cases(4)[0]} AS fold, {fold_cases(4)[1]} AS is_val FROM p""",
)
def folds(spark, sf):
    train = s.plain_orders(spark, sf).filter(~_hold()).select("o_orderkey", "DEP_DATETIME_LAG")
    return blocking_folds(train, "DEP_DATETIME_LAG").select("o_orderkey", "fold", "is_val")


@query(
    "blocking_folds_by_year",
    f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT o_orderkey, "YEAR" AS fold,
       percent_rank() OVER (PARTITION BY "YEAR" ORDER BY DEP_DATETIME_LAG) > 0.7::DOUBLE AS is_val
FROM plain_orders WHERE "YEAR" <> 2001""",
)
def folds_by_year(spark, sf):
    train = s.plain_orders(spark, sf).filter(~_hold())
    rows = train.select("o_orderkey", "YEAR", "DEP_DATETIME_LAG")
    return period_folds(rows, "DEP_DATETIME_LAG", "YEAR").select("o_orderkey", "fold", "is_val")


@query(
    "time_split",
    f"""WITH {s.PLAIN_ORDERS_SQL},
p AS (SELECT *, percent_rank() OVER (ORDER BY DEP_DATETIME_LAG) AS place FROM plain_orders)
SELECT o_orderkey, CASE WHEN "YEAR" = 2001 THEN 'test' WHEN place <= 0.7::DOUBLE THEN 'train'
                        ELSE 'validate' END AS split FROM p""",
)
def split_by_time(spark, sf):
    rows = s.plain_orders(spark, sf).select("o_orderkey", "YEAR", "DEP_DATETIME_LAG")
    return time_split(rows, "DEP_DATETIME_LAG", _hold()).select("o_orderkey", "split")


def _down_sql(ratio: str) -> str:
    return f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT o_orderkey, "YEAR", DEP_DEL15 FROM plain_orders
WHERE "YEAR" = 2001 OR DEP_DEL15 = 1 OR {_HASH} < (SELECT {ratio} FROM plain_orders)"""


@query(
    "downsample_fixed",
    _down_sql(
        """count(*) FILTER (WHERE DEP_DEL15 = 1 AND "YEAR" <> 2001)
  / count(*) FILTER (WHERE DEP_DEL15 = 0 AND "YEAR" <> 2001)"""
    ),
)
def downsample_fixed(spark, sf):
    rows = s.plain_orders(spark, sf)
    return downsample(rows, "DEP_DEL15", ["o_orderkey"], _hold()).select(
        "o_orderkey", "YEAR", "DEP_DEL15"
    )


@query(
    "downsample",
    _down_sql(
        """count(*) FILTER (WHERE DEP_DEL15 = 1 OR "YEAR" = 2001)
  / count(*) FILTER (WHERE DEP_DEL15 = 0 AND "YEAR" <> 2001)"""
    ),
)
def downsample_with_holdout(spark, sf):
    rows = s.plain_orders(spark, sf)
    return downsample(rows, "DEP_DEL15", ["o_orderkey"], _hold(), count_holdout=True).select(
        "o_orderkey", "YEAR", "DEP_DEL15"
    )


@query(
    "downsample_by_year",
    f"""WITH {s.PLAIN_ORDERS_SQL},
f AS (SELECT "YEAR", count(*) FILTER (WHERE DEP_DEL15 = 1) / count(*) FILTER (WHERE DEP_DEL15 = 0) AS r
      FROM plain_orders GROUP BY "YEAR")
SELECT o_orderkey, "YEAR", DEP_DEL15 FROM plain_orders JOIN f USING ("YEAR")
WHERE "YEAR" <> 2001 AND (DEP_DEL15 = 1 OR {_HASH} < r)""",
)
def downsample_by_year(spark, sf):
    rows = s.plain_orders(spark, sf)
    return downsample_by(rows, "DEP_DEL15", ["o_orderkey"], "YEAR", _hold()).select(
        "o_orderkey", "YEAR", "DEP_DEL15"
    )


@query(
    "upsample",
    f"""WITH {s.PLAIN_ORDERS_SQL},
f AS (SELECT greatest(count(*) FILTER (WHERE DEP_DEL15 = 0) / count(*) FILTER (WHERE DEP_DEL15 = 1) - 1, 0) AS m
      FROM plain_orders),
c AS (SELECT o_orderkey, DEP_DEL15, CASE WHEN DEP_DEL15 = 1
        THEN CAST(floor(m) AS INTEGER) + CAST({_HASH} < m - floor(m) AS INTEGER) ELSE 0 END AS extra
      FROM plain_orders, f)
SELECT o_orderkey, DEP_DEL15, CAST(i AS INTEGER) AS copy
FROM (SELECT o_orderkey, DEP_DEL15, unnest(range(0, extra + 1)) AS i FROM c)""",
)
def upsample_minority(spark, sf):
    rows = s.plain_orders(spark, sf).select("o_orderkey", "DEP_DEL15")
    return upsample(rows, "DEP_DEL15", ["o_orderkey"], out="copy")


@query(
    "random_split",
    f"SELECT o_orderkey, CASE WHEN {_HASH} < 0.7 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def random_split(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    return hash_split(orders.select("o_orderkey"), ["o_orderkey"], 0.7)


@query("hash_sample", f"SELECT o_orderkey FROM orders WHERE {_HASH} < 0.4")
def sample(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    return hash_sample(orders.select("o_orderkey"), ["o_orderkey"], 0.4)
