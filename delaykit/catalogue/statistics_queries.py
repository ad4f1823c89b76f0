"""Correlations, trends, indexing and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.config import FeatureSet
from delaykit.ml.preparation import build_pipeline
from delaykit.operators import correlation
from delaykit.operators.labels import index_labels, label_dictionary

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late"]
_LINES = """
lines AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
                 CAST(l_returnflag = 'R' AS INTEGER)::DOUBLE AS late,
                 CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem)"""


def _lines(spark, sf):
    (lineitem,) = tables(spark, sf, "lineitem")
    return lineitem.select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_returnflag") == "R").cast("double").alias("late"),
        F.year("l_shipdate").alias("y"),
    )


def _matrix_sql(source: str, prefix: str = "", tail: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {prefix}'{a}' AS row_name, '{b}' AS col_name, round(corr({a}, {b}), 6) AS corr FROM {source}{tail}"
        for a in _COLUMNS
        for b in _COLUMNS
    )


@query(
    "pearson_vs_label",
    f"WITH {_LINES}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(corr({c}, late), 6) AS corr FROM lines" for c in _COLUMNS[:-1]
    ),
)
def pearson_vs_label(spark, sf):
    table = correlation.pearson_vs_label(_lines(spark, sf), _COLUMNS[:-1], "late")
    return table.withColumn("corr", F.round("corr", 6))


@query("pearson_matrix", f"WITH {_LINES}\n{_matrix_sql('lines')}")
def pearson_matrix(spark, sf):
    table = correlation.pearson_matrix(_lines(spark, sf), _COLUMNS)
    return table.withColumn("corr", F.round("corr", 6))


_RANKED = "ranked AS (SELECT " + ", ".join(
    f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2)::DOUBLE AS {c}"
    for c in _COLUMNS
) + " FROM lines{where})"


@query(
    "spearman_matrix", f"WITH {_LINES}, {_RANKED.format(where='')}\n{_matrix_sql('ranked')}"
)
def spearman_matrix(spark, sf):
    table = correlation.spearman_matrix(_lines(spark, sf), _COLUMNS)
    return table.withColumn("corr", F.round("corr", 6))


@query(
    "spearman_nulls",
    """WITH holes AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS a, l_quantity AS b,
         CASE WHEN l_linenumber % 3 > 0 THEN l_extendedprice END AS c FROM lineitem),
ranked AS (
  SELECT CASE WHEN a IS NOT NULL THEN rank() OVER (PARTITION BY a IS NULL ORDER BY a)
           + (count(*) OVER (PARTITION BY a) - 1) / 2 END::DOUBLE AS a,
         CASE WHEN b IS NOT NULL THEN rank() OVER (PARTITION BY b IS NULL ORDER BY b)
           + (count(*) OVER (PARTITION BY b) - 1) / 2 END::DOUBLE AS b,
         CASE WHEN c IS NOT NULL THEN rank() OVER (PARTITION BY c IS NULL ORDER BY c)
           + (count(*) OVER (PARTITION BY c) - 1) / 2 END::DOUBLE AS c FROM holes)
SELECT unnest(['a', 'a', 'a', 'b', 'b', 'b', 'c', 'c', 'c']) AS row_name,
       unnest(['a', 'b', 'c', 'a', 'b', 'c', 'a', 'b', 'c']) AS col_name,
       unnest([x[1], x[2], x[3], x[2], x[4], x[5], x[3], x[5], x[6]]) AS corr
FROM (SELECT [round(corr(a, a), 6), round(corr(a, b), 6), round(corr(a, c), 6), round(corr(b, b), 6),
              round(corr(b, c), 6), round(corr(c, c), 6)] AS x FROM ranked)""",
)
def spearman_nulls(spark, sf):
    (lineitem,) = tables(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    holes = lineitem.select(
        F.when(n % 2 == 0, F.col("l_quantity")).alias("a"),
        F.col("l_quantity").alias("b"),
        F.when(n % 3 > 0, F.col("l_extendedprice")).alias("c"),
    )
    return correlation.spearman_matrix(holes, ["a", "b", "c"]).withColumn("corr", F.round("corr", 6))


_PERIODS = {"all": None, "1996-1999": (1996, 1999), "1998-1999": (1998, 1999), "2001": (2001, 2001)}


def _where(r) -> str:
    return "" if r is None else f" WHERE y BETWEEN {r[0]} AND {r[1]}"


@query(
    "pearson_by_period",
    f"WITH {_LINES}\n"
    + "\nUNION ALL\n".join(
        _matrix_sql("lines", f"'{name}' AS period_name, ", _where(r)) for name, r in _PERIODS.items()
    ),
)
def pearson_by_period(spark, sf):
    table = correlation.pearson_by_period(_lines(spark, sf), _COLUMNS, "y", _PERIODS)
    return table.withColumn("corr", F.round("corr", 6))


@query(
    "spearman_by_period",
    "\nUNION ALL\n".join(
        f"SELECT * FROM (WITH {_LINES}, {_RANKED.format(where=_where(r))}\n"
        + _matrix_sql("ranked", f"'{name}' AS period_name, ")
        + ")"
        for name, r in _PERIODS.items()
    ),
)
def spearman_by_period(spark, sf):
    table = correlation.spearman_by_period(_lines(spark, sf), _COLUMNS, "y", _PERIODS)
    return table.withColumn("corr", F.round("corr", 6))


@query(
    "correlation_with_label",
    f"WITH {_LINES}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS row_name, round(corr({c}, late), 6) AS corr FROM lines" for c in _COLUMNS
    ),
)
def correlation_with_label(spark, sf):
    matrix = correlation.pearson_matrix(_lines(spark, sf), _COLUMNS)
    return correlation.versus(matrix, "late").withColumn("corr", F.round("corr", 6))


@query(
    "yearly_delay_trend",
    f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT "YEAR", count(o_orderkey) AS total_flights, sum(DEP_DEL15) AS total_delayed_flights,
       round(sum(DEP_DEL15) / count(o_orderkey) * 100, 9) AS perc_delay_total
FROM plain_orders GROUP BY "YEAR" """,
)
def yearly_delay_trend(spark, sf):
    trend = correlation.yearly_trend(s.plain_orders(spark, sf), "YEAR", "DEP_DEL15", "o_orderkey")
    return trend.withColumn("perc_delay_total", r9("perc_delay_total"))


@query(
    "string_index",
    """WITH f AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY ALL),
i AS (SELECT v, (row_number() OVER (ORDER BY n DESC, v) - 1)::DOUBLE AS idx FROM f)
SELECT o_orderkey, idx AS carrier_idx FROM orders JOIN i ON v = o_orderpriority""",
)
def string_index(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    known = label_dictionary(orders, "o_orderpriority")
    return index_labels(orders, "o_orderpriority", known, "carrier_idx").select("o_orderkey", "carrier_idx")


@query(
    "string_index_many",
    """WITH f AS (SELECT CAST(l_orderkey AS VARCHAR) AS v, count(*) AS n FROM lineitem WHERE l_linenumber > 1 GROUP BY ALL),
i AS (SELECT v, (row_number() OVER (ORDER BY n DESC, v) - 1)::DOUBLE AS idx FROM f)
SELECT l_orderkey, l_linenumber, idx FROM lineitem JOIN i ON v = CAST(l_orderkey AS VARCHAR)""",
)
def string_index_many(spark, sf):
    """Nearly as many labels as rows; labels that the fitted rows never had are skipped."""
    (lineitem,) = tables(spark, sf, "lineitem")
    known = label_dictionary(lineitem.filter("l_linenumber > 1"), "l_orderkey")
    return index_labels(lineitem, "l_orderkey", known, "idx").select("l_orderkey", "l_linenumber", "idx")


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
       / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS scaled FROM orders""",
)
def standard_scale(spark, sf):
    rows = tables(spark, sf, "orders")[0].select("o_orderkey", "o_totalprice")
    fitted = build_pipeline(rows, FeatureSet("price", (), ("o_totalprice",)), scale=True)
    return fitted.transform(rows).select(
        "o_orderkey", F.round(vector_to_array("scaledFeatures")[0], 6).alias("scaled")
    )
