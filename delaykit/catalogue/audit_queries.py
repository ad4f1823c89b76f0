"""Cleaning and data audits."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.operators import audits, keys
from delaykit.operators.cleaning import (
    clamp_negative,
    drop_above,
    drop_null_keys,
    exact_dedup,
    fill_constants,
    mean_impute,
)


@query(
    "dedup_rows",
    """SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag
FROM (SELECT DISTINCT * FROM lineitem)""",
)
def dedup_rows(spark, sf):
    (lineitem,) = tables(spark, sf, "lineitem")
    twice = lineitem.unionByName(lineitem)
    return exact_dedup(twice.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "dedup_projected",
    """SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT DISTINCT * FROM lineitem)""",
)
def dedup_projected(spark, sf):
    """Distinct over whole rows, three columns kept: rows that differ elsewhere both stay."""
    (lineitem,) = tables(spark, sf, "lineitem")
    return exact_dedup(lineitem.unionByName(lineitem), ["l_orderkey", "l_linenumber", "l_returnflag"])


@query(
    "dedup_nulls",
    """WITH swapped AS (
  SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS a,
         CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber END AS b,
         CASE WHEN l_quantity > 25 THEN l_linenumber + 1 - l_linenumber % 2 END AS c
  FROM lineitem)
SELECT l_orderkey FROM (SELECT DISTINCT * FROM (SELECT * FROM swapped UNION ALL SELECT * FROM swapped))""",
)
def dedup_nulls(spark, sf):
    """Rows that differ only in where their nulls sit stay apart, in columns that go afterwards."""
    (lineitem,) = tables(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    swapped = lineitem.select(
        "l_orderkey", F.when(n % 2 == 0, n).alias("a"), F.when(n % 2 == 1, n).alias("b"),
        F.when(F.col("l_quantity") > 25, n + 1 - n % 2).alias("c"),
    )
    return exact_dedup(swapped.unionByName(swapped), ["l_orderkey"])


@query(
    "key_audit",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE n > 1) AS n_repeated_keys, sum(n) = count(*) AS is_key
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def key_audit(spark, sf):
    return audits.key_audit(tables(spark, sf, "lineitem")[0], ["l_orderkey", "l_linenumber"])


@query(
    "key_audit_events",
    """SELECT count(*) AS n_rows, count(DISTINCT (user_id, ts)) AS n_keys,
       count(*) - count(DISTINCT (user_id, ts)) AS n_repeated_keys,
       count(*) = count(DISTINCT (user_id, ts)) AS is_key FROM events""",
)
def key_audit_events(spark, sf):
    return audits.key_audit(tables(spark, sf, "events")[0], ["user_id", "ts"])


@query(
    "dependency_audit",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_dependents
FROM orders GROUP BY o_custkey""",
)
def dependency_audit(spark, sf):
    return audits.dependency_audit(tables(spark, sf, "orders")[0], "o_custkey", "o_orderpriority")


@query(
    "dependency_audit_top",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS n_dependents
FROM lineitem GROUP BY l_suppkey ORDER BY n_dependents DESC, l_suppkey LIMIT 3""",
)
def dependency_audit_top(spark, sf):
    return audits.dependency_audit(tables(spark, sf, "lineitem")[0], "l_suppkey", "l_partkey", 3)


@query(
    "distinct_counts",
    """SELECT 'supplier' AS key_name, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'order line', count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'price', count(DISTINCT l_extendedprice) FROM lineitem
UNION ALL SELECT 'ship day', count(DISTINCT l_shipdate) FROM lineitem""",
)
def distinct_counts(spark, sf):
    return audits.distinct_counts(
        tables(spark, sf, "lineitem")[0],
        {
            "supplier": ["l_suppkey"],
            "order line": ["l_orderkey", "l_linenumber"],
            "price": ["l_extendedprice"],
            "ship day": ["l_shipdate"],
        },
    )


@query(
    "unequal_rows",
    """SELECT count(*) FILTER (WHERE c_nationkey <> s_nationkey) AS n_unequal, count(*) AS n_rows
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey""",
)
def unequal_rows(spark, sf):
    return audits.unequal_rows(s.routes(spark, sf), "ORIGIN", "DEST")


@query(
    "co_nullity",
    """SELECT count(*) FILTER (WHERE a AND b) AS n_both, count(*) FILTER (WHERE a AND NOT b) AS n_first_only,
       count(*) FILTER (WHERE NOT a AND b) AS n_second_only,
       count(*) FILTER (WHERE NOT a AND NOT b) AS n_neither
FROM (SELECT event_type = 'error' AS a, value > 30 AS b FROM events)""",
)
def co_nullity(spark, sf):
    (events,) = tables(spark, sf, "events")
    holed = events.select(
        F.when(F.col("event_type") != "error", F.col("value")).alias("x"),
        F.when(F.col("value") <= 30, F.col("value")).alias("y"),
    )
    return audits.co_nullity(holed, F.col("x").isNull(), F.col("y").isNull())


def _holed_documents(spark, sf):
    """Documents with some columns emptied, so that every kind of missing value occurs."""
    (documents,) = tables(spark, sf, "documents")
    return documents.select(
        F.when(F.col("n_chars") > 500, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") > 2000, "None").otherwise(F.col("source")).alias("source"),
        F.when(F.col("n_chars") > 300, F.col("n_chars").cast("double"))
        .otherwise(F.lit(float("nan")))
        .alias("size"),
        "text",
    )


_HOLED = """
h AS (
  SELECT CASE WHEN n_chars > 500 THEN doc_id END AS doc_id,
         CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang,
         CASE WHEN n_chars > 2000 THEN 'None' ELSE source END AS source,
         CASE WHEN n_chars > 300 THEN n_chars::DOUBLE ELSE 'NaN'::DOUBLE END AS size, text
  FROM documents
)"""


def _null_audit_sql(column: str, text: bool, real: bool) -> str:
    blank = f"{column} = ''" if text else "false"
    spelled = f"{column} LIKE '%None%' OR {column} LIKE '%NULL%'" if text else "false"
    nan = f"isnan({column})" if real else "false"
    return f"""SELECT '{column}' AS column_name, count(*) FILTER (WHERE {column} IS NULL) AS n_null,
  count(*) FILTER (WHERE {blank}) AS n_blank, count(*) FILTER (WHERE {spelled}) AS n_spelled,
  count(*) FILTER (WHERE {nan}) AS n_nan,
  count(*) FILTER (WHERE {column} IS NULL OR {blank} OR {spelled} OR {nan}) AS n_missing,
  count(*) AS n_rows FROM h"""


@query(
    "null_audit",
    f"WITH {_HOLED}\n"
    + "\nUNION ALL\n".join(
        [
            _null_audit_sql("doc_id", False, False),
            _null_audit_sql("lang", True, False),
            _null_audit_sql("source", True, False),
            _null_audit_sql("size", False, True),
            _null_audit_sql("text", True, False),
        ]
    ),
)
def null_audit(spark, sf):
    return audits.null_audit(_holed_documents(spark, sf))


@query(
    "unparseable_audit",
    r"""
SELECT c AS column_name,
       count(*) FILTER (WHERE NOT coalesce(regexp_full_match(trim(v), '[+-]?(\d+\.?\d*|\.\d+)'), false))
         AS n_unparseable,
       count(*) FILTER (WHERE v IS NULL) AS n_null, count(*) AS n_rows
FROM (
  SELECT 'number' AS c, CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS v FROM events
  UNION ALL SELECT 'kind', event_type FROM events
  UNION ALL SELECT 'mixed', CASE WHEN event_type = 'view' THEN 'T' ELSE CAST(user_id AS VARCHAR) END FROM events
) GROUP BY c""",
)
def unparseable_audit(spark, sf):
    (events,) = tables(spark, sf, "events")
    texts = events.select(
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).alias("number"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "view", "T")
        .otherwise(F.col("user_id").cast("string"))
        .alias("mixed"),
    )
    return audits.unparseable_audit(texts, ["number", "kind", "mixed"])


@query(
    "describe_stats",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem"""
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def describe_stats(spark, sf):
    table = audits.describe_numeric(
        tables(spark, sf, "lineitem")[0], ["l_quantity", "l_discount", "l_tax"]
    )
    return table.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


_TEXTS = ("l_returnflag", "l_linestatus", "l_orderkey")


@query(
    "describe_text",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, count(DISTINCT {c}) AS n_distinct,
       min(CAST({c} AS VARCHAR)) AS min, max(CAST({c} AS VARCHAR)) AS max FROM lineitem"""
        for c in _TEXTS
    ),
)
def describe_text(spark, sf):
    return audits.describe_text(tables(spark, sf, "lineitem")[0], _TEXTS)


@query(
    "group_count_sorted",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n_rows
FROM orders GROUP BY ALL ORDER BY n_rows DESC""",
)
def group_count_sorted(spark, sf):
    return audits.group_counts(tables(spark, sf, "orders")[0], "o_orderpriority", "o_orderstatus")


@query(
    "having_sum",
    """SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem
GROUP BY l_suppkey HAVING sum(l_quantity) >= 14000 ORDER BY total DESC""",
)
def having_sum(spark, sf):
    return audits.group_sums(tables(spark, sf, "lineitem")[0], "l_suppkey", "l_quantity", 14000)


@query(
    "mean_impute",
    """WITH h AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
       CASE WHEN event_type <> 'view' THEN CAST(user_id AS DOUBLE) END AS unit FROM events)
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM h)), 6) AS value,
       round(coalesce(unit, (SELECT avg(unit) FROM h)), 6) AS unit FROM h""",
)
def impute(spark, sf):
    (events,) = tables(spark, sf, "events")
    holed = events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("double")).alias("unit"),
    )
    filled = mean_impute(holed, ["value", "unit"])
    return filled.select(
        "event_id", F.round("value", 6).alias("value"), F.round("unit", 6).alias("unit")
    )


@query(
    "clamp_negative",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS clamped
FROM customer""",
)
def clamp(spark, sf):
    (customer,) = tables(spark, sf, "customer")
    return clamp_negative(customer.select("c_custkey", "c_acctbal"), "c_acctbal", "clamped")


@query(
    "null_rules",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 1.0 ELSE value END AS label,
       CASE WHEN event_type = 'click' THEN 'NONE' ELSE event_type END AS kind
FROM events WHERE event_type <> 'view' AND value <= 50""",
)
def null_rules(spark, sf):
    """Drop null keys, drop outliers, fill the rest by constants of the column's type."""
    (events,) = tables(spark, sf, "events")
    holed = events.select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("key"),
        F.col("value"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("label"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"),
    )
    kept = drop_above(drop_null_keys(holed, ["key"]), "value", 50)
    return fill_constants(kept, {"label": 1, "kind": "NONE"}).select("event_id", "label", "kind")


@query(
    "projection_rename_filter",
    """SELECT o_orderkey AS flight_id, CAST(year(o_orderdate) AS INTEGER) AS "YEAR", o_totalprice
FROM orders WHERE year(o_orderdate) <> 2001 AND (o_orderstatus = 'F' OR o_totalprice > 200000)""",
)
def projection_rename_filter(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    dated = orders.withColumn("YEAR", F.year("o_orderdate")).withColumnRenamed("o_orderkey", "flight_id")
    return dated.filter(
        (F.col("YEAR") != 2001) & ((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 200000))
    ).drop("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


@query(
    "measure_means",
    f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT "YEAR", round(avg(o_totalprice), 2) AS o_totalprice, round(avg(DEP_DEL15), 9) AS "DEP_DEL15"
FROM plain_orders GROUP BY "YEAR" """,
)
def measure_means(spark, sf):
    from delaykit.operators.weather import rollup

    means = rollup(s.plain_orders(spark, sf), ["YEAR"], ["o_totalprice", "DEP_DEL15"])
    return means.select(
        "YEAR", F.round("o_totalprice", 2).alias("o_totalprice"), r9("DEP_DEL15").alias("DEP_DEL15")
    )


def _key_search_sql(table: str, columns: tuple[str, ...], size: int) -> str:
    """All sets counted, then keys and dependencies that hold no smaller one."""
    columns = tuple(sorted(columns))
    name = lambda cs: "c_" + "_".join(str(columns.index(c)) for c in cs) if cs else "1"
    sets = [cs for k in range(1, size + 1) for cs in combinations(columns, k)]
    counts = ", ".join(f"count(DISTINCT ({', '.join(cs)})) AS {name(cs)}" for cs in sets)
    below = lambda cs: [x for k in range(1, len(cs)) for x in combinations(cs, k)]
    none = lambda tests: "".join(f" AND NOT ({t})" for t in tests)
    rows = []
    for cs in sets:
        no_key = none(f"{name(x)} = n" for x in below(cs))
        rows.append(f"SELECT 'key' AS kind, '{','.join(cs)}' AS columns, NULL AS determines FROM c WHERE {name(cs)} = n{no_key}")
        for c in cs:
            left = tuple(x for x in cs if x != c)
            with_c = lambda x, c=c: tuple(sorted((*x, c)))
            smaller = none(f"{name(x)} = {name(with_c(x))}" for x in ([()] if left else []) + below(left))
            rows.append(
                f"SELECT 'dependency', '{','.join(left)}', '{c}' FROM c WHERE {name(left)} = {name(cs)}{no_key}{smaller}"
            )
    return f"WITH c AS (SELECT count(*) AS n, {counts} FROM {table})\n" + "\nUNION ALL\n".join(rows)


_KEY_COLUMNS = {
    "lineitem": ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"),
    "orders": ("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"),
    "customer": ("c_custkey", "c_nationkey", "c_mktsegment"),
}


@query("key_search_lineitem", _key_search_sql("lineitem", _KEY_COLUMNS["lineitem"], 3))
def key_search_lineitem(spark, sf):
    return keys.key_search(tables(spark, sf, "lineitem")[0], _KEY_COLUMNS["lineitem"], 3)


@query("key_search_orders", _key_search_sql("orders", _KEY_COLUMNS["orders"], 3))
def key_search_orders(spark, sf):
    return keys.key_search(tables(spark, sf, "orders")[0], _KEY_COLUMNS["orders"], 3)


@query("key_search_customer", _key_search_sql("customer", _KEY_COLUMNS["customer"], 3))
def key_search_customer(spark, sf):
    return keys.key_search(tables(spark, sf, "customer")[0], _KEY_COLUMNS["customer"], 3)
