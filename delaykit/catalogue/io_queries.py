"""Sources and sinks: written, read back, compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.operators.metrics import threshold_table
from delaykit.session import checkpoint_dir
from delaykit.sources import readers, sinks, versions


def _folder(spark) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"


@query(
    "checkpoint_roundtrip",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS "YEAR", count(*) AS n_rows FROM orders
WHERE year(o_orderdate) <> 2001 GROUP BY ALL""",
)
def checkpoint_roundtrip(spark, sf):
    path = _folder(spark)
    versions.overwrite(s.plain_orders(spark, sf), path, "YEAR")
    stage, periods = sinks.reload_stage(spark, path, "YEAR", holdout=s.HOLDOUT)
    return (
        stage.join(periods, "YEAR", "left_semi")
        .groupBy("YEAR")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "csv_roundtrip",
    """SELECT n_name AS id, CAST(n_nationkey AS INTEGER) AS year_number, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def csv_roundtrip(spark, sf):
    """Lookup table out as CSV, in as all-text CSV, and on to Parquet."""
    nation, region = tables(spark, sf, "nation", "region")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("id"), F.col("n_nationkey").alias("year_number"), F.col("r_name").alias("region")
    )
    text, columnar = _folder(spark), _folder(spark)
    rows.write.option("header", True).csv(text)
    readers.csv_to_parquet(spark, text, columnar, "id string, year_number string, region string")
    return readers.read_parquet(spark, columnar).withColumn(
        "year_number", F.col("year_number").cast("int")
    )


@query(
    "glob_scan",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS "YEAR", count(*) AS n_rows FROM orders
WHERE year(o_orderdate) BETWEEN 1995 AND 1999 GROUP BY ALL""",
)
def glob_scan(spark, sf):
    """A glob picks some of the folders of a stage."""
    path = _folder(spark)
    sinks.write_stage(s.plain_orders(spark, sf).withColumn("y", F.col("YEAR")), path, "y")
    return readers.read_parquet(spark, f"{path}/y=199[5-9]").groupBy("YEAR").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "text_roundtrip",
    """SELECT CAST(l_orderkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem""",
)
def text_roundtrip(spark, sf):
    (lineitem,) = tables(spark, sf, "lineitem")
    path = _folder(spark)
    sinks.write_tabbed(lineitem.select("l_orderkey", "l_suppkey"), path)
    return readers.read_tabbed(spark, path, ["src", "dst"])


@query(
    "metrics_log",
    f"""WITH {s.SCORED_SQL},
c AS (SELECT unnest([0.5, 0.7])::DOUBLE AS threshold),
m AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND score > threshold) AS tp,
             count(*) FILTER (WHERE score > threshold) AS p FROM scored, c GROUP BY threshold)
SELECT 'backup' AS log, threshold, round(tp / p, 9) AS precision FROM m
UNION ALL SELECT 'log', 0.0, 0.0""",
)
def metrics_log(spark, sf):
    """Append two runs, back the log up and reset it; show both logs."""
    path, backups = _folder(spark), _folder(spark)
    table = threshold_table(s.scored(spark, sf), "label", "score", [0.5, 0.7])
    runs = table.select(
        F.current_timestamp().alias("date_time"),
        "precision",
        F.col("f05").alias("f0.5"),
        "recall",
        "accuracy",
        F.lit(0.0).alias("regParam"),
        F.lit(0.0).alias("elasticNetParam"),
        F.lit(5).alias("maxIter"),
        "threshold",
    )
    sinks.log_metrics(runs.filter(F.col("threshold") == 0.5), path)
    sinks.log_metrics(runs.filter(F.col("threshold") == 0.7), path)
    backup = sinks.reset_metrics(spark, path, backups)
    shown = lambda name, where: versions.read(spark, where).select(
        F.lit(name).alias("log"), "threshold", r9("precision").alias("precision")
    )
    return shown("backup", backup).unionByName(shown("log", path))


@query(
    "stage_versions",
    """WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_totalprice FROM orders),
v AS (SELECT 1 AS version, * FROM o WHERE y < 1998 UNION ALL SELECT 2, * FROM o WHERE y < 2000 UNION ALL SELECT 3, * FROM o WHERE y >= 2000)
SELECT version, y AS "YEAR", count(*) AS n_rows FROM v GROUP BY ALL""",
)
def stage_versions(spark, sf):
    """A stage that is written, added to and replaced; each of its versions stays readable."""
    path = _folder(spark)
    rows = s.plain_orders(spark, sf)
    early, later, last = "YEAR < 1998", "YEAR >= 1998 AND YEAR < 2000", "YEAR >= 2000"
    numbers = [
        versions.overwrite(rows.filter(early), path, "YEAR"), versions.append(rows.filter(later), path, "YEAR"),
        versions.overwrite(rows.filter(last), path, "YEAR"),
    ]
    parts = [versions.read(spark, path, n).select(F.lit(n).alias("version"), F.col("YEAR").cast("int").alias("YEAR")) for n in numbers]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("version", "YEAR").agg(F.count(F.lit(1)).alias("n_rows"))
