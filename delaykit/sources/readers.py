"""Readers for Parquet, CSV and text inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.sources.sinks import write_stage

# size label of a data slice -> suffix of its folder (fixed values)
SLICES = {"3 months": "_3m", "6 months": "_6m", "1 year": "_1y", "all": ""}


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, slice_name: str = "all"
) -> DataFrame:
    """Parquet folder or glob; ``slice_name`` picks the 3m / 6m / 1y / full variant."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path.rstrip("/") + SLICES[slice_name])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schema: T.StructType, *partition_by: str
) -> None:
    """Ingest: read text once, keep it columnar from then on."""
    write_stage(read_csv(spark, source, schema), target, *partition_by)


def read_tabbed(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated text lines (an edge list) as named text columns."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the TPC-H-like tables, a single Parquet file or a folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
