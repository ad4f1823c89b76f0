"""Stage checkpoints, logs and text output."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.session import checkpoint_dir
from delaykit.sources import versions
from delaykit.sources.schemas import METRICS_LOG

ROW_GROUP = 8 << 20  # bytes that one task reads at least, where a file is read by several

_STAGED: dict[str, list[str]] = {}


def write_stage(df: DataFrame, path: str, *partition_by: str) -> None:
    """Overwrite a stage; partition columns let later reads prune. Rows of a partition value are
    brought together first (large ones are split again), so tasks do not each write a file for
    every value. Files are few then and their rows narrow, so row groups are small: a file of one group
    would be the work of one task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to a fresh place in the shared folder and read it back. The schema is
    given, so column metadata (feature names) survive and reading needs no look at the files."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    write_stage(df, path, *partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def release_stages(spark: SparkSession) -> int:
    """Remove what :func:`staged` wrote in this session, once nothing reads it any more."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        store = versions.Store(spark, path)
        store.fs.delete(store.at(), True)
    return len(paths)


def reload_stage(spark: SparkSession, path: str, period: str, holdout: int | None = None):
    """Reread a stage, versioned or plain, with its distinct periods (a DataFrame), holdout left out."""
    df = versions.read(spark, path) if versions.Store(spark, path).numbers() else spark.read.parquet(path)
    periods = df.select(period).distinct()
    return df, periods if holdout is None else periods.filter(F.col(period) != holdout)


def log_metrics(metrics: DataFrame, path: str) -> None:
    """Append a run to the metrics log, a versioned stage."""
    versions.append(metrics, path)


def reset_metrics(spark: SparkSession, path: str, backup_root: str, stamp: str | None = None) -> str:
    """Copy the log to a stamped stage, then start it anew with one row of zeros. A run that is logged
    meanwhile is in the copy or in the new log."""
    stamp = stamp or datetime.now(UTC).strftime("%Y-%m-%d-%H-%M-%S-%f")
    backup = f"{backup_root.rstrip('/')}/metrics-{stamp}"
    zero = spark.createDataFrame(
        [(datetime.now(UTC), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0.0)], METRICS_LOG
    )
    versions.start_anew(spark, path, zero, backup)
    return backup


def write_tabbed(df: DataFrame, path: str) -> None:
    """Columns as tab-separated text lines."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
