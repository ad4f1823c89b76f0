"""Session building and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "delaykit", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution and a UTC clock; ``conf`` holds further settings.

    On a cluster leave ``master`` unset so that spark-submit decides, and pass the shared
    checkpoint folder as ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # call sites per column expression cost more driver time than small plans take to run
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: the one the cluster names, or a fresh one in local mode.

    A cluster without a shared folder is an error: a machine-local folder would lose the
    data together with the machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None)
    current = context.getCheckpointDir()
    if named:
        # the context keeps its folder under a fresh name inside the one it was given
        if current is None or not current.rstrip("/").rpartition("/")[0].endswith(named.rstrip("/").removeprefix("file://")):
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="delaykit-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``; the copy outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
