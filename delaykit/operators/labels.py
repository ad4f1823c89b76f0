"""A label dictionary that no driver holds: labels indexed by their place in the order of frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.operators.lookup import sized_lookup
from delaykit.sources.sinks import staged


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(label, n, index) of every value of a column, nulls left out: index 0 is the most frequent one,
    equal counts go by the label as text.

    The counted labels are sorted by range over all tasks. An index is the number of labels in the
    ranges before plus the place inside the range, so neither sorting nor numbering has one task.
    """
    label = F.col(f"`{column}`").cast("string").alias("label")
    counted = df.select(label).filter("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # written, so that the ranges are the same for whoever reads them
    ranges = staged(counted.repartitionByRange(F.desc("n"), "label").withColumn("range", F.spark_partition_id()), "labels")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("held")).select(
        "range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.desc("n"), "label"))
    return ranges.join(F.broadcast(offsets), "range").select("label", "n", (F.col("offset") + place - 1).alias("index"))


def index_labels(df: DataFrame, column: str, dictionary: DataFrame, out: str, keep_unseen: bool = False) -> DataFrame:
    """``df`` with the index (a double) of its label. Rows whose label is null or not in the dictionary are
    skipped, or kept with a null. The dictionary is broadcast if its measured size allows it."""
    known = sized_lookup(dictionary.select(F.col("label").alias("__label"), F.col("index").cast("double").alias(out)))
    same = F.col(f"`{column}`").cast("string") == F.col("__label")
    return df.join(known, same, "left" if keep_unseen else "inner").drop("__label")
