"""Helpers of the text operators: words, slices of Arrow batches, ragged arrays, stages.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; a null text has no words.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.session import checkpoint_dir

SLICE_BYTES = 8 << 20
SHINGLE_SLICE = 2 << 20  # where every word of a slice becomes several numbers
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of a rolling polynomial hash
FINAL = np.uint64(0xFF51AFD7ED558CCD)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lost executors cost nothing."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_arrow(df: DataFrame, fn: Callable, schema: T.StructType | str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` whose function sees record batches of at most ``slice_bytes`` of text each.

    Workers find this package where the driver has it; where machines share no such folder, ship
    it with ``--py-files``.
    """
    known = df.sparkSession.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(slices(batches, slice_bytes))

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``slice_bytes``; a longer row stands alone."""
    for batch in batches:
        start = 0
        sizes = np.zeros(batch.num_rows, np.int64)
        for c in batch.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                sizes += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + slice_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in one flat array, and the offsets of the texts in it."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    real = pc.greater(pc.binary_length(flat), 0)
    mask = real.to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(mask)]).astype(np.int64)
    return flat.filter(real), before[starts]


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, all else as is."""
    return pc.ascii_lower(texts)


def hash_strings(values: pa.Array, seed: int = 42) -> np.ndarray:
    """XXH64 of each string (null: of the empty one), distinct values hashed once."""
    coded = pc.fill_null(values, "").dictionary_encode()
    hashed = xxhash.xxh64_intdigest
    table_ = np.fromiter(
        (hashed(x, seed) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
    )
    return table_[coded.indices.to_numpy(zero_copy_only=False)] if len(table_) else np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * FINAL
    return h ^ (h >> np.uint64(29))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbours of a flat array (runs across texts included)."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = out * MIX + words[i : i + count]
    return mix(out)


def gram_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    """Flat positions at which ``n`` words lie inside one text."""
    total = int(offsets[-1])
    ok = np.zeros(max(0, total), bool)
    lengths = np.diff(offsets)
    for_all = np.repeat(offsets[1:], lengths)
    ok = np.arange(total) + n <= for_all
    return np.flatnonzero(ok)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text that each flat position belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def ragged_take(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a ragged array, joined, and their offsets."""
    lengths = (offsets[1:] - offsets[:-1])[rows]
    out = np.concatenate([[0], np.cumsum(lengths)])
    shift = np.repeat(offsets[:-1][rows] - out[:-1], lengths)
    return flat[np.arange(out[-1]) + shift], out


def held_out(column: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): smallest node of its component for every node of ``edges`` (a <> b).

    Alternating large-star and small-star rounds: each node's neighbours are tied to its smallest
    one, which ends after a number of rounds that grows with the logarithm of the longest chain.
    A hub keeps one row per neighbour: minima are aggregated, never gathered. Each round is written
    to the shared folder.
    """
    current = written(
        edges.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
        .filter("u < v").distinct(),
        "links",
    )
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(low, "u").filter("m < v")
            .select(F.col("m").alias("u"), "v").distinct()
        )
        large = written(large, "links")
        # small star: the smaller neighbours of v, and v itself, are tied to the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(low, "v")
        small = (
            tied.select(F.col("m").alias("u"), F.col("u").alias("v"))
            .union(tied.select(F.col("m").alias("u"), "v"))
            .filter("u < v").distinct()
        )
        current = written(small, "links")
        mark = current.agg(
            F.count("*").alias("n"),
            F.countDistinct("v").alias("d"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if mark["n"] == mark["d"] and mark == before:
            break
        before = mark
    stars = current.select(F.col("v").alias("node"), F.col("u").alias("root"))
    roots = current.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return stars.union(roots)
