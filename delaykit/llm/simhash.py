"""SimHash near-duplicates by meet-in-the-middle ball hashing (method 6).

Two fingerprints at Hamming distance 2 or less have a word between them at distance 1 or less from
both. So every distinct fingerprint emits itself and its 64 one-bit variants; fingerprints that meet
on a variant are candidates, each is tied to the smallest of its meeting, and the pair is checked. A
meeting holds at most 65 fingerprints, and all of them are within 2 bits of each other, so ties to
the smallest keep every component whole without listing pairs. Equal fingerprints (thousands of
copies) are one row before anything is emitted.

Null and empty texts have fingerprint 0. Rows with equal ids are separate rows with one component;
a null id takes part in grouping and only names a component if no other id does. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import SHINGLE_SLICE, components, in_arrow, lower_ascii, split_words, written

SEED = 42
CHUNK = 1 << 20
BITS = 64


def fingerprints(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """64-bit SimHash of each text over its word shingles, repeats counted."""
    words, offsets = split_words(lower_ascii(texts))
    lengths = np.diff(offsets)
    out = np.zeros(len(lengths), np.uint64)
    hashed = xxhash.xxh64_intdigest
    short = np.flatnonzero((lengths > 0) & (lengths < shingle))
    for row in short:
        joined = " ".join(words.slice(int(offsets[row]), int(lengths[row])).to_pylist())
        out[row] = hashed(joined, SEED)  # one shingle: its bits are the fingerprint
    rows = np.flatnonzero(lengths >= shingle)
    if not len(rows):
        return out
    count = len(words) - shingle + 1
    n = lengths[rows] - shingle + 1
    hashes = np.empty(count, np.uint64)
    for a in range(0, count, CHUNK // 4):
        b = min(count, a + CHUNK // 4)
        joined = pc.binary_join_element_wise(*[words.slice(a + i, b - a) for i in range(shingle)], " ")
        hashes[a:b] = np.fromiter((hashed(x, SEED) for x in joined.to_pylist()), np.uint64, b - a)
    for row, size in zip(rows, n):
        at = int(offsets[row])
        ones = np.zeros(BITS, np.int64)
        for a in range(at, at + int(size), CHUNK):
            part = hashes[a : min(a + CHUNK, at + int(size))]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.uint32)
        majority = np.packbits(ones * 2 > size, bitorder="little")
        out[row] = majority.view(np.uint64)[0]
    return out


def with_fingerprint(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row; ``fp`` holds the 64 bits of the fingerprint."""

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column(1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long", SHINGLE_SLICE)


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): every fingerprint tied to the smallest one it meets on a variant."""
    # bit 64 does not exist: that variant is the fingerprint itself
    variants = F.expr(f"transform(sequence(0, {BITS}), i -> IF(i = {BITS}, fp, fp ^ shiftleft(1L, i)))")
    balls = distinct.select("fp", F.explode(variants).alias("variant"))
    met = balls.withColumn("low", F.min("fp").over(Window.partitionBy("variant")))
    return (
        met.filter("low < fp")
        .filter(F.bit_count(F.col("low").bitwiseXOR(F.col("fp"))) <= 2)
        .select(F.col("low").alias("a"), F.col("fp").alias("b"))
        .distinct()
    )


def near_duplicates(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id among the rows that are reachable over links.
    """
    rows = written(with_fingerprint(df, shingle, id_col, text_col), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    tied = written(components(links(classes.select("fp"))), "components")
    members = tied.join(classes, tied["node"] == classes["fp"]).select("fp", "root", "first")
    lowest = members.groupBy("root").agg(F.min("first").alias("component"))
    smallest = members.join(lowest, "root").select("fp", "component")
    known = classes.join(smallest, "fp", "left").select(
        "fp", F.coalesce("component", "first").alias("component_id")
    )
    # equal fingerprints may be a third of all rows: with both sides read from files, adaptive
    # execution splits the partition of such a fingerprint
    known = written(known, "known")
    return rows.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
