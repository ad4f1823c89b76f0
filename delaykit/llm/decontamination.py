"""Benchmark decontamination by size-partitioned MinHash containment search (method 8).

Texts are lower-cased in A-Z and cut into shingles of five words (fewer words: the whole sequence is
the one shingle; none: no shingle, never a hit). A document holds an item if it has at least 80 % of
the item's distinct shingles, however long it is.

Items are partitioned by size, a power of two of their shingle count. Every partition has its own
sketch length: with at most ``n`` shingles, a document that holds 80 % lacks at most ``n / 5`` of
them, so of the ``n // 5 + 1`` smallest hashes of the item it has at least one. The sketch is the
MinHash of that many smallest values, and no hit can be missed. Documents stream past the sketches
with all their shingles; what meets a value is checked by counting the item's shingles, compared as
words, in the document.

Items are handled in blocks of a bounded number of shingles, one pass over the documents each, so
what is broadcast does not grow with the benchmark. An item longer than a block is a block of its
own. Rows with equal or null ids count one by one. Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import SHINGLE_SLICE, gram_hashes, gram_starts, hash_strings, in_arrow, lower_ascii, split_words

SHINGLE = 5
BLOCK_SHINGLES = 500_000
SIEVE_BITS = 22


def shingle_rows(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offsets, shingle start places, their hashes, shingle offsets per text).

    A text of one to four words has one shingle, at its first word.
    """
    words, offsets = split_words(lower_ascii(texts))
    hashes = hash_strings(words)
    lengths = np.diff(offsets)
    starts = gram_starts(offsets, SHINGLE)
    grams = gram_hashes(hashes, SHINGLE)[starts] if len(starts) else np.zeros(0, np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    if len(short):
        own = np.array([gram_hashes(hashes[offsets[r] : offsets[r + 1]], int(lengths[r]))[0] for r in short], np.uint64)
        starts = np.concatenate([starts, offsets[short]])
        grams = np.concatenate([grams, own])
        order = np.argsort(starts, kind="stable")
        starts, grams = starts[order], grams[order]
    return words, offsets, starts, grams, np.searchsorted(starts, offsets)


def shingle_text(words: pa.Array, offsets: np.ndarray, row: int, start: int) -> str:
    stop = min(int(offsets[row + 1]), start + SHINGLE)
    return " ".join(words.slice(start, stop - start).to_pylist())


class Sketches:
    """The items of one block: shingles by hash, sketch values, and a sieve in front of them."""

    def __init__(self, ids: list, texts: list[str | None], threshold: tuple[int, int]):
        self.ids, self.shingles, sketch, owner = ids, [], [], []
        words, offsets, starts, grams, at = shingle_rows(pa.array(texts, pa.string()))
        for row in range(len(ids)):
            own = {}
            for i in range(at[row], at[row + 1]):
                own.setdefault(shingle_text(words, offsets, row, int(starts[i])), grams[i])
            self.shingles.append(own)
            if own:
                most = 2 ** len(own).bit_length() - 1  # the largest size of this item's partition
                size = min(len(own), most - -(-most * threshold[0] // threshold[1]) + 1)
                for h in sorted(own.values())[:size]:
                    sketch.append(h)
                    owner.append(row)
        order = np.argsort(np.array(sketch, np.uint64), kind="stable")
        self.values = np.array(sketch, np.uint64)[order]
        self.owner = np.array(owner, np.int64)[order]
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[(self.values >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True

    def candidates(self, grams: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) pairs that meet on a sketch value."""
        near = np.flatnonzero(self.sieve[(grams >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
        low = np.searchsorted(self.values, grams[near], "left")
        high = np.searchsorted(self.values, grams[near], "right")
        rows = np.searchsorted(at, near, "right") - 1
        return sorted({(int(r), int(self.owner[i])) for r, a, b in zip(rows, low, high) if a < b for i in range(a, b)})


def containment(
    documents: DataFrame, items: DataFrame, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every document that holds an item."""
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    wanted = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {wanted.schema['item_id'].dataType.simpleString()}, "
        "n_shingles long, n_shared long, containment double"
    )
    # words are at most half the characters, so this bounds the shingles of a block before any is made
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1
    total = wanted.agg(F.sum(weight).alias("n")).first()["n"] or 0
    blocks = int(total // BLOCK_SHINGLES) + 1
    blocked = wanted.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = []
    for block in range(blocks):
        rows = blocked.filter(F.col("block") == block).collect()
        if not rows and parts:
            continue
        sketches = spark.sparkContext.broadcast(
            Sketches([r["item_id"] for r in rows], [r["text"] for r in rows], threshold)
        )
        parts.append(in_arrow(docs, search(sketches, threshold, schema), schema, SHINGLE_SLICE))
    return reduce(DataFrame.union, parts)


def search(sketches, threshold: tuple[int, int], schema: str):
    def run(batches):
        block = sketches.value
        for batch in batches:
            words, offsets, starts, grams, at = shingle_rows(batch.column(1))
            rows, items, sizes, shared = [], [], [], []
            for row, item in block.candidates(grams, at):
                own = block.shingles[item]
                part = grams[at[row] : at[row + 1]]
                places = at[row] + np.flatnonzero(np.isin(part, np.fromiter(own.values(), np.uint64, len(own))))
                found = {shingle_text(words, offsets, row, int(starts[p])) for p in places} & own.keys()
                if len(found) * threshold[1] >= len(own) * threshold[0]:
                    rows.append(row)
                    items.append(block.ids[item])
                    sizes.append(len(own))
                    shared.append(len(found))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)), pa.array(items), pa.array(sizes, pa.int64()),
                        pa.array(shared, pa.int64()), pa.array([a / b for a, b in zip(shared, sizes)], pa.float64()),
                    ],
                    ["doc_id", "item_id", "n_shingles", "n_shared", "containment"],
                )

    return run
