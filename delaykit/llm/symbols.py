"""Modified Kneser-Ney models of byte n-grams, counted and estimated by Spark.

An n-gram is its bytes in a row, read as one number: a key without collisions. The byte 0xFF, which
UTF-8 never uses, is the pad before a text. What a model holds grows with the corpus, so its orders are
tables that Spark counts, joins and keeps; a finished table whose measured size is small is turned
into sorted arrays and broadcast, a larger one is joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import in_arrow, written

ORDER = 5
PAD = 0xFF
HELD_GRAMS = 1 << 21
#: Text taken apart at once: an n-gram takes 8 bytes, and several arrays of them are in use at a time.
GRAM_SLICE = 2 << 20
TEXT_BITS = 63 - 8 * ORDER
#: Entries of a table that is broadcast at most; an entry takes 12 bytes.
BROADCAST_ENTRIES = 8_000_000


def grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at every byte, offsets of the texts); a text is preceded by ``order - 1`` pads."""
    texts = pc.fill_null(texts, "")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    symbols = np.frombuffer(b"".join(x.as_buffer() for x in texts.cast(pa.binary())), np.uint8).astype(np.int64)
    out = symbols.copy()
    for back in range(1, order):
        out[back:] |= symbols[: max(0, len(symbols) - back)] << 8 * back
    # the first places of a text saw the text before it: their upper bytes become pads
    for at in range(order - 1):
        first = (offsets[:-1] + at)[lengths > at]
        pads = sum(PAD << 8 * i for i in range(at + 1, order))
        out[first] = out[first] & ((1 << 8 * (at + 1)) - 1) | pads
    return out, offsets


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with the sums of their counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[by], all_counts[by]
    heads = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]]))
    return all_keys[heads], np.add.reduceat(all_counts, heads)


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, c): how often each n-gram stands in ``texts`` (text). A task adds up what it has seen and
    passes it on whenever that is more than ``HELD_GRAMS`` n-grams, so its memory is bounded."""

    def run(batches):
        keys, counts = [], []
        for batch in batches:
            g, _ = grams(batch.column(0), order)
            if not len(g):
                continue
            g.sort()
            heads = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            k, c = merged([*keys, g[heads]], [*counts, np.diff(np.append(heads, len(g)))])
            keys, counts = [k], [c]
            if len(k) > HELD_GRAMS:
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["g", "c"])
                keys, counts = [], []
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], ["g", "c"])

    return in_arrow(texts.select("text"), run, "g long, c long", GRAM_SLICE).groupBy("g").agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> list[float]:
    """Discounts of the counts 1, 2, and 3 or more, from how many n-grams have the counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    own = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else min(0.5, k / 2) for k in (1, 2, 3)]
    return [min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), own)]


def discounted(level: DataFrame, count: str = "c") -> DataFrame:
    """``level`` with ``d``, the discount of its count."""
    row = level.agg(*[F.count(F.when(F.col(count) == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    one, two, more = discounts(list(row))
    c = F.col(count)
    return level.withColumn("d", F.when(c <= 0, 0.0).when(c == 1, one).when(c == 2, two).otherwise(more))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, log_p) of every n-gram in ``counts`` (g, c): the log-probability of its last byte after the
    others. Lower orders count the distinct bytes seen before a shorter n-gram. Every order is joined
    with the sums of its contexts and with the order below."""
    levels = {order: written(counts, "grams")}
    for n in range(order - 1, 0, -1):
        shorter = levels[n + 1].groupBy(F.col("g").bitwiseAND((1 << 8 * n) - 1).alias("g"))
        levels[n] = written(shorter.agg(F.count("*").alias("c")), "grams")
    below = None
    for n in range(1, order + 1):
        rows = discounted(levels[n]).withColumn("context", F.shiftright("g", 8))
        sums = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
        rows = rows.join(sums, "context")
        if below is None:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        else:
            rows = rows.withColumn("rest", F.col("g").bitwiseAND((1 << 8 * (n - 1)) - 1)).join(below, "rest")
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("held") / F.col("total") * F.col("lower")
        below = rows.select(F.col("g").alias("rest"), p.alias("lower"))
    return written(below.select(F.col("rest").alias("g"), F.log("lower").cast("float").alias("log_p")), "model")


def sorted_arrays(table: DataFrame, key: str, value: str, limit: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys in ascending order and their values, if the table has at most ``limit`` entries; else None."""
    if table.count() > limit:
        return None
    got = table.select(key, value).toArrow()
    keys, values = got[key].to_numpy(), got[value].to_numpy()
    by = np.argsort(keys)
    return keys[by], values[by].astype(np.float32)


def looked_up(arrays: tuple[np.ndarray, np.ndarray], keys: np.ndarray, default: float) -> np.ndarray:
    """Value of each key. Keys are put in order first, which keeps the search within the cache."""
    known, values = arrays
    out = np.full(len(keys), default, np.float32)
    if len(known) and len(keys):
        by = np.argsort(keys)
        asked = keys[by]
        at = np.searchsorted(known, asked)
        at[at == len(known)] = 0
        out[by] = np.where(known[at] == asked, values[at], np.float32(default))
    return out


def summed(arrays: tuple[np.ndarray, np.ndarray], g: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's n-grams, unknown ones 0. N-gram and text share one number, so that
    plain sorting brings equal n-grams together and each is looked up once."""
    known, values = arrays
    out = np.zeros(len(offsets) - 1)
    for first in range(0, len(out), 1 << TEXT_BITS):
        at = offsets[first : first + (1 << TEXT_BITS) + 1]
        both = g[at[0] : at[-1]] << TEXT_BITS
        both |= np.repeat(np.arange(len(at) - 1), np.diff(at))
        if not len(both) or not len(known):
            continue
        both.sort()
        own = both >> TEXT_BITS
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        asked = own[heads]
        place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        found = np.where(known[place] == asked, values[place], np.float32(0)).astype(np.float64)
        weights = np.repeat(found, np.diff(np.append(heads, len(both))))
        out[first : first + len(at) - 1] = np.bincount(both & ((1 << TEXT_BITS) - 1), weights, len(at) - 1)
    return out


def per_text(values: np.ndarray, offsets: np.ndarray, how=np.add) -> np.ndarray:
    """Sum (or other reduction) per text; 0 for empty ones."""
    out = np.zeros(len(offsets) - 1)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = how.reduceat(values.astype(np.float64), offsets[full])
    return out
