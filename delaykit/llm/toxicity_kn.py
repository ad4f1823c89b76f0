"""Toxicity by class-conditional Kneser-Ney models (method 2).

Two models of words, one of texts labelled toxic and one of the ordinary ones. A word's count in its class
is the number of the class's documents that hold it, so one text that repeats a word is one witness. The
counts are discounted by ``DISCOUNT`` and smoothed by a lower order that both classes share: the number of
documents of all kinds that hold the word (its continuation count; the contexts are documents), with
modified discounts against a uniform floor. A word with at most ``DISCOUNT`` documents in each class falls
back on the same count in both and says next to nothing. Smaller discounts, as counts of counts suggest
them, let chance words of a few texts speak. Counts are made by Spark and grow with the documents.

The log-likelihood ratio is normalised by length: its mean over stretches of ``stretch`` words, every
one of a text is looked at, and the highest is the text's value (a few words in a long text count as much
as in a short one). A shorter text is one stretch of its own length. ``op2`` takes ``STRETCH`` words; by
itself :func:`score` takes single words. A logistic curve turns values
into scores. It is fitted on labelled texts that the models have not seen, by
counts of values in steps.

A word is a run of ASCII letters and digits in lower case and of bytes beyond ASCII. A text without words
(null, empty) has the value 0. Labels other than 0 and 1 and null labels are not used; of several labels
of an id the highest counts. Without labelled texts of both classes every score is 0. Rows with repeated
or null ids get a row each; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import hash_strings, held_out, in_arrow, split_words, written
from delaykit.llm.symbols import BROADCAST_ENTRIES, HELD_GRAMS, discounted, looked_up, merged, sorted_arrays
from delaykit.operators.lookup import fits_broadcast

STRETCH = 3
DISCOUNT = 4
STEP = 0.02
CALIBRATION = 1  # remainder of the crc32 whose labelled texts fit the curve
FLAT = np.array([ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b > 127 else 32 for b in range(256)], np.uint8)


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of the texts)"""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    raw = FLAT[np.frombuffer(b"".join(x.as_buffer() for x in texts), np.uint8)]
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(raw))
    words, offsets = split_words(flat)
    return hash_strings(words).view(np.int64), offsets


def count_words(texts: DataFrame) -> DataFrame:
    """(h, c0, c1, docs) of ``texts`` (text, grp): how many texts of group 0, of group 1 and of any group
    hold each word. A task passes its sums on at ``HELD_GRAMS`` words."""

    def batch_of(k, c):
        return pa.RecordBatch.from_arrays([pa.array(k), *[pa.array(c[:, i]) for i in range(3)]], ["h", "c0", "c1", "docs"])

    def run(batches):
        keys, counts = [], []
        for batch in batches:
            h, offsets = plain_words(batch.column(0))
            if not len(h):
                continue
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            grp = batch.column(1).to_numpy(zero_copy_only=False)[owner]
            by = np.lexsort([owner, h])
            h, owner, grp = h[by], owner[by], grp[by]
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
            row = np.stack([fresh & (grp == 0), fresh & (grp == 1), fresh], axis=1).astype(np.int64)
            k, c = merged([*keys, h], [*counts, row])
            keys, counts = [k], [c]
            if len(k) > HELD_GRAMS:
                yield batch_of(k, c)
                keys, counts = [], []
        if keys:
            yield batch_of(keys[0], counts[0])

    counted = in_arrow(texts.select("text", "grp"), run, "h long, c0 long, c1 long, docs long")
    return counted.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "docs")])


@dataclass
class ToxicityModel:
    ratios: DataFrame | None  # (h, ratio) of the words that stand in labelled texts
    default: float  # ratio of all other words
    slope: float = 0.0
    offset: float = -50.0


def word_ratios(counts: DataFrame) -> tuple[DataFrame | None, float]:
    """((h, ratio) of every word of a labelled text, ratio of all others) from ``count_words``; the ratio is
    log p(word | toxic) - log p(word | ordinary). (None, 0) unless both classes have words."""
    rows = discounted(counts, "docs").withColumnRenamed("d", "d_docs")
    rows = rows.withColumns({f"d_{c}": F.least(F.col(c), F.lit(DISCOUNT)).cast("double") for c in ("c0", "c1")})
    sums = rows.agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "docs", "d_c0", "d_c1", "d_docs")], F.count("*").alias("words")).first()
    if not sums["c0"] or not sums["c1"]:
        return None, 0.0
    held = {c: sums[f"d_{c}"] / sums[c] for c in ("c0", "c1", "docs")}
    shared = (F.col("docs") - F.col("d_docs")) / sums["docs"] + held["docs"] / sums["words"]
    log_p = [F.log((F.col(c) - F.col(f"d_{c}")) / sums[c] + held[c] * shared) for c in ("c0", "c1")]
    table = rows.filter((F.col("c0") > 0) | (F.col("c1") > 0)).select("h", (log_p[1] - log_p[0]).cast("float").alias("ratio"))
    return written(table, "word-ratios"), float(np.log(held["c1"] / held["c0"]))


def highest(ratios: np.ndarray, offsets: np.ndarray, stretch: int = 1) -> np.ndarray:
    """Highest mean of any ``stretch`` neighbours of each text; of all of them if they are fewer; 0 without any."""
    lengths = np.diff(offsets)
    total = np.concatenate([[0.0], np.cumsum(ratios, dtype=np.float64)])
    out = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(1, lengths)
    full = np.flatnonzero(lengths > stretch)
    if len(full):
        means = np.append((total[stretch:] - total[:-stretch]) / stretch, -np.inf)
        # places inside texts only: from each start to the last full stretch
        edges = np.stack([offsets[:-1][full], offsets[1:][full] - stretch + 1], axis=1).ravel()
        out[full] = np.maximum.reduceat(means, edges)[::2]
    return out


def text_values(docs: DataFrame, model: ToxicityModel, limit: int = BROADCAST_ENTRIES, stretch: int = 1) -> DataFrame:
    """``docs`` (text and other columns) with ``value`` for the text.

    Ratios of at most ``limit`` words are broadcast as sorted arrays. Beyond, the words of the texts are
    joined with them, each word once for every stretch that it lies in.
    """
    others = [c for c in docs.columns if c != "text"]
    arrays = sorted_arrays(model.ratios, "h", "ratio", limit)
    default = model.default
    if arrays is not None:
        shared = docs.sparkSession.sparkContext.broadcast(arrays)

        def run(batches):
            for batch in batches:
                h, offsets = plain_words(batch.column(0))
                value = highest(looked_up(shared.value, h, default), offsets, stretch)
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(value)], [*others, "value"])

        kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
        return in_arrow(docs.select("text", *others), run, f"{kinds}, value double")

    numbered = written(docs.withColumn("place", F.monotonically_increasing_id()), "numbered")

    def taken_apart(batches):
        for batch in batches:
            h, offsets = plain_words(batch.column(0))
            place = batch.column(1).to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            last = np.repeat(np.maximum(0, lengths - stretch), lengths)
            inside = np.arange(len(h)) - np.repeat(offsets[:-1], lengths)
            for back in range(stretch):
                start = inside - back
                ok = (start >= 0) & (start <= last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(place, lengths)[ok]), pa.array(start[ok]), pa.array(h[ok])], ["place", "start", "h"]
                )

    words = in_arrow(numbered.select("text", "place"), taken_apart, "place long, start long, h long")
    means = (
        words.join(model.ratios, "h", "left").groupBy("place", "start")
        .agg(F.avg(F.coalesce(F.col("ratio").cast("double"), F.lit(default))).alias("mean"))
    )
    best = means.groupBy("place").agg(F.max("mean").alias("value"))
    joined = numbered.select("place", *others).join(best, "place", "left")
    return joined.select(*others, F.coalesce("value", F.lit(0.0)).alias("value"))


def fit_curve(values: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from counts per value."""
    if not ordinary.sum() or not toxic.sum():
        return 0.0, -50.0
    every = ordinary.sum() + toxic.sum()
    w0, w1 = ordinary / every, toxic / every
    beta = np.zeros(2)
    x = np.stack([values, np.ones(len(values))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (w1 * (1 - p) - w0 * p) - np.array([1e-4, 0]) * beta
        curvature = (x * ((w0 + w1) * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(curvature, gradient)
        beta += step * min(1.0, 20 / np.abs(step).max()) if np.abs(step).max() else 0
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_ENTRIES, stretch: int = 1) -> ToxicityModel:
    """``docs`` (doc_id, text), ``labels`` (doc_id, label); held-out rows teach nothing."""
    known = labels.filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = written(known, "labels")
    known = F.broadcast(known) if fits_broadcast(known) else known
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    # group 0 and 1: the classes; group 2: all others, which only feed the shared counts
    grp = F.when((fold > CALIBRATION) & F.col("label").isNotNull(), F.col("label")).otherwise(2)
    marked = docs.join(known, "doc_id", "left").withColumn("grp", grp.cast("int")).select("text", "grp")
    model = ToxicityModel(*word_ratios(written(count_words(marked), "words")))
    if model.ratios is None:
        return model
    checked = docs.filter(fold == CALIBRATION).join(known, "doc_id").select("text", "label")
    # a ratio is bounded by the model's floor, so are the steps
    counts = (
        text_values(checked, model, limit, stretch).groupBy(F.floor(F.col("value") / STEP).alias("step"))
        .agg(F.sum(1 - F.col("label")).alias("ordinary"), F.sum("label").alias("toxic")).toPandas()
    )
    model.slope, model.offset = fit_curve(
        (counts["step"].to_numpy(float) + 0.5) * STEP, counts["ordinary"].to_numpy(float), counts["toxic"].to_numpy(float)
    )
    return model


def score(
    df: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    label_id_col: str = "doc_id", label_col: str = "toxic", limit: int = BROADCAST_ENTRIES, stretch: int = 1,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, log_ratio) of every row; ``log_ratio`` is the highest mean of ``stretch`` words."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = labels.select(F.col(f"`{label_id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    model = fit(docs, known, limit, stretch)
    if model.ratios is None:
        values = docs.select("doc_id", F.lit(0.0).alias("value"))
    else:
        values = text_values(docs, model, limit, stretch)
    line = F.least(F.lit(50.0), F.greatest(F.lit(-50.0), model.slope * F.col("value") + model.offset))
    scored = values.withColumn("score", 1 / (1 + F.exp(-line)))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("value").alias("log_ratio"),
    )
