"""Quality rules with n-gram perplexity bands (method 10).

Rules on counts come first (``base_failed``). The verdict on the others is the perplexity of the text
under a modified Kneser-Ney model of all documents (byte n-grams, counted and estimated by Spark): a text
whose negative log-probability per lettered word lies outside the band of its language and length is
rejected. A lettered word is a run of ASCII letters, digits and bytes beyond ASCII, so marks between words
cost and do not count. Length classes double from ``SHORT`` bytes on. A band runs from
``q1 - fence * spread`` to ``q3 + fence * spread``, where the spread is ``q3 - q1``, but at least
``LEAST_SPREAD``: many copies of one text must not make a band of one point. Quartiles come from exact
counts in steps of ``STEP``; all texts that pass the rules count. A class with fewer than ``FEW`` such
texts takes the band of its language, wider for shorter texts by the square root of how much shorter
than ``FULL_LENGTH`` they are, since a mean over few words scatters more.

Null text: no words, fails the rules. A null language is a language of its own. Repeated ids: a row
each. Empty table: empty result. Other columns are not looked at. ``perplexity`` is infinite where it is
beyond a double, as for one endless word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import in_arrow, written
from delaykit.llm.symbols import BROADCAST_ENTRIES, GRAM_SLICE, count_grams, grams, kneser_ney, per_text, sorted_arrays, summed
from delaykit.llm.text_stats import Stats
from delaykit.operators.lookup import fits_broadcast

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STEP = 0.01
FENCE = 3.0
LEAST_SPREAD = 0.25
SHORT = 125
FEW = 50
FULL_LENGTH = 2000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LETTERED = np.array([b > 127 or chr(b).isalnum() for b in range(256)])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def lettered_words(s: Stats) -> np.ndarray:
    """Runs of lettered bytes in each text."""
    letter = LETTERED[s.raw]
    start = letter.copy()
    start[1:] &= ~letter[:-1]
    first = s.at[:-1][np.diff(s.at) > 0]
    start[first] = letter[first]
    return per_text(start, s.at)


def language_model(docs: DataFrame) -> DataFrame:
    """(g, log_p) of every n-gram of ``docs``; grows with them."""
    return kneser_ney(count_grams(docs))


def measured(docs: DataFrame, model: DataFrame, limit: int = BROADCAST_ENTRIES) -> DataFrame:
    """(doc_id, lang, the counts, n_bytes, surprise): surprise is the negative log-probability of the text
    per lettered word (all of it if there is none), 0 for an empty text.

    A model of at most ``limit`` entries is broadcast as sorted arrays. Beyond, the distinct n-grams of
    each text, counted, are joined with it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"{c} long" for c in (*COUNTS, "n_bytes", "n_lettered"))
    arrays = sorted_arrays(model, "g", "log_p", limit)
    columns = ["doc_id", "lang", *COUNTS, "n_bytes", "n_lettered"]

    def counts_of(batch):
        s = Stats(batch.column(2))
        rows = [batch.column(0), batch.column(1), *[pa.array(getattr(s, c), pa.int64()) for c in (*COUNTS, "n_bytes")]]
        return [*rows, pa.array(lettered_words(s).astype(np.int64))]

    surprise = -F.col("total") / F.greatest(F.col("n_lettered"), F.lit(1))
    if arrays is not None:
        shared = docs.sparkSession.sparkContext.broadcast(arrays)

        def run(batches):
            for batch in batches:
                g, offsets = grams(batch.column(2))
                total = summed(shared.value, g, offsets)
                yield pa.RecordBatch.from_arrays([*counts_of(batch), pa.array(total)], [*columns, "total"])

        rows = in_arrow(docs.select("doc_id", "lang", "text"), run, f"doc_id {kind}, lang string, {counted}, total double", GRAM_SLICE)
        return rows.withColumn("surprise", surprise).drop("total", "n_lettered")

    numbered = written(docs.select("doc_id", "lang", "text", F.monotonically_increasing_id().alias("place")), "numbered")

    def only_counts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*counts_of(batch), batch.column(3)], [*columns, "place"])

    def taken_apart(batches):
        for batch in batches:
            g, offsets = grams(batch.column(1))
            place = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(len(place)):
                own, n = np.unique(g[offsets[i] : offsets[i + 1]], return_counts=True)
                for at in range(0, len(own), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own[part]), place[i])), pa.array(own[part]), pa.array(n[part])], ["place", "g", "n"]
                    )

    rows = in_arrow(numbered, only_counts, f"doc_id {kind}, lang string, {counted}, place long", GRAM_SLICE)
    parts = in_arrow(numbered.select("place", "text"), taken_apart, "place long, g long, n long", GRAM_SLICE)
    totals = parts.join(model, "g").groupBy("place").agg(F.sum(F.col("n") * F.col("log_p").cast("double")).alias("total"))
    joined = rows.join(totals, "place", "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
    return joined.withColumn("surprise", surprise).drop("total", "n_lettered", "place")


def length_class() -> Column:
    """0 below twice ``SHORT`` bytes, then one more for every doubling."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(F.col("n_bytes"), F.lit(1)) / SHORT))).cast("int")


def bands(rows: DataFrame, fence: float) -> DataFrame:
    """(lang, size, n, low, high, spread): the bounds of each language and length class, and (size null) of
    the whole language; quartiles from counts per step."""
    passed = rows.filter(~F.col("base_failed")).withColumn("step", F.floor(F.col("surprise") / STEP).cast("long"))
    by_class = passed.groupBy("lang", length_class().alias("size"), "step").agg(F.count("*").alias("n"))
    whole = by_class.groupBy("lang", F.lit(None).cast("int").alias("size"), "step").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("lang", "size")
    steps = by_class.unionByName(whole)
    placed = steps.withColumn("upto", F.sum("n").over(own.orderBy("step"))).withColumn("all", F.sum("n").over(own))
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("step"))) * STEP
    quartiles = placed.groupBy("lang", "size").agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.max("all").alias("n"))
    spread = fence * F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_SPREAD))
    return quartiles.select(
        "lang", "size", "n", (F.col("q1") - spread).alias("low"), (F.col("q3") + STEP + spread).alias("high"), spread.alias("spread")
    )


def judge(
    df: DataFrame, fence: float = FENCE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    limit: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, perplexity) of every row."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")) if lang_col in df.columns else F.lit("")
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), lang.alias("lang"), F.col(f"`{text_col}`").alias("text"))
    model = language_model(docs)
    rows = written(measured(docs, model, limit).withColumn("base_failed", base_failed()), "quality")
    limits = written(bands(rows, fence), "bands")
    # a few rows per language; a column that holds something else may have many values
    sized = F.broadcast if fits_broadcast(limits) else (lambda x: x)
    close = limits.filter((F.col("n") >= FEW) & F.col("size").isNotNull()).select(
        "lang", "size", F.col("low").alias("c_low"), F.col("high").alias("c_high")
    )
    wide = limits.filter(F.col("size").isNull()).select("lang", "low", "high", "spread")
    joined = rows.withColumn("size", length_class()).join(sized(close), ["lang", "size"], "left").join(sized(wide), "lang", "left")
    short = F.sqrt(F.greatest(F.lit(1.0), F.lit(FULL_LENGTH) / F.greatest(F.col("n_bytes"), F.lit(1))))
    wider = F.col("spread") * (short - 1)
    low, high = F.coalesce("c_low", F.col("low") - wider), F.coalesce("c_high", F.col("high") + wider)
    inside = F.coalesce(F.col("surprise").between(low, high), F.lit(True))
    return joined.select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"),
        F.exp("surprise").alias("perplexity"),
    )
