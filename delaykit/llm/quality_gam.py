"""Quality classifier: a generalised additive model with pairwise interactions (method 1).

Features are counts and shares of the text alone. Each is cut into bins at quantiles of the training
rows. Shallow trees are boosted in cycles: one after the other every feature gets a small tree on the
histogram of its bins, added to the feature's lookup table at a low rate, many times round. The pairs
of features whose coarse grid explains most of what is left get tables of their own, by trees with one
cut on each axis. A score is the logistic of the sum of looked-up values.

Fitting takes at most ``MAX_FIT`` labelled rows, a sample by hash of the id where there are more; all
rows are scored. Held-out rows teach nothing. Null text counts as empty. Labels other than 0 and 1
are not used; of several labels of an id the highest counts. Without labels of both classes every
score is the share of label 1 (1 if there are no labels). Rows with repeated or null ids get a row each;
empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import held_out, in_arrow, written
from delaykit.llm.text_stats import Stats, among

MAX_FIT = 100_000
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 150, 60, 0.1, 3

FEATURES = (
    "log_words", "mean_word", "longest_word", "symbol_share", "digit_share", "upper_share", "beyond_share",
    "stop_share", "mark_share", "line_share", "dup_lines", "dup_line_share", "repeat_share", "distinct_share",
)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text, float32."""
    s = Stats(texts)
    words, size = np.maximum(1, s.n_words), np.maximum(1, s.n_bytes)
    lines = s.count(among(b"\n")) + 1
    longest = np.zeros(len(words))
    full = np.flatnonzero(s.n_words)
    if len(full):
        longest[full] = np.maximum.reduceat(s.lengths, s.offsets[full])
    upper = among(bytes(range(65, 91)))
    beyond = np.concatenate([np.zeros(128, np.int64), np.ones(128, np.int64)])
    columns = (
        np.log1p(s.n_words), s.word_chars / words, longest, s.n_symbols / words, s.count(among(b"0123456789")) / size,
        s.count(upper) / size, s.count(beyond) / size, s.count(among(b".,")) / words, s.count(among(b"!?;:-_\"'()@/=+")) / words,
        lines / words, s.n_dup_lines, s.n_dup_lines / lines, s.n_repeat_words / words, s.distinct_words() / words,
    )
    return np.stack(columns, axis=1).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def tree_1d(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Value of every bin under a tree of few leaves, grown by its best cut (g, h: sums per bin)."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            win = gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - gain(cg[-1], ch[-1])
            i = int(np.argmax(win))
            if win[i] > best[0]:
                best = (win[i], k, a + i + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def tree_2d(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a grid under the best tree with one cut on each axis, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    quarters = []
    for c, t in ((cg, tg), (ch, th)):
        q = c[:-1, :-1]
        quarters.append((q, c[:-1, -1:] - q, c[-1:, :-1] - q, t - c[:-1, -1:] - c[-1:, :-1] + q))
    win = sum(gain(a, b) for a, b in zip(*quarters)) - gain(tg, th)
    i, j = np.unravel_index(int(np.argmax(win)), win.shape)
    out = np.zeros_like(g)
    for (rows, cols), a, b in zip(
        ((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))),
        *quarters,
    ):
        out[rows, cols] = a[i, j] / (b[i, j] + 1.0)
    return out, float(win[i, j])


@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> coarse bin

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Logistic of the sum of looked-up values, for rows of features."""
        out = np.full(len(x), self.intercept)
        b = self.bins(x)
        for table, own in zip(self.tables, b):
            out += table[own]
        for i, j, table in self.pairs:
            out += table[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return sigmoid(out)


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    if not len(y) or y.min() == y.max():
        return AdditiveModel(30.0 if not len(y) or y[0] else -30.0)
    share = y.mean()
    model = AdditiveModel(float(np.log(share / (1 - share))))
    for k in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)))
        n = len(model.edges[k]) + 1
        model.tables.append(np.zeros(n))
        model.coarse.append(np.arange(n) * PAIR_BINS // max(n, PAIR_BINS))
    b = model.bins(x)
    f = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for k, own in enumerate(b):
            p = sigmoid(f)
            n = len(model.tables[k])
            step = RATE * tree_1d(np.bincount(own, y - p, n), np.bincount(own, p * (1 - p), n), LEAVES)
            model.tables[k] += step
            f += step[own]
    coarse = [c[own] for c, own in zip(model.coarse, b)]
    cells = PAIR_BINS * PAIR_BINS

    def grid(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = coarse[i] * PAIR_BINS + coarse[j]
        shape = (PAIR_BINS, PAIR_BINS)
        return np.bincount(at, y - p, cells).reshape(shape), np.bincount(at, p * (1 - p), cells).reshape(shape)

    p = sigmoid(f)
    ranked = sorted(((-tree_2d(*grid(i, j, p))[1], i, j) for i in range(len(b)) for j in range(i)))[:PAIRS]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step, _ = tree_2d(*grid(i, j, sigmoid(f)))
            table += RATE * step
            f += RATE * step[coarse[i], coarse[j]]
    return model


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, features array<float>) of every row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            x = features(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "features"])

    return in_arrow(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, features array<float>")


def score(
    df: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
    label_id_col: str = "doc_id", label_col: str = "quality", max_fit: int = MAX_FIT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; texts are read once."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = written(featured(docs), "features")
    known = (
        labels.select(F.col(f"`{label_id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
        .filter(~held_out(F.col("doc_id")))
    )
    taught = written(rows.join(known, "doc_id").select("doc_id", "features", "label"), "taught")
    n = taught.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 40))
    # a margin of a tenth keeps the draw under the bound
    sample = taught.filter(draw < int(0.9 * max_fit / n * (1 << 40))) if n > max_fit else taught
    got = sample.orderBy(draw, "doc_id").select("features", "label").toArrow()
    x = got["features"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if len(got) else np.zeros((0, len(FEATURES)))
    model = df.sparkSession.sparkContext.broadcast(fit(x, got["label"].to_numpy().astype(float) if len(got) else np.zeros(0)))

    def run(batches):
        for batch in batches:
            own = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.value.scores(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = in_arrow(rows, run, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
