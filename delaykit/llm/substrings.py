"""Removal of repeated passages: windows of words that start earlier elsewhere (operator 7).

A window is 20 words in a row of one document; a word goes if a window over it has a twin that starts
earlier (smaller id, or same document and smaller place). Windows are judged on the input.

Passes, all over whole texts:

1. Anchors. Of the 8-word grams inside a window the one with the smallest hash is its anchor. Equal
   windows have equal anchors at equal places, so a window can only repeat if its anchor does. About
   one place in seven is an anchor; anchors are counted, and those met twice set bits in a sieve.
2. Windows. Only windows whose anchor passes the sieve are looked at (a wrong pass costs work, never
   a result). Each task keeps the earliest of equal windows it meets: the others are settled there,
   so a passage that fills a third of all documents reaches the shuffle once per task. The kept ones
   are dealt by 96 bits of window hash, and all but the earliest of each are settled.
3. Settled windows, as spans, meet their documents; covered words are dropped.

``stream_reference`` is the same removal against a given, bounded reference set by suffix automata.

Null and empty texts have no words. Rows with a null id count as later than all others and lose
nothing to each other's order: they are ordered by hash of their text. Repeated ids are told apart
by a hash of the text; equal rows (same id, same text) are treated alike, as one document. Empty
tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.llm.common import MIX, gram_hashes, hash_strings, in_arrow, mix, split_words, written

WINDOW = 20
ANCHOR = 8
SIEVE_MIN, SIEVE_MAX = 24, 29
HELD_WINDOWS = 3_000_000
LATEST = 2**63 - 1


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Best (np.minimum or np.maximum) of each run of ``width`` neighbours."""
    step, out = 1, values
    while step * 2 <= width:
        out = best(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return best(out[: len(out) - rest], out[rest:]) if rest else out


class Windows:
    """Words of a slice and the anchors of all their windows."""

    def __init__(self, texts: pa.Array, window: int):
        self.words, self.offsets = split_words(texts)
        self.hashes = hash_strings(self.words)
        total = len(self.hashes)
        if total < window:
            self.inside = np.zeros(0, bool)
            self.anchor = np.zeros(0, np.uint64)
            self.grams = np.zeros(0, np.uint64)
            return
        self.grams = gram_hashes(self.hashes, ANCHOR)
        self.anchor = sliding(self.grams, window - ANCHOR + 1, np.minimum)
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))
        self.inside = (np.arange(total) + window <= ends)[: len(self.anchor)]

    def anchors(self, window: int) -> np.ndarray:
        """Hash of every place that is the anchor of some window."""
        if not len(self.anchor):
            return self.anchor
        width = window - ANCHOR + 1
        held = np.where(self.inside, self.anchor, np.uint64(0))
        pad = np.zeros(width - 1, np.uint64)
        return self.grams[self.grams == sliding(np.concatenate([pad, held, pad]), width, np.maximum)]


def sieve_of(docs: DataFrame, window: int) -> tuple[np.ndarray, int]:
    """Bits of the anchors that occur at two places or more.

    The size follows the number of such anchors, up to 2**29 bits (64 MB); beyond, more places pass.
    """

    def emit(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(Windows(batch.column(1), window).anchors(window).view(np.int64))], ["h"])

    repeated = in_arrow(docs, emit, "h long").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    repeated = written(repeated, "anchors")
    count = repeated.count()
    bits = min(SIEVE_MAX, max(SIEVE_MIN, (64 * count).bit_length()))
    rows = (
        repeated.select(F.shiftrightunsigned("h", 64 - bits).alias("cell"))
        .select(F.expr("shiftright(cell, 6)").alias("w"), F.expr("shiftleft(1L, CAST(cell & 63 AS INT))").alias("m"))
        .groupBy("w").agg(F.bit_or("m").alias("m"))
    )
    sieve = np.zeros(1 << (bits - 6), np.uint64)
    table = rows.toArrow()
    sieve[table["w"].to_numpy()] = table["m"].to_numpy().view(np.uint64)
    return sieve, bits


def passes(sieve: np.ndarray, bits: int, anchors: np.ndarray) -> np.ndarray:
    cell = (anchors >> np.uint64(64 - bits)).astype(np.int64)
    return (sieve[cell >> 6] >> (cell & 63).astype(np.uint64)) & np.uint64(1) == 1


def earliest(keys: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> np.ndarray:
    """Mask of the rows that come first, in ``order``, among rows of equal ``keys`` (ties: all)."""
    by = np.lexsort([*order[::-1], *keys[::-1]])
    out = np.zeros(len(by), bool)
    if len(by):
        new = np.concatenate([[True], np.zeros(len(by) - 1, bool)])
        for k in keys:
            k = k[by]
            new[1:] |= k[1:] != k[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        out[by] = np.logical_and.reduce([o[by] == o[by][head] for o in order])
    return out


def spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Spans of one document that touch or overlap, joined."""
    by = np.lexsort([start, tie, doc])
    doc, tie, start, stop = doc[by], tie[by], start[by], stop[by]
    if not len(doc):
        return doc, tie, start, stop
    same = (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1])
    # running maximum of the stops inside a document: documents are lifted apart first
    group = np.concatenate([[0], np.cumsum(~same)])
    lift = group * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + lift)
    fresh = np.concatenate([[True], ~same | (start[1:] + lift[1:] > reach[:-1])])
    heads = np.flatnonzero(fresh)
    tails = np.concatenate([heads[1:], [len(doc)]]) - 1
    return doc[heads], tie[heads], start[heads], (reach - lift)[tails]


COLUMNS = {"h1": np.int64, "h2": np.int32, "doc": np.int64, "tie": np.int64, "start": np.int32, "stop": np.int32}


def schema_of(names: list[str]) -> str:
    return "part int, " + ", ".join(f"{n} array<{'long' if COLUMNS[n] is np.int64 else 'int'}>" for n in names)


def packed(key: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows dealt by ``key``: one row of arrays per part that gets any, so that a million windows cross
    the shuffle as a few blocks."""
    part = (key.view(np.uint64) % np.uint64(parts)).astype(np.int32)
    by = np.argsort(part, kind="stable")
    part = part[by]
    heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    offsets = pa.array(np.concatenate([heads, [len(part)]]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v[by].astype(COLUMNS[n], copy=False))) for n, v in columns.items()]
    return pa.RecordBatch.from_arrays([pa.array(part[heads]), *lists], ["part", *columns])


def unpacked(batches, names: list[str]) -> dict[str, np.ndarray] | None:
    """All arrays of a partition, joined; None if it has no rows."""
    got = [[c.flatten().to_numpy(zero_copy_only=False) for c in b.columns[1:]] for b in batches]
    return dict(zip(names, (np.concatenate(x) for x in zip(*got)))) if got else None


WINDOWS, SPANS = ["h1", "h2", "doc", "tie", "start"], ["doc", "tie", "start", "stop"]


def settled_spans(docs: DataFrame, window: int) -> DataFrame:
    """(doc, tie, starts, stops) word spans to remove, one row per document that has any."""
    spark = docs.sparkSession
    sieve, bits = sieve_of(docs, window)
    shared = spark.sparkContext.broadcast(sieve)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def flush(held):
        w = dict(zip(WINDOWS, (np.concatenate(x) for x in zip(*held))))
        first = earliest((w["h1"], w["h2"]), (w["doc"], w["tie"], w["start"]))
        # windows settled here ride along as spans: they have a stop and no part in the comparison
        gone = dict(zip(SPANS, spans(*(w[n][~first] for n in SPANS[:3]), w["start"][~first] + window)))
        none = np.zeros(len(gone["doc"]), np.int64)
        yield packed(mix(gone["doc"].view(np.uint64)), parts, {"h1": none, "h2": none, **gone})
        kept = {n: w[n][first] for n in WINDOWS}
        yield packed(kept["h1"], parts, {**kept, "stop": np.zeros(len(kept["h1"]), np.int32)})

    def look(batches):
        held, size = [], 0
        for batch in batches:
            w = Windows(batch.column(1), window)
            at = np.flatnonzero(w.inside)
            at = at[passes(shared.value, bits, w.anchor[at])]
            if not len(at):
                continue
            row = np.searchsorted(w.offsets, at, "right") - 1
            h1 = np.zeros(len(at), np.uint64)
            h2 = np.zeros(len(at), np.uint64)
            for i in range(window):
                x = w.hashes[at + i]
                h1, h2 = h1 * MIX + x, h2 * np.uint64(0xC2B2AE3D27D4EB4F) + (x ^ (x >> np.uint64(31)))
            doc = pc.fill_null(batch.column(0), LATEST).to_numpy(zero_copy_only=False)
            tie = batch.column(2).to_numpy(zero_copy_only=False)
            held.append((mix(h1).view(np.int64), (mix(h2) >> np.uint64(33)).astype(np.int32), doc[row], tie[row], (at - w.offsets[row]).astype(np.int32)))
            size += len(at)
            if size >= HELD_WINDOWS:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def settle(batches):
        w = unpacked(batches, [*WINDOWS, "stop"])
        if w is None:
            return
        ready = w["stop"] > 0
        old = [w[n][ready] for n in SPANS]
        w = {n: v[~ready] for n, v in w.items()}
        gone = ~earliest((w["h1"], w["h2"]), (w["doc"], w["tie"], w["start"]))
        new = [*(w[n][gone] for n in SPANS[:3]), w["start"][gone] + window]
        out = dict(zip(SPANS, spans(*(np.concatenate(x) for x in zip(old, new)))))
        yield packed(mix(out["doc"].view(np.uint64)), parts, out)

    def gather(batches):
        w = unpacked(batches, SPANS)
        if w is None:
            return
        doc, tie, start, stop = spans(*w.values())
        heads = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])])) if len(doc) else np.zeros(0, np.int64)
        offsets = pa.array(np.concatenate([heads, [len(doc)]]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (start, stop)]
        yield pa.RecordBatch.from_arrays([pa.array(doc[heads]), pa.array(tie[heads]), *lists], ["doc", "tie", "starts", "stops"])

    looked = in_arrow(docs, look, schema_of([*WINDOWS, "stop"])).repartitionById(parts, "part")
    settled = looked.mapInArrow(settle, schema_of(SPANS)).repartitionById(parts, "part")
    return settled.mapInArrow(gather, "doc long, tie long, starts array<int>, stops array<int>")


def cut_rows(df: DataFrame, window: int, id_col: str, text_col: str, columns: list[str], digest: bool) -> DataFrame:
    """Rows with ``columns`` of ``df`` and n_words, n_removed, kept: the words that stay, joined by one
    space, or with ``digest`` the SHA-256 of that text."""
    if window < ANCHOR:
        raise ValueError(f"windows of fewer than {ANCHOR} words have no anchors")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LATEST))
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(text).alias("tie"))
    cuts = settled_spans(docs, window)
    rows = df.select(
        doc.alias("doc"), F.xxhash64(text).alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text_col}`").alias("text"),
    )
    joined = rows.join(cuts, ["doc", "tie"], "left").select("row", "text", "starts", "stops")

    def run(batches):
        for batch in batches:
            words, offsets = split_words(batch.column(1))
            edge = np.zeros(len(words) + 1, np.int64)
            for column, sign in ((batch.column(2), 1), (batch.column(3), -1)):
                n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                base = np.repeat(offsets[:-1], n)
                np.add.at(edge, base + column.flatten().to_numpy(zero_copy_only=False), sign)
            keep = np.cumsum(edge)[:-1] == 0
            left = np.concatenate([[0], np.cumsum(keep)])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep)))
            kept = pc.binary_join(lists, " ")
            if digest:
                kept = pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in kept.cast(pa.binary())], pa.string())
            n_words = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(left), pa.int64()), kept],
                ["row", "n_words", "n_removed", "kept"],
            )

    schema = T.StructType([joined.schema["row"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")], T.StructField("kept", T.StringType())])
    return in_arrow(joined, run, schema)


def without_repeats(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df``; a text that loses words becomes what stays of it, joined by one
    space, and a text that loses none is kept as it is."""
    cut = cut_rows(df, window, id_col, text_col, df.columns, digest=False)
    changed = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row").getField(text_col))
    return cut.select(*[(changed if c == text_col else F.col("row").getField(c)).alias(c) for c in df.columns])


def digest(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    return cut_rows(df, window, id_col, text_col, [id_col], digest=True).select(
        F.col("row").getField(id_col).alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


class SuffixAutomaton:
    """All word runs of a reference shard: at most two states and three moves per word."""

    def __init__(self, texts: list[list[str]]):
        self.moves: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in texts:
            last = 0
            for word in words:
                last = self._extend(last, word)

    def _state(self, length: int, link: int, moves: dict[str, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.moves.append(moves)
        return len(self.link) - 1

    def _extend(self, last: int, word: str) -> int:
        known = self.moves[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        new = -1 if known is not None else self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.moves[at]:
            self.moves[at][word] = new
            at = self.link[at]
        if at < 0:
            return new
        to = self.moves[at][word]
        if self.length[to] != self.length[at] + 1:
            copy = self._state(self.length[at] + 1, self.link[to], dict(self.moves[to]))
            while at >= 0 and self.moves[at].get(word) == to:
                self.moves[at][word] = copy
                at = self.link[at]
            self.link[to] = copy
            to = copy
        if new < 0:
            return to
        self.link[new] = to
        return new

    def matching(self, words: list[str]) -> list[int]:
        """Per word, the length of the longest run ending there that the reference holds."""
        at, length, out = 0, 0, []
        for word in words:
            while at and word not in self.moves[at]:
                at = self.link[at]
                length = self.length[at]
            if word in self.moves[at]:
                at, length = self.moves[at][word], length + 1
            out.append(length)
        return out


def stream_reference(
    df: DataFrame, shards: list[list[str]], threshold: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, kept): texts without the maximal runs of ``threshold`` or more words that one of the
    reference shards holds. Shards are lists of texts held by the driver; each is broadcast as one
    automaton, and every document streams through all of them."""
    context = df.sparkSession.sparkContext
    automata = [
        context.broadcast(SuffixAutomaton([[w for w in pc.ascii_split_whitespace(pa.array([t or ""]))[0].as_py() if w] for t in shard]))
        for shard in shards
    ]
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = [w for w in pc.ascii_split_whitespace(pa.array([text or ""]))[0].as_py() if w]
                edge = np.zeros(len(words) + 1, np.int64)
                for automaton in automata:
                    for i, n in enumerate(automaton.value.matching(words)):
                        if n >= threshold:
                            edge[i + 1 - n] += 1
                            edge[i + 1] -= 1
                keep = np.cumsum(edge)[:-1] == 0
                out.append(" ".join(w for w, k in zip(words, keep) if k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "kept"])

    return in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, kept string")
