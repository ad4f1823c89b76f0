"""BPE encoding and decoding with forced boundaries (method 5).

Two neighbouring bytes that never stand side by side inside any token can only be parted, so every
such place cuts the text for certain. The fragments between cuts are encoded on their own, each
distinct one once per slice, and their ids are joined.

Null text counts as empty. Null or repeated ids: a row each. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.byte_bpe import ByteBpe
from delaykit.llm.common import in_arrow, ragged_take


class Codec:
    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        inside = np.zeros((256, 256), bool)
        for token in self.bpe.tokens:
            b = np.frombuffer(token, np.uint8)
            inside[b[:-1], b[1:]] = True
        self.inside = inside
        lengths = np.array([len(t) for t in self.bpe.tokens], np.int64)
        self.token_bytes = np.frombuffer(b"".join(self.bpe.tokens), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum(lengths)])

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Run offsets, with every place added at which two bytes meet that no token holds together.

        Offsets that repeat (empty runs) stay as they are.
        """
        if not len(data):
            return offsets
        forced = np.concatenate([[False], ~self.inside[data[:-1], data[1:]], [False]])
        forced[offsets] = False
        return np.sort(np.concatenate([offsets, np.flatnonzero(forced)]), kind="stable")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets of the texts)"""
        pieces, codes, offsets = self.bpe.pieces(texts)
        ids, at = self.bpe.encode_pieces(pieces, self.fragments)
        flat, ends = ragged_take(ids, at, codes)
        return flat, ends[offsets]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the id runs; bytes that are no UTF-8 become U+FFFD."""
        raw, at = ragged_take(self.token_bytes, self.token_at, ids)
        data, ends = raw.tobytes(), at[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per Python worker."""
    return Codec(path)


def encode(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def run(batches):
        c = codec(vocabulary_path)
        for batch in batches:
            ids, at = c.encode(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, run, f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give the empty text."""

    def run(batches):
        c = codec(vocabulary_path)
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            texts = c.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, run, f"doc_id {kind}, text string")


def round_trip(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Ids are hashed as little-endian unsigned 32-bit integers, decoded texts as UTF-8.
    """

    def run(batches):
        c = codec(vocabulary_path)
        for batch in batches:
            ids, at = c.encode(batch.column(1))
            texts = c.decode(ids, at)
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
