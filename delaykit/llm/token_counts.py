"""Token counts by rank-synchronous array merging (method 3).

``token_counts`` adds nothing to the input's columns: it returns the id, bytes, tokens and the
over-limit mark of every row. Null text: 0 bytes, 0 tokens. Null or repeated ids: a row each.
An empty table gives an empty result. Texts are worked on in slices of a few MB; a longer text is a
slice of its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.byte_bpe import ByteBpe
from delaykit.llm.common import in_arrow


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    """One vocabulary per Python worker."""
    return ByteBpe(path)


def count_texts(bpe: ByteBpe, texts: pa.Array) -> np.ndarray:
    """Tokens of each text: distinct pieces are merged in step, then counted where they occur."""
    pieces, codes, offsets = bpe.pieces(texts)
    _, at = bpe.encode_pieces(pieces)
    total = np.concatenate([[0], np.cumsum(np.diff(at)[codes])])
    return total[offsets[1:]] - total[offsets[:-1]]


def token_counts(
    df: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    def count(batches):
        bpe = vocabulary(vocabulary_path)
        for batch in batches:
            texts = batch.column(1)
            n = count_texts(bpe, texts)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n, pa.int64()), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
