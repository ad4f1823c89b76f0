"""Counts over whole texts that quality operators look at, worked out for a slice of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from delaykit.llm.common import gram_hashes, gram_starts, hash_strings, mix, owners, split_words

REPEAT_WINDOW = 8
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
APART = np.uint64(0xA24BAED4963EE407)


def byte_counts(raw: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many bytes of each text are among ``wanted`` (256 booleans)."""
    total = np.concatenate([[0], np.cumsum(wanted[raw])])
    return total[offsets[1:]] - total[offsets[:-1]]


def among(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(chars)] = 1
    return table


def repeats(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur twice or more."""
    by = np.argsort(keys, kind="stable")
    same = keys[by][1:] == keys[by][:-1]
    out = np.zeros(len(keys), bool)
    out[by] = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(keys) else False
    return out


def repeated_words(hashes: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Words per text that lie in a window found twice or more in the text, first one included."""
    n = len(offsets) - 1
    at = gram_starts(offsets, window)
    if not len(at):
        return np.zeros(n, np.int64)
    owner = owners(offsets)
    keys = mix(gram_hashes(hashes, window)[at] + (owner[at].astype(np.uint64) + np.uint64(1)) * APART)
    hit = at[repeats(keys)]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
    return covered[offsets[1:]] - covered[offsets[:-1]]


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines per text that hold a word and equal an earlier line of the text."""
    lists = pc.split_pattern(texts, "\n")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(counts)), counts)
    real = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False).astype(bool)
    coded = flat.dictionary_encode()
    keys = owner[real] * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)[real]
    keys.sort()
    later = keys[1:] == keys[:-1]
    return np.bincount(keys[1:][later] // (len(coded.dictionary) + 1), minlength=len(counts)).astype(np.int64)


class Stats:
    """Counts of a slice; arrays with one value per text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        self.words, self.offsets = split_words(texts)
        self.hashes = hash_strings(self.words)
        self.n_words = np.diff(self.offsets)
        chars = np.concatenate([[0], np.cumsum(pc.utf8_length(self.words).to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.lengths = np.diff(chars)
        self.word_chars = chars[self.offsets[1:]] - chars[self.offsets[:-1]]
        self.n_bytes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.n_bytes)])
        self.raw = np.frombuffer(b"".join(x.as_buffer() for x in texts.cast(pa.binary())), np.uint8)
        self.n_symbols = self.count(among(SYMBOLS))
        self.n_dup_lines = duplicate_lines(texts)
        self.n_repeat_words = repeated_words(self.hashes, self.offsets, REPEAT_WINDOW)

    def count(self, wanted: np.ndarray) -> np.ndarray:
        return byte_counts(self.raw, self.at, wanted)

    def distinct_words(self) -> np.ndarray:
        owner = owners(self.offsets)
        by = np.lexsort([self.hashes, owner])
        fresh = np.ones(len(by), bool)
        fresh[1:] = (self.hashes[by][1:] != self.hashes[by][:-1]) | (owner[by][1:] != owner[by][:-1])
        return np.bincount(owner[by][fresh], minlength=len(self.n_words)).astype(np.int64)
