"""Byte-level BPE: vocabulary, cutting texts into pieces, rank-synchronous merging of ragged arrays.

Pieces: a text is cut before each single space that stands between two characters that are not white
space. The pre-tokenizer cannot see past such a place, so equal pieces have equal tokens wherever
they occur, and each distinct piece of a batch is worked on once. A text with a longer run of white
space, or with white space beyond ASCII, is one piece as a whole. Strings of added tokens inside a
piece split it, as the library does.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import pre_tokenizers

from delaykit.llm.common import owners, ragged_take

#: Fixed value: the split pattern of this family of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class the libraries may differ: white space that a regex engine may not count
#: as such, and everything beyond the Latin blocks.
UNUSUAL = regex.compile(r"[\x1c-\x1f\x85\xa0]|[^\x00-ɏ]")
#: One run of Latin letters and one of common marks: cut without the general pattern.
SIMPLE, MARKS = r"^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*$", ".,;:!?"
NONE = np.int32(2**31 - 1)


def byte_characters() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 ones stand for themselves, the others
    follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all strings in a row, their offsets); no nulls."""
    at = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class ByteBpe:
    """Vocabulary and merges of a tokenizers file; ``path`` must be readable where it is made."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        chars = byte_characters()
        back = {c: b for b, c in chars.items()}
        top = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * top
        suffix = model.get("end_of_word_suffix") or ""
        for text, i in vocab.items():
            tokens[i] = bytes(back[c] for c in text.removesuffix(suffix))
        for text, i in self.special.items():
            tokens[i] = text.encode()
        self.tokens = tokens
        # codes 0 to 255: a byte; 256 to 511: a byte at the end of its run
        self.start = np.array([vocab[chars[b] + end] for end in ("", suffix) for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], np.int32)
        key = a << 32 | b
        order = np.argsort(key, kind="stable")
        self.keys, self.rank, self.made = key[order], order.astype(np.int32), made
        rank_of = {int(m): r for r, m in enumerate(made)}
        late = max((max(rank_of.get(int(x), -1), rank_of.get(int(y), -1)) - r for r, (x, y) in enumerate(zip(a, b))), default=-1)
        if late >= 0 or len(rank_of) != len(made):
            raise ValueError("a merge uses a token that a later merge makes")
        pair = np.arange(512 * 512)
        self.start_ranks = self.pair_ranks(self.start[pair >> 9], self.start[pair & 511]).astype(np.int32)
        self.split = regex.compile(PATTERN)
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.back = back
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    # -- pieces ---------------------------------------------------------------------------------

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct pieces, code of each piece in order, offsets of the texts)."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        odd = pc.match_substring_regex(texts, r"(^|\s)\s|\s$|[\x1c-\x1f]|\x{85}|\x{a0}|\x{1680}|[\x{2000}-\x{200a}]|\x{2028}|\x{2029}|\x{202f}|\x{205f}|\x{3000}|\x{180e}|\x{feff}")
        odd = odd.to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        counts = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        flat = split.flatten()
        lead = np.ones(len(flat), bool)
        lead[offsets[:-1]] = False
        flat = pc.if_else(pa.array(lead), pc.binary_join_element_wise("", flat, " "), flat)
        if odd.any():
            own = np.zeros(len(flat), np.int64)
            own[offsets[:-1][odd]] = 1 + np.arange(int(odd.sum()))
            whole = pa.concat_arrays([pa.array([None], pa.string()), texts.filter(pa.array(odd))])
            flat = pc.coalesce(whole.take(pa.array(own)), flat)
        coded = flat.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets

    def pretokens(self, piece: str) -> list[bytes | int]:
        """Byte runs that are merged on their own; an int is the id of an added token."""
        if self.special_re is None or not self.special_re.search(piece):
            return self._runs(piece)
        out: list[bytes | int] = []
        at = 0
        for m in self.special_re.finditer(piece):
            out += self._runs(piece[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._runs(piece[at:])

    def _runs(self, text: str) -> list[bytes]:
        if not text:
            return []
        if not UNUSUAL.search(text):
            return [x.encode() for x in self.split.findall(text)]
        return [bytes(map(self.back.__getitem__, x)) for x, _ in self.library.pre_tokenize_str(text)]

    # -- merging --------------------------------------------------------------------------------

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each byte run: (flat ids, offsets).

        All runs are merged in step. One round finds the lowest rank of every run and joins that
        pair wherever it stands in the run (of overlapping places every second one); a run without
        a known pair leaves the working set. A merge is learned after the merges that make its
        parts, so joining all places at once gives what joining them one by one gives.
        """
        count = len(offsets) - 1
        codes = data.astype(np.int32)
        codes[offsets[1:][np.diff(offsets) > 0] - 1] += 256
        symbols = self.start[codes]
        run = owners(offsets)
        done_ids, done_runs = [], []
        ranks = np.full(len(symbols), NONE, np.int32)
        ranks[:-1] = np.where(codes[:-1] < 256, self.start_ranks[codes[:-1] << 9 | codes[1:]], NONE)
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            lowest = np.minimum.reduceat(ranks, heads)
            low = np.repeat(lowest, np.diff(np.concatenate([heads, [len(run)]])))
            closed = low == NONE
            if closed.any():
                done_ids.append(symbols[closed])
                done_runs.append(run[closed])
                symbols, run, ranks, low = (x[~closed] for x in (symbols, run, ranks, low))
                if not len(symbols):
                    break
            hit = np.flatnonzero(ranks == low)
            # places that touch (a pair of equal symbols in a row): keep the 1st, 3rd, ... of each chain
            fresh = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            if not fresh.all():
                chain = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - chain) % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            touch = np.zeros(len(symbols), bool)
            touch[hit] = True
            symbols, run, ranks, touch = symbols[keep], run[keep], ranks[keep], touch[keep]
            touch[:-1] |= touch[1:]
            ranks[touch] = NONE
            near = np.flatnonzero(touch[:-1] & (run[:-1] == run[1:]))
            ranks[near] = self.pair_ranks(symbols[near], symbols[near + 1])
        ids = np.concatenate([*done_ids, np.zeros(0, np.int32)])
        owner = np.concatenate([*done_runs, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]).astype(np.int64)
        return ids[order], ends

    # -- pieces to ids --------------------------------------------------------------------------

    def encode_pieces(self, pieces: pa.Array, cut=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece: (flat ids, offsets).

        ``cut`` maps (bytes, run offsets) to further offsets at which tokens certainly part.
        """
        simple = pc.match_substring_regex(pieces, SIMPLE)
        easy = simple.to_numpy(zero_copy_only=False).astype(bool)
        plain = pieces.filter(simple)
        size = pc.binary_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
        body = pc.binary_length(pc.utf8_rtrim(plain, MARKS)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        runs_of = np.zeros(len(pieces), np.int64)
        runs_of[easy] = 1 + (body < size)
        border = np.zeros(int(starts[-1]) + 1, bool)
        border[starts] = border[starts[:-1] + body] = True
        edges = np.flatnonzero(border)
        rows = np.flatnonzero(~easy)
        hard, specials = [], []
        for row, piece in zip(rows, pieces.take(pa.array(rows)).to_pylist()):
            before = len(hard)
            for run in self.pretokens(piece):
                if isinstance(run, int):
                    specials.append((len(hard), run))
                    run = b""
                hard.append(run)
            runs_of[row] = len(hard) - before
        data = np.concatenate([flat_bytes(plain)[0], np.frombuffer(b"".join(hard), np.uint8)])
        ends = np.cumsum(np.fromiter(map(len, hard), np.int64, len(hard)))
        n_plain = len(edges) - 1
        offsets = np.concatenate([edges, edges[-1] + ends]).astype(np.int64)
        # runs stand in the order (simple pieces, hard pieces); rows of pieces point into it
        first_run = np.zeros(len(pieces), np.int64)
        for chosen, base in ((easy, 0), (~easy, n_plain)):
            counts = runs_of[chosen]
            first_run[chosen] = base + np.cumsum(counts) - counts
        fine = cut(data, offsets) if cut else offsets
        fragments = pa.Array.from_buffers(
            pa.binary(), len(fine) - 1, [None, pa.py_buffer(fine.astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct = fragments.dictionary
        ids, ends = self.merge(*flat_bytes(distinct))
        flat, ends = ragged_take(ids, ends, fragments.indices.to_numpy(zero_copy_only=False))
        run_ends = ends[np.searchsorted(fine, offsets, "right") - 1] if cut else ends
        if specials:  # an added token stands as an empty run: its id goes in at that place
            where = n_plain + np.array([p for p, _ in specials])
            flat = np.insert(flat, run_ends[where], [i for _, i in specials])
            extra = np.zeros(len(run_ends), np.int64)
            extra[where + 1] = 1
            run_ends = run_ends + np.cumsum(extra)
        order = np.repeat(first_run - np.concatenate([[0], np.cumsum(runs_of)[:-1]]), runs_of) + np.arange(int(runs_of.sum()))
        out, at = ragged_take(flat, run_ends, order)
        return out, at[np.concatenate([[0], np.cumsum(runs_of)])]
