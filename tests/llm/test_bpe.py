"""Token counts, codec and shards against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from delaykit.llm import bpe_codec, token_counts, token_shards
from delaykit.llm.bpe_codec import Codec
from delaykit.llm.catalogue import BYTE_BPE, WORD_BPE
from delaykit.llm.common import written

SPECIAL = "<|endoftext|>"
PARTS = [" ", "  ", "\n", "\t", "\u00a0", "\x1c", "a", "the", "THE", "é", "日", "😀", "12", "'s", "!", "$$$", SPECIAL, "<|", "\u0301", "."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def codec():
    return Codec(BYTE_BPE)


def check(codec, library, texts):
    ids, at = codec.encode(pa.array(texts, pa.string()))
    n = token_counts.count_texts(codec.bpe, pa.array(texts, pa.string()))
    for i, e in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, texts[i]
        assert n[i] == len(e.ids)
    assert codec.decode(ids, at) == [t or "" for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=20).map("".join)), max_size=6))
def test_any_text_as_the_library(codec, library, texts):
    check(codec, library, texts)


def test_mixed_runs(codec, library):
    rng = random.Random(3)
    check(codec, library, ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)])


def test_forced_cuts_never_split_a_token(codec):
    for token in codec.bpe.tokens[:50_000:7]:
        data = np.frombuffer(token, np.uint8)
        assert codec.fragments(data, np.array([0, len(data)])).tolist() == [0, len(data)]


def test_invalid_bytes_become_replacements(codec):
    ids = codec.bpe.start[np.frombuffer(b"a\xe9b\xf0\x9f", np.uint8)].astype(np.int64)
    assert codec.decode(ids, np.array([0, len(ids)])) == [b"a\xe9b\xf0\x9f".decode("utf-8", "replace")]


def test_counts_of_awkward_rows(spark, library):
    rows = awkward()
    got = token_counts.token_counts(documents(spark, rows), BYTE_BPE).collect()
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_round_trip_of_awkward_rows(spark, library):
    rows = awkward(2)
    got = bpe_codec.round_trip(documents(spark, rows), BYTE_BPE).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_encode_then_decode(spark):
    docs = documents(spark, [(1, "some text, twice"), (2, None), (3, "été 日本")])
    back = bpe_codec.decode(bpe_codec.encode(docs, BYTE_BPE), BYTE_BPE)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: "some text, twice", 2: "", 3: "été 日本"}


def test_empty_tables(spark, tmp_path):
    empty = documents(spark, [])
    assert token_counts.token_counts(empty, BYTE_BPE).collect() == []
    assert bpe_codec.round_trip(empty, BYTE_BPE).collect() == []
    folder = str(tmp_path / "none")
    index = written(token_shards.write_shards(empty, folder, WORD_BPE), "index")
    assert index.count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=200))
def test_wavelet_matrix(ids):
    ids = np.array(ids, np.uint32)
    wm = token_shards.WaveletMatrix.build(ids)
    assert wm.decode().tolist() == ids.tolist()
    if len(ids):
        assert wm.access(np.arange(len(ids))).tolist() == ids.tolist()
    for token in (0, 1, 5, 70, 71, 500):
        at = np.flatnonzero(ids == token)
        assert wm.count(token) == len(at)
        assert [wm.select(token, k) for k in range(len(at) + 1)] == [*at.tolist(), -1]
        assert wm.rank(token, len(ids) // 2) == int((at < len(ids) // 2).sum())


def test_shards_hold_all_ids_in_order(spark, tmp_path):
    rows = awkward(5)
    folder = str(tmp_path / "shards")
    index = written(token_shards.write_shards(documents(spark, rows), folder, WORD_BPE, shards=5), "index")
    got = token_shards.read_shards(spark, folder, index).collect()
    word = Tokenizer.from_file(WORD_BPE)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(word.encode(t or "", add_special_tokens=False).ids + [1])
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        match = [x for x in ids[r["doc_id"]] if len(x) == r["n_tokens"] and zlib.crc32(np.array(x, "<u4").tobytes()) == r["ids_crc32"]]
        assert match
        ids[r["doc_id"]].remove(match[0])
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    known = [i for i in order if i is not None]
    assert known == sorted(known) and order[: len(order) - len(known)] == [None] * (len(order) - len(known))


def test_counting_from_files(spark, tmp_path):
    folder = str(tmp_path / "shards")
    docs = documents(spark, [(i, "one two one") for i in range(10)])
    written(token_shards.write_shards(docs, folder, WORD_BPE, shards=2), "index")
    one = Tokenizer.from_file(WORD_BPE).encode("one", add_special_tokens=False).ids
    assert len(one) == 1
    files = spark.read.format("binaryFile").load(folder).select("content").collect()
    total = sum(token_shards.unpack_shard(bytes(r["content"]))[2].count(one[0]) for r in files)
    assert total == 20


def test_ids_differ_only_by_text(spark):
    docs = documents(spark, [(1, "x"), (1, "x"), (1, "y")])
    got = bpe_codec.round_trip(docs, BYTE_BPE).groupBy("ids_sha256").agg(F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in got) == [1, 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(st.sampled_from([*PARTS, "Über", "naïve.", "ÀÉ!!", "ß", "ª", "İ", "Σ,"]), max_size=12).map("".join)), max_size=5))
def test_word_encoder_as_the_library(texts):
    own = token_shards.encoder(WORD_BPE)
    ids, at = own.encode(pa.array(texts, pa.string()))
    for i, e in enumerate(own.library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, texts[i]
    assert own.parted
