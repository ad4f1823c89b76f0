"""Token ids in wavelet-matrix files (method 4).

Documents are dealt by ranges of their (whole-number) id; each partition is one shard, and each shard one file in a
shared folder. A file holds the shard's ids (every document followed by an end id) as a wavelet
matrix: one bit-plane per bit of the largest id, from the highest bit down. In each plane the ids
keep their order, zeros of the bit above first. With ranks in the planes this answers from the file
alone: the id at a place, how often an id occurs before a place, and where its k-th occurrence is.

File format (little-endian), the whole body compressed by zstandard:
``WMX1``, uint32 planes, uint64 ids, uint64 documents, uint8 kind of document id (0 none, 1 long);
int64 document ids (a null as the smallest number, marked in the null bits), packed null bits,
uint64 end of every document in ids, uint64 zeros of every plane, packed planes of uint64 words.

Null texts are empty documents (the end id alone). Repeated ids stand side by side, null ids first.
An empty table makes no file. The writer names a file after shard and content and puts it in place
by a rename, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from delaykit.llm.byte_bpe import MARKS, ByteBpe, flat_bytes
from delaykit.llm.common import in_arrow, ragged_take, slices, split_words

LATIN = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
SIMPLE = f"^[{LATIN}]+[{MARKS}]*$"
MAGIC = b"WMX1"
BLOCK = 64
STEP = 20_000
#: Fixed value: the split pattern of this family of tokenizers; letters and other marks never join.
LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WaveletMatrix:
    """Planes of a sequence of ids, with a rank directory per 64-bit word."""

    def __init__(self, planes: np.ndarray, zeros: np.ndarray, size: int):
        self.planes, self.zeros, self.size = planes, zeros, size
        ones = np.bitwise_count(planes).astype(np.int64)
        self.before = np.concatenate([np.zeros((len(planes), 1), np.int64), np.cumsum(ones, axis=1)], axis=1)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes = np.zeros((depth, len(ids) // BLOCK + 1), np.uint64)
        zeros = np.zeros(depth, np.int64)
        kind = np.uint16 if depth <= 16 else np.uint32
        current = ids.astype(kind)
        for level in range(depth):
            bit = (current & kind(1 << (depth - 1 - level))).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            planes[level].view(np.uint8)[: len(packed)] = packed
            current = np.concatenate([current[~bit], current[bit]])
            zeros[level] = len(ids) - int(bit.sum())
        return cls(planes, zeros, len(ids))

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.planes[level][word] & mask)

    def access(self, at) -> np.ndarray:
        """Ids at the given places."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.uint32)
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones(level, at)
            out = out << np.uint32(1) | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return out

    def decode(self) -> np.ndarray:
        """All ids: planes from the lowest up, each undoing one split by its bit."""
        depth = len(self.planes)
        kind = np.uint16 if depth <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for level in range(depth - 1, -1, -1):
            raw = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)
            back = np.empty_like(out)
            back[~raw] = out[: self.zeros[level]]
            back[raw] = out[self.zeros[level] :] | kind(1 << (depth - 1 - level))
            out = back
        return out.astype(np.uint32)

    def rank(self, token: int, at: int) -> int:
        """How often ``token`` stands before place ``at``."""
        depth = len(self.planes)
        if token >> depth or token < 0:
            return 0
        start, stop = np.array([0]), np.array([min(max(at, 0), self.size)])
        for level in range(depth):
            lo, hi = self._ones(level, start), self._ones(level, stop)
            if token >> (depth - 1 - level) & 1:
                start, stop = self.zeros[level] + lo, self.zeros[level] + hi
            else:
                start, stop = start - lo, stop - hi
        return int(stop[0] - start[0])

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of ``token``; -1 where there is none."""
        if k < 0 or k >= self.count(token):
            return -1
        low, high = 0, self.size
        while low < high:  # smallest place with k + 1 occurrences up to and including it
            mid = (low + high) // 2
            low, high = (low, mid) if self.rank(token, mid + 1) > k else (mid + 1, high)
        return low


def pack_shard(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> bytes:
    wm = WaveletMatrix.build(ids)
    nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
    keys = pc.fill_null(doc_ids.cast(pa.int64()), -(2**63)).to_numpy(zero_copy_only=False)
    body = b"".join(
        [
            struct.pack("<IQQB", len(wm.planes), len(ids), len(keys), 1),
            keys.astype("<i8").tobytes(),
            np.packbits(nulls, bitorder="little").tobytes(),
            ends.astype("<u8").tobytes(),
            wm.zeros.astype("<u8").tobytes(),
            wm.planes.astype("<u8").tobytes(),
        ]
    )
    return MAGIC + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_shard(data: bytes) -> tuple[pa.Array, np.ndarray, WaveletMatrix]:
    """(document ids, their ends in ids, the wavelet matrix) of one file."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    body = zstandard.ZstdDecompressor().decompress(data[4:])
    depth, size, docs, _ = struct.unpack_from("<IQQB", body)
    at = struct.calcsize("<IQQB")

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    keys = take("<i8", docs)
    nulls = np.unpackbits(take("u1", (docs + 7) // 8), count=docs, bitorder="little").astype(bool)
    ends, zeros = take("<u8", docs).astype(np.int64), take("<u8", depth).astype(np.int64)
    planes = take("<u8", depth * (size // BLOCK + 1)).reshape(depth, -1)
    return pa.array(keys, mask=nulls), ends, WaveletMatrix(planes, zeros, size)


class WordEncoder:
    """The library's ids of texts, each distinct word of a slice worked on once.

    Right for tokenizers that neither join nor look across ASCII white space, as those that drop it:
    then a text's ids are those of its words in a row. If the file has the split pattern ``LETTERS``
    and lower-cases, a word of Latin letters with stops behind it is further parted into its letters,
    in lower case, and its stops. All such letters are merged in step (see ``byte_bpe``), which gives
    the library's ids; everything else goes through the library.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.parted = json.dumps(LETTERS)[1:-1] in spec and '"Lowercase"' in spec and '"ByteLevel"' in spec
        self.bpe = ByteBpe(path) if self.parted else None

    def _letters(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        ids, at = self.bpe.merge(*flat_bytes(pieces))
        return ids.astype(np.uint32), at

    def _others(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, lengths = [np.zeros(0, np.uint32)], []
        for start in range(0, len(pieces), STEP):  # the library's results are large: a step at a time
            ids = [e.ids for e in self.library.encode_batch_fast(pieces[start : start + STEP], add_special_tokens=False)]
            lengths += map(len, ids)
            parts.append(np.array([i for own in ids for i in own], np.uint32))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets of the texts)"""
        words, offsets = split_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        simple = pc.match_substring_regex(distinct, SIMPLE) if self.parted else pa.array(np.zeros(len(distinct), bool))
        easy = simple.to_numpy(zero_copy_only=False).astype(bool)
        plain = distinct.filter(simple)
        body = pc.utf8_rtrim(plain, MARKS)
        tail = pc.utf8_ltrim(plain, LATIN)
        bodies, tails = pc.utf8_lower(body).dictionary_encode(), tail.dictionary_encode()
        ids, at = self._letters(bodies.dictionary)
        more, to = self._others(tails.dictionary.to_pylist() + distinct.filter(pc.invert(simple)).to_pylist())
        ids, at = np.concatenate([ids, more]), np.concatenate([at, at[-1] + to[1:]])
        # every distinct word as two pieces: letters and stops, or the whole word and nothing
        pair = np.full((len(distinct), 2), len(at) - 1, np.int64)
        pair[easy, 0] = bodies.indices.to_numpy(zero_copy_only=False)
        pair[easy, 1] = len(bodies.dictionary) + tails.indices.to_numpy(zero_copy_only=False)
        pair[~easy, 0] = len(bodies.dictionary) + len(tails.dictionary) + np.arange(int((~easy).sum()))
        flat, ends = ragged_take(ids, np.append(at, at[-1]), pair.ravel())
        flat, ends = ragged_take(flat, ends[::2], coded.indices.to_numpy(zero_copy_only=False))
        return flat, ends[offsets]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker."""
    return WordEncoder(path)


def filesystem(uri: str):
    """Arrow file system and path of a URI or of a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def write_shards(
    df: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, shards: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write one file per shard, documents in ascending id order across shards.

    Returns (shard, file, docs, ids) of the files. The number of shards defaults to the shuffle
    partitions of the session; a shard's ids are held in one task, 4 bytes each.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    # cuts come from the id column alone, so that texts are encoded once and not for a sample as well
    share = [i / shards for i in range(1, shards)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, 100 * shards).alias("c")).first()["c"] if share else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    def encode(batches):
        own = encoder(tokenizer_path)
        for batch in batches:
            ids, at = own.encode(batch.column(1))
            n = np.diff(at)
            # the end id goes in behind every document
            full = np.insert(ids, at[1:], end_id)
            ends = np.concatenate([[0], np.cumsum(n + 1)])
            parts = [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(full.astype("<u4"))]
            body = pa.Array.from_buffers(pa.binary(), len(n), parts)
            key = pc.fill_null(batch.column(0), -(2**63)).to_numpy(zero_copy_only=False)
            shard = pa.array(np.searchsorted(cuts, key, "right"), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), shard, body], ["doc_id", "shard", "ids"])

    encoded = in_arrow(rows, encode, "doc_id long, shard int, ids binary")
    ordered = (
        encoded.repartitionById(len(cuts) + 1, "shard")
        .sortWithinPartitions("doc_id", F.crc32("ids")).select("doc_id", "ids")
    )

    def store(batches):
        from pyspark import TaskContext

        keys, parts, lengths = [], [], []
        for batch in slices(batches):
            keys.append(batch.column(0))
            parts.append(flat_bytes(batch.column(1))[0].view("<u4").astype(np.uint32))
            lengths.append(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False) // 4)
        if not keys:
            return
        ids, ends = np.concatenate(parts), np.cumsum(np.concatenate(lengths).astype(np.int64))
        del parts
        data = pack_shard(pa.concat_arrays(keys), ids, ends)
        shard = TaskContext.get().partitionId()
        fs, base = filesystem(folder)
        name = f"{base}/shard-{shard:06d}-{zlib.crc32(data):08x}.wmx"
        fs.create_dir(base, recursive=True)
        draft = f"{base}/.{os.path.basename(name)}-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(draft) as out:
            out.write(data)
        fs.move(draft, name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([os.path.basename(name)]), pa.array([len(ends)], pa.int64()), pa.array([len(ids)], pa.int64())],
            ["shard", "file", "docs", "ids"],
        )

    return ordered.mapInArrow(store, "shard long, file string, docs long, ids long")


def read_shards(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``index`` is what ``write_shards`` returned: it places the shards behind each other (a running
    sum over one row per shard).
    """
    from pyspark.sql import Window

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = index.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.wmx").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )

    def read(batches):
        for batch in batches:
            for base, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, ends, wm = unpack_shard(content.as_buffer().to_pybytes())
                raw = wm.decode().astype("<u4").tobytes()
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts + base, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    joined = files.join(places.select("file", "base"), "file").select("base", "content")
    return joined.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
