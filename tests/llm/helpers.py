"""Plain, slow versions of the operators, and awkward tables."""

import random
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text and columns whose names the operators use inside themselves
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("row", "fp", "ids", "grp", "label", "starts", "kept", "tie", "doc", "features", "variant", "held_out")]
)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return WORD.findall(text or "")


def documents(spark, rows):
    """rows: (doc_id, text); the other columns are filled with something or null."""
    full = [(i, t, "en" if t and len(t) % 2 else None, "s", None if t is None else len(t)) + ("x", None) * 6 for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward(seed=1):
    """Null ids and texts, empty and blank ones, repeats of rows and ids, a long text, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "日本", "A#b", "end."]
    passage = prose(rng, 40, vocabulary)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c"), (None, None), (4, "a"), (4, "a"), (4, "b c d e"), (5, "a\n\na\na b")]
    rows += [(10 + i, prose(rng, rng.randint(0, 60), vocabulary)) for i in range(20)]
    rows += [(100 + i, prose(rng, 10, vocabulary) + " " + passage + "\n" + prose(rng, 12, vocabulary)) for i in range(6)]
    rows += [(200 + i, "same text all over again " * 12) for i in range(4)]
    rows += [(None, passage), (300, prose(rng, 20_000, vocabulary)), (301, "x" * 50_000)]
    rng.shuffle(rows)
    return rows


def plain_fingerprint(text, n=3):
    words = words_of(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """Smallest node reachable from every node of the pairs."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def plain_repeats(rows, window=20):
    """(kept words, number removed) of each (doc_id, text) row with distinct, non-null ids."""
    seen = defaultdict(list)
    for doc, text in rows:
        words = words_of(text)
        for i in range(len(words) - window + 1):
            seen[tuple(words[i : i + window])].append((doc, i))
    gone = defaultdict(set)
    for places in seen.values():
        first = min(places)
        for doc, i in places:
            if (doc, i) != first:
                gone[doc].update(range(i, i + window))
    out = {}
    for doc, text in rows:
        words = words_of(text)
        out[doc] = ([w for i, w in enumerate(words) if i not in gone[doc]], len(gone[doc]))
    return out


def plain_shingles(text, n=5):
    words = words_of(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
