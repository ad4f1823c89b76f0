"""Near copies at five words and 0.8 against all pairs."""

import os
import random
import sys

import numpy as np
import pytest
from helpers import awkward, documents, plain_components, plain_shingles, prose
from pyspark.sql import functions as F

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

import corpus_pipeline  # noqa: E402

from delaykit.llm import near_copies, simhash  # noqa: E402

VOCABULARY = [f"v{i}" for i in range(40)]


def plain_copies(rows, shingle=5, threshold=(4, 5)):
    own = [frozenset(plain_shingles(t, shingle)) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1)
             if len(own[i] & own[j]) * threshold[1] >= len(own[i] | own[j]) * threshold[0]]
    root = plain_components(pairs)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(root[k], []).append(i)
    name = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return sorted(((i, name[root[k]]) for k, (i, _) in enumerate(rows)), key=str)


def edited(seed, groups=12, copies=8, size=(30, 160)):
    """Copies of copies with words changed, around a similarity of 0.8, some behind a shared line."""
    rng = random.Random(seed)
    line = prose(rng, 12, VOCABULARY)
    rows = []
    for g in range(groups):
        words = prose(rng, rng.randint(*size), VOCABULARY).split()
        for c in range(copies):
            rows.append((g + groups * c, (line + "\n") * (g % 2) + " ".join(words)))
            if rng.random() < 0.5:
                words = rows[len(rows) - 1 - rng.randrange(c + 1)][1].split("\n")[-1].split()
            for _ in range(rng.randint(1, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [awkward(), edited(1), edited(2), edited(3, 2, 60, (60, 60)), []])
def test_as_all_pairs(spark, rows):
    got = near_copies.near_copies(documents(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_copies(rows)


@pytest.mark.parametrize("shingle,threshold", [(3, (4, 5)), (5, (1, 2)), (2, (19, 20))])
def test_other_parameters(spark, shingle, threshold):
    rows = edited(4, 6, 6)
    got = near_copies.near_copies(documents(spark, rows), shingle, threshold).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_copies(rows, shingle, threshold)


def test_order_from_a_part_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SAMPLE_BYTES", 1000)
    monkeypatch.setattr(near_copies, "SAMPLE_GRAMS", 50)
    test_as_all_pairs(spark, edited(5))


def templates(n, seed, spread):
    """One 45-word template with four words changed: side by side, or anywhere."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(45)]
    rows = []
    for i in range(n):
        own = list(words)
        for j, at in enumerate(sorted(rng.sample(range(45), 4)) if spread else range(20, 24)):
            own[at] = f"n{i}x{j}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("spread", [False, True])
def test_texts_of_one_template_are_not_paired(spark, monkeypatch, spread):
    pairs = []
    write = near_copies.written

    def counted(df, name):
        out = write(df, name)
        pairs.append(out.count() if name == "pairs" else 0)
        return out

    monkeypatch.setattr(near_copies, "written", counted)
    got = near_copies.near_copies(documents(spark, templates(2000, 1, spread))).filter("doc_id <> component_id").count()
    assert got == 0 and sum(pairs) <= 4000


def test_parities_count_no_more_than_differs():
    rng = random.Random(7)
    for _ in range(20):
        pool = [rng.getrandbits(64) for _ in range(rng.randint(2, 700))]
        a, b = (sorted(rng.sample(pool, rng.randint(1, len(pool)))) for _ in "ab")
        bits, ends = near_copies.parities(np.array(a + b, np.uint64), np.array([0, len(a), len(a) + len(b)]))
        x, y = bits[: ends[1]].view(np.uint64), bits[ends[1] :].view(np.uint64)
        while len(x) != len(y):
            x, y = (x[: len(x) // 2] ^ x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2 :])
        assert sum(int(v).bit_count() for v in x ^ y) <= len(set(a) ^ set(b))


def test_ids_that_are_structs(spark):
    docs = documents(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f")])
    keyed = docs.withColumn("key", F.struct(F.col("doc_id").isNull(), "doc_id", F.monotonically_increasing_id()))
    got = near_copies.near_copies(keyed, id_col="key").collect()
    assert len({r["component_id"] for r in got}) == 1 and sum(r["doc_id"] == r["component_id"] for r in got) == 1


def test_stage_drops_copies_beyond_two_bits(spark):
    words = [f"a{i}" for i in range(60)]
    copy = words[:30] + ["other"] + words[31:]
    rows = [(7, " ".join(words)), (9, " ".join(copy)), (11, " ".join(words[30:] + words[:5]))]
    a, b = [r["fingerprint"] for r in simhash.near_duplicates(documents(spark, rows[:2])).orderBy("doc_id").collect()]
    assert (int(a, 16) ^ int(b, 16)).bit_count() > 2
    kept = corpus_pipeline.keep_one_of_each(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [7, 11]
