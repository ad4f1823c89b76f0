"""Near-duplicates, repeated passages and benchmark items against plain versions."""

import hashlib
import random

import pytest
from helpers import awkward, documents, plain_components, plain_fingerprint, plain_repeats, plain_shingles, prose, words_of
from pyspark.sql import functions as F

from delaykit.llm import common, decontamination, simhash, substrings

VOCABULARY = [f"v{i}" for i in range(40)]


def plain_near(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 2]
    root = plain_components(pairs)
    first = {}
    for (i, _), fp in zip(rows, fps):
        known = [x for x in (first.get(root[fp]), i) if x is not None]
        first[root[fp]] = min(known) if known else None
    return sorted(((i, f"{fp:016x}", first[root[fp]]) for (i, _), fp in zip(rows, fps)), key=str)


def near_copies(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(30, 300), VOCABULARY).split()
        for j in range(rng.randint(1, 4)):
            rows.append((i + n * j, " ".join(words)))
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return rows


@pytest.mark.parametrize("rows", [awkward(), near_copies(1), near_copies(2)])
def test_near_duplicates(spark, rows):
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain_near(rows)


def test_all_links_at_distance_two_are_found(spark):
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for fp in list(fps):
        for _ in range(4):
            fp ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.append(fp)
    fps += [0, 2**64 - 1, 1, 2**63, 2**63 + 1]
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in sorted(set(fps))]
    tied = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in tied)
    got = plain_components([*((a[0], a[0]) for a in signed), *((a, b) for a, b in tied)])
    pairs = [(a[0], b[0]) for a in signed for b in signed if ((a[0] ^ b[0]) & (2**64 - 1)).bit_count() <= 2]
    assert got == plain_components(pairs)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(0, 60)]
    other = [(rng.randint(100, 300), rng.randint(100, 300)) for _ in range(80)]
    hub = [(1000, 1000 + i) for i in range(1, 50)]
    pairs = [(a, b) for a, b in chain + other + hub if a != b]
    rng.shuffle(pairs)
    got = common.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == plain_components(pairs)
    assert len(got) == len({x for p in pairs for x in p})


def with_passages(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n, VOCABULARY) for n in (19, 20, 21, 30, 55, 120)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 40), VOCABULARY)]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 9), VOCABULARY)]
        rows.append((i * 3 % 61, "\n".join(parts)))
    rows += [(100, "a " * 70), (101, "a b " * 40), (102, None), (103, ""), (104, "q " * 19)]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_repeated_passages(spark, seed):
    rows = with_passages(seed)
    want = plain_repeats(rows)
    got = substrings.digest(documents(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, removed = want[r["doc_id"]]
        assert (r["n_removed"], r["n_words"] - r["n_removed"]) == (removed, len(kept))
        assert r["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_passages_settled_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HELD_WINDOWS", 10)
    test_repeated_passages(spark, 9)


def test_passages_of_awkward_rows(spark):
    rows = awkward()
    got = substrings.digest(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    # equal rows are one document: they keep the same words
    assert len({(r["doc_id"], r["n_words"], r["kept_sha256"]) for r in got if r["doc_id"] == 4}) == 2
    later = [r for r in got if r["doc_id"] is None and r["n_words"] == 40]
    assert [r["n_removed"] for r in later] == [40]  # a null id comes after all others


def test_stage_form_keeps_untouched_texts(spark):
    text = "some  spacing\nstays " + " ".join(f"k{i}" for i in range(30))
    rows = [(1, text), (2, text), (3, "short  one")]
    got = {r["doc_id"]: r for r in substrings.without_repeats(documents(spark, rows)).collect()}
    assert got[1]["text"] == text and got[2]["text"] == "" and got[3]["text"] == "short  one"
    assert got[2]["kept"] == "x" and got[2]["fp"] is None  # columns of the input, not of the operator


@pytest.mark.parametrize("seed", range(3))
def test_automata_of_reference_shards(spark, seed):
    rng = random.Random(seed)
    few = ["a", "b", "c", "d"]
    reference = [prose(rng, 60, few) for _ in range(5)]
    rows = [(i, prose(rng, 80, few)) for i in range(20)] + [(50, None), (51, reference[0])]
    got = substrings.stream_reference(documents(spark, rows), [reference[:2], reference[2:]], 6).collect()
    held = {tuple(w[i : i + 6]) for w in map(words_of, reference) for i in range(len(w) - 5)}
    for i, t in rows:
        words = words_of(t)
        gone = {j for k in range(len(words) - 5) if tuple(words[k : k + 6]) in held for j in range(k, k + 6)}
        want = " ".join(w for j, w in enumerate(words) if j not in gone)
        assert [r["kept"] for r in got if r["doc_id"] == i] == [want]


def plain_containment(rows, items):
    out = []
    for i, t in rows:
        own = plain_shingles(t)
        for k, x in items:
            s = plain_shingles(x)
            if s and 5 * len(s & own) >= 4 * len(s):
                out.append((i, k, len(s), len(s & own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [500_000, 40])
def test_containment(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", block)
    rng = random.Random(4)
    items = [(i, prose(rng, n, VOCABULARY)) for i, n in enumerate((1, 3, 4, 5, 6, 9, 10, 14, 15, 24, 30, 59, 59, 200))]
    items += [(20, None), (21, ""), (None, "V1 v2 v3 v4 v5 v6"), (22, "a b c"), (23, items[6][1])]
    rows = awkward()
    for i, (_, text) in enumerate(items):
        words = words_of(text)
        for j in range(8):  # from whole copies to ever more changed ones, in long texts and bare
            changed = list(words)
            for _ in range(j // 2):
                if changed:
                    changed[rng.randrange(len(changed))] = "other"
            before, after = (prose(rng, 3000 * (j % 3), VOCABULARY), prose(rng, 20, VOCABULARY)) if j % 2 else ("", "")
            rows.append((1000 + 10 * i + j, f"{before} {' '.join(changed).upper()} {after}"))
    given = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit("z"))
    got = decontamination.containment(documents(spark, rows), given).collect()
    want = plain_containment(rows, items)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == want and len(want) > 40


def test_empty_tables(spark):
    empty = documents(spark, [])
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert substrings.digest(empty).collect() == []
    assert substrings.without_repeats(empty).columns == empty.columns
    assert decontamination.containment(empty, items).collect() == []
    assert decontamination.containment(documents(spark, awkward()), items.filter("false")).collect() == []
