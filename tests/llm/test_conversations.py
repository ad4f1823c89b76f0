"""Repair of conversations against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from delaykit.llm import conversation_repair

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in ("conv", "h", "place", "draw", "edits")]
)
FORM = re.compile(r"(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) + ("x",) * 5 for r in rows], SCHEMA)


def plain_damage(rows):
    name = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        role, text = name(role), name(text)
        draw = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def cheapest(rows):
    """(cost, audit, initials) of the cheapest edits; rows: (initial, must go, truncated)."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ""))
        else:
            initial, gone, cut = rows[i]
            ways = [(3, "D", state, "")]
            if not gone:
                if (state, initial) in steps:
                    ways.append((cut, "K", initial, initial))
                ways += [(2 + cut, "R", r, r) for r in "ua" if (state, r) in steps]
            for cost, letter, to, put in ways:
                rest = best(i + 1, to, 0)
                found.append((cost + rest[0], letter + rest[1], put + rest[2]))
        if inserted < 3:
            for r in "ua":
                if (state, r) in steps:
                    rest = best(i, r, inserted + 1)
                    found.append((2 + rest[0], "I" + rest[1], r + rest[2]))
        return min(found, default=(10**9, "", ""))

    return best(0, "", 0)


def plain(rows, damage=True):
    every = {r[0] for r in rows}
    name = lambda x: " " if x is None else str(x)
    rows = plain_damage(rows) if damage else [(c, t, name(r), name(x)) for c, t, r, x in rows]
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()[:16])
    out = []
    for conv in every:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for _, t, *_ in own if t is not None]
        initials = [r[2][:1] or " " for r in own]
        cost, audit, put = cheapest(tuple((i, f in ("blank", "duplicate"), int(f == "truncated")) for i, f in zip(initials, faults)))
        assert FORM.fullmatch(put)
        repaired, queue = [], list(own)
        at = 0
        for letter in audit:
            new = {"u": "user", "a": "assistant"}.get(put[at : at + 1])
            if letter == "I":
                repaired.append(new + ":")
            else:
                _, _, role, text = queue.pop(0)
                if letter != "D":
                    repaired.append((role if letter == "K" else new) + ":" + text)
            at += letter != "D"
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def talk(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        texts = ["Yes.", "No", "", " \n", "Why?", "So be it!", "été.", "…", None, f"text {conv}."]
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"]) if rng.random() < 0.5 else ("user", "assistant")[turn % 2]
            rows.append((conv, rng.choice([turn] * 8 + [turn + 3, None]), role, rng.choice([f"t{turn}."] * 5 + texts)))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (None, None, "assistant", "b.")]
    rng.shuffle(rows)
    return rows + rows[:15]


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("rows", [talk(1), talk(2, 3, 90), [(5, 0, None, None)], []])
def test_as_plain(spark, rows, damage):
    got = conversation_repair.judge(frame(spark, rows), damage).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, damage)


def test_one_conversation_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "CHUNK", 7)
    rows = talk(3, 2, 150) + [(0, 9, "user", "same.")] * 40
    got = conversation_repair.judge(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_dropped_to_nothing(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversation_repair.judge(frame(spark, [(conv, 0, "user", "a.")])).collect()
    assert list(map(tuple, got)) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "be kind."), (1, 1, "assistant", "hi."), (1, 2, "user", "bye")]
    got = conversation_repair.repair(frame(spark, rows)).orderBy("place").collect()
    # KIKD, KIKKI and KRR all cost 5
    assert [tuple(r) for r in got] == [(1, 0, "system", "be kind."), (1, 1, "user", ""), (1, 2, "assistant", "hi.")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=23))
def test_blocks_as_search(rows):
    import numpy as np

    own = [(i, g, int(c)) for i, g, c in rows]
    cost, audit, _ = cheapest(tuple(own))
    symbols = np.array([
        conversation_repair.GONE if g else 2 * conversation_repair.INITIALS.find(i) + c if i in "sua" else conversation_repair.OTHER + c for i, g, c in own
    ], np.int64)
    vmap, rise, ends = conversation_repair.chunk_map(symbols)
    assert rise[0] + conversation_repair.tables()[2][vmap[0]][0] == cost
    letters = "".join(conversation_repair.chunk_letters(symbols, 0, 0))
    assert letters + {1: "II", 2: "I"}.get(int(ends[0][0]), "") == audit
