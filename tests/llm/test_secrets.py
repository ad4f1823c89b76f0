"""Secret scan against regular expressions and windows counted anew, and against SQL."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import duckdb
import pytest
from helpers import awkward, documents

from delaykit.llm import secret_scan
from delaykit.llm.catalogue import SQL

KEY = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KINDS = ["assign", "access", "hex", "entropy"]


def plain_base(text):
    spans = [("assign", m.start(), m.end()) for m in KEY.finditer(text) if len(m.group(1)) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    return spans + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]


def limit_of(s):
    lower, upper, digits = (sum(c in x for c in s) for x in (string.ascii_lowercase, string.ascii_uppercase, string.digits))
    if digits and (lower or upper) and not (lower and upper) and all(c in string.hexdigits for c in s):
        return 3.0
    if lower and upper and digits:
        return 3.7
    if digits >= 4 and (lower or upper) and not (lower and upper):
        return 3.4
    return None


def plain_added(text, window=20):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{%d,}" % window, text):
        if any(re.search(a, m.group()) for a in secret_scan.ALLOWED):
            continue
        covered = set()
        for i in range(len(m.group()) - window + 1):
            s = m.group()[i : i + window]
            entropy = -sum(n / window * math.log2(n / window) for n in Counter(s).values())
            if limit_of(s) is not None and entropy >= limit_of(s) - 1e-6:
                covered.update(range(i, i + window))
        for i in sorted(covered):
            if out and out[-1][2] == m.start() + i and i - 1 in covered:
                out[-1][2] += 1
            else:
                out.append(["entropy", m.start() + i, m.start() + i + 1])
    return [tuple(x) for x in out]


def plain(doc, text):
    text = text or ""
    base = plain_base(text)
    added = [s for s in plain_added(text) if not any(b[1] <= s[1] and s[2] <= b[2] for b in base)]
    spell = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    n = Counter(k for k, *_ in base)
    return doc, n["assign"], n["access"], n["hex"], hashlib.sha256(spell(base).encode()).hexdigest(), spell(base + added)


def noisy(seed=3):
    """Secrets of all kinds, near misses, allowed runs, letters beyond ASCII, runs that change their class."""
    rng = random.Random(seed)
    of = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    mixed, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    parts = [
        lambda: "password = " + of(rng.randint(3, 12), mixed), lambda: "Api_Key:'" + of(8, mixed) + "'", lambda: "APIKEY=\"" + of(7, mixed),
        lambda: "token=token:abcdefgh", lambda: "secret==" + of(6, mixed), lambda: "tokens: abcdefg", lambda: "passwd  :  " + of(6, "x/+.=_-"),
        lambda: "AKIA" + of(rng.randint(10, 24), string.ascii_uppercase + string.digits), lambda: "AKIAAKIA" + of(15, "AKI9"),
        lambda: of(rng.randint(18, 60), hexes), lambda: of(30, hexes.upper()), lambda: of(rng.randint(19, 70), mixed + "+/_=-"),
        lambda: "https://host/" + of(24, string.ascii_lowercase), lambda: of(25, string.digits), lambda: "-" * 30, lambda: "a" * 40 + of(30, mixed) + "b" * 50 + of(25, mixed),
        lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "example" + of(30, mixed), lambda: of(30, string.ascii_lowercase + string.digits), lambda: "été日本", lambda: "plain words here.", lambda: "\U0001f600",
    ]
    return [(i, rng.choice([" ", "", "\n", "é"]).join(rng.choice(parts)() for _ in range(rng.randint(0, 9)))) for i in range(120)]


def many(seed=4):
    """More matches in one text than one level of sums holds, and one very long run."""
    rng = random.Random(seed)
    run = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    return [(1, " ".join(f"token={run(8)} {run(22)}" for _ in range(700))), (2, run(4000)), (3, "é" * 1000 + run(30))]


@pytest.mark.parametrize("rows", [noisy(), awkward(), many(), []])
def test_as_plain(spark, rows):
    got = secret_scan.judge(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain(*r) for r in rows), key=str)


def test_finds_and_leaves(spark):
    rows = [(1, "x q9Zr4tKp0LmW7vYc2Ns8Bd t"), (2, "see 123e4567-e89b-12d3-a456-426614174000"), (3, "incomprehensibilities/anthropomorphically"), (4, "PASSWORD: hunter22")]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.judge(documents(spark, rows)).collect()}
    assert got == {1: "entropy:2:24", 2: "", 3: "", 4: "assign:0:18"}


def test_no_python_and_no_shuffle(spark):
    plan = secret_scan.judge(documents(spark, noisy()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan


@pytest.mark.parametrize("rows", [noisy(5), awkward()])
def test_sql(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(SQL["op11_secret_scan"]).fetchall()
    got = secret_scan.judge(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
