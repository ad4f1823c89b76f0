"""Counts, language models, classifiers and URL rules against plain versions and held-out accuracy."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents, plain_counts, prose
from pyspark.sql import functions as F

from delaykit.llm import quality_gam, quality_rules, symbols, toxicity_kn, url_rules
from delaykit.llm.text_stats import Stats

FOLDER = os.environ.get("TEST_TEXT_DIR", "/root/testdata/sf0.1")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def test_counts_as_plain():
    rng = random.Random(2)
    texts = [t for _, t in awkward()] + ["".join(rng.choice(["a", "b ", "\n", "#", "é", " x y", "\t"]) for _ in range(200)) for _ in range(200)]
    texts += ["l1\nl1 \nl1\n \n \nl1", "a b c d e f g h " * 3, "日本 " * 30]
    s = Stats(pa.array(texts, pa.string()))
    got = list(zip(*(getattr(s, c).tolist() for c in quality_rules.COUNTS)))
    assert got == [plain_counts(t) for t in texts]
    assert s.distinct_words().tolist() == [len(set((t or "").split())) for t in texts]


def plain_model(texts, order):
    """Modified Kneser-Ney by dictionaries: a function from tuples of bytes to probabilities, and the runs."""
    runs = [(symbols.PAD,) * (order - 1) + tuple((t or "").encode()) for t in texts]
    count = Counter(run[i - order + 1 : i + 1] for run in runs for i in range(order - 1, len(run)))
    levels = {order: count}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    cut, sums = {}, {}
    for n, c in levels.items():
        of = Counter(c.values())
        cut[n] = symbols.discounts([of[k] for k in (1, 2, 3, 4)])
        sums[n] = defaultdict(lambda: [0, 0.0])
        for g, k in c.items():
            sums[n][g[:-1]][0] += k
            sums[n][g[:-1]][1] += cut[n][min(k, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        n = len(g)
        k, (total, held) = levels[n][g], sums[n][g[:-1]]
        return (k - cut[n][min(k, 3) - 1]) / total + held / total * p(g[1:])

    return p, runs


def test_model_as_plain(spark):
    texts = ["the cat sat.", "the cat, the hat", None, "", "a1 b2 été", "the the the"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r["g"]: r["log_p"] for r in symbols.kneser_ney(symbols.count_grams(docs, 3), 3).collect()}
    p, runs = plain_model(texts, 3)
    want = {}
    for text, run in zip(texts, runs):
        g, _ = symbols.grams(pa.array([text], pa.string()), 3)
        want |= {int(k): math.log(p(run[i : i + 3])) for i, k in enumerate(g)}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], abs=1e-5) for g in want)


def test_sums_per_text(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [None, "", "abc" * 50, "é" * 3, "\U0010ffff" * 4, ""]
    texts += ["".join(chr(c) for c in rng.integers(32, 400, rng.integers(0, 80))) for _ in range(200)]
    g, offsets = symbols.grams(pa.array(texts, pa.string()))
    known = np.unique(g)[::2]
    values = rng.random(len(known)).astype(np.float32)
    table = dict(zip(known.tolist(), values.tolist()))
    want = [sum(table.get(k, 0.0) for k in g[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
    assert symbols.summed((known, values), g, offsets) == pytest.approx(want)
    assert not symbols.summed((known[:0], values[:0]), g, offsets).any()
    monkeypatch.setattr(symbols, "TEXT_BITS", 3)  # more texts than the bits name
    assert symbols.summed((known, values), g, offsets) == pytest.approx(want)


def test_counting_in_bounded_memory(spark, monkeypatch):
    rng = random.Random(7)
    texts = [prose(rng, 80, ["ab", "cd", "été", "x-y"]) for _ in range(40)]
    docs = spark.createDataFrame([(t, i % 3) for i, t in enumerate(texts)], "text string, grp int")
    whole = [sorted(map(tuple, f(docs).collect())) for f in (symbols.count_grams, toxicity_kn.count_words)]
    for module in (symbols, toxicity_kn):
        monkeypatch.setattr(module, "HELD_GRAMS", 3)
    assert whole == [sorted(map(tuple, f(docs).collect())) for f in (symbols.count_grams, toxicity_kn.count_words)]
    assert sum(c for _, c in whole[0]) == sum(len(t.encode()) for t in texts)


def junk_and_prose(seed):
    rng = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "lantern", "walking", "quietly", "garden", "winter", "harbour", "bright"]
    rows = [(i, prose(rng, rng.randint(30, 120), words) + ".") for i in range(200)]
    rows += [(500 + i, "".join(rng.choice("#$%&*|zqxj ") for _ in range(400))) for i in range(5)]
    return rows


def test_rules_and_bands(spark):
    rows = junk_and_prose(1) + awkward()
    got = quality_rules.judge(documents(spark, rows).withColumn("lang", F.lit("en"))).collect()
    assert len(got) == len(rows)
    counts = sorted(((i, *plain_counts(t)) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], *(r[c] for c in quality_rules.COUNTS)) for r in got), key=str) == counts
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] is not None and 500 <= r["doc_id"] < 505:
            assert not r["kept"]
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert sum(i in kept for i in range(30, 100)) >= 65


def plain_verdicts(rows, fence=quality_rules.FENCE):
    """{(doc_id, text): kept} by dictionaries; rows: (doc_id, text, lang)"""
    q = quality_rules
    p, runs = plain_model([t for _, t, _ in rows], symbols.ORDER)
    logs = {}
    judged = []
    for (i, text, lang), run in zip(rows, runs):
        n, repeated = plain_counts(text)[0], plain_counts(text)[4]
        total = 0.0
        for at in range(symbols.ORDER - 1, len(run)):
            g = run[at - symbols.ORDER + 1 : at + 1]
            if g not in logs:
                logs[g] = math.log(p(g))
            total -= logs[g]
        size = len((text or "").encode())
        lettered = len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or ""))
        klass = max(0, math.floor(math.log2(max(size, 1) / q.SHORT)))
        judged.append((i, text, lang or "", klass, size, total / max(1, lettered), n < 20 or 100 * repeated > 30 * n))

    def band(chosen):
        steps = sorted(math.floor(x / q.STEP) for x in chosen)
        q1, q3 = (steps[math.ceil(len(steps) * share) - 1] * q.STEP for share in (0.25, 0.75))
        spread = fence * max(q3 - q1, q.LEAST_SPREAD)
        return q1 - spread, q3 + q.STEP + spread, spread

    out = []
    for i, text, lang, klass, size, x, bad in judged:
        own = [r[5] for r in judged if r[2] == lang and r[3] == klass and not r[6]]
        all_ = [r[5] for r in judged if r[2] == lang and not r[6]]
        if bad:
            out.append((i, text, False))
            continue
        if len(own) >= q.FEW:
            low, high, _ = band(own)
        else:
            low, high, spread = band(all_)
            wider = spread * (math.sqrt(max(1, q.FULL_LENGTH / max(size, 1))) - 1)
            low, high = low - wider, high + wider
        out.append((i, text, low <= x <= high))
    return out


@pytest.mark.parametrize("limit", [0, quality_rules.BROADCAST_ENTRIES])
def test_verdicts_as_plain(spark, limit):
    rng = random.Random(11)
    words = ["the", "of", "river", "stone", "lantern", "quietly", "été", "winter", "harbour", "bright", "mill", "ago"]
    rows = [(i, prose(rng, rng.randint(22, 200), words) + ".", rng.choice(["en", "en", "en", "fr"])) for i in range(260)]
    rows += [(900 + i, " ".join(f"{w}{rng.choice(['###', '&&&'])}" for w in rng.choices(words, k=60)), "en") for i in range(8)]
    rows += [(950 + i, " | ".join("".join(rng.choices("qzxjkv", k=9)) for _ in range(40)), "en") for i in range(4)]
    rows += [(i, t, None) for i, t in awkward() if len(t or "") < 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    text_of = docs.select(F.struct("doc_id", "text").alias("doc_id"), "text", "lang")
    got = [(r["doc_id"]["doc_id"], r["doc_id"]["text"], r["kept"]) for r in quality_rules.judge(text_of, limit=limit).collect()]
    assert sorted(got, key=str) == sorted(plain_verdicts(rows), key=str)
    kept = {i for i, _, k in got if k}
    assert not kept & set(range(900, 960)) and len(kept & set(range(260))) >= 255


def plain_toxicity(rows, label_of):
    """{doc_id: highest ratio of a word} by dictionaries; rows: (doc_id, text)"""
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    flat = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    counts = [Counter(), Counter(), Counter()]
    for i, text in rows:
        for w in set(flat(text)):
            counts[2][w] += 1
            if fold(i) > toxicity_kn.CALIBRATION and i in label_of:
                counts[label_of[i]][w] += 1
    of = Counter(counts[2].values())
    cut = symbols.discounts([of[k] for k in (1, 2, 3, 4)])
    total = sum(counts[2].values())
    held = sum(cut[min(k, 3) - 1] for k in counts[2].values()) / total
    shared = {w: (k - cut[min(k, 3) - 1]) / total + held / len(counts[2]) for w, k in counts[2].items()}

    def log_p(w, c):
        n, d = sum(counts[c].values()), toxicity_kn.DISCOUNT
        back = sum(min(k, d) for k in counts[c].values()) / n
        return math.log((counts[c][w] - min(counts[c][w], d)) / n + back * shared[w])

    return {i: max((log_p(w, 1) - log_p(w, 0) for w in flat(text)), default=0.0) for i, text in rows}


@pytest.mark.parametrize("limit", [0, toxicity_kn.BROADCAST_ENTRIES])
def test_toxicity_as_plain(spark, limit):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(150)] + ["Été", "A-b", "x,y"]
    rows, label_of = [], {}
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, prose(rng, 30, words) + (" Vile, word" if bad else " end.")))
        if i % 3:
            label_of[i] = int(bad)
    rows += [(1000, None), (1001, ""), (1002, "#!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(label_of.items()), "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity_kn.score(docs, labels, limit=limit).collect()}
    want = plain_toxicity(rows, label_of)
    assert got.keys() == want.keys()
    assert all(got[i]["log_ratio"] == pytest.approx(want[i], abs=1e-4) for i in want)
    assert all(got[i]["predicted"] == (i < 400 and i % 4 == 0) for i in got)
    ranked = sorted(got.values(), key=lambda r: r["log_ratio"])
    assert all(a["score"] <= b["score"] for a, b in zip(ranked, ranked[1:]))


def test_stretches_as_plain(spark):
    rng = random.Random(17)
    docs = [(i, prose(rng, rng.randint(0, 12), ["a", "b", "c", "d"])) for i in range(60)]
    ratio_of = {"a": 1.0, "b": -2.0, "c": 0.5}
    keys = {w: int(toxicity_kn.plain_words(pa.array([w]))[0][0]) for w in ratio_of}
    table = spark.createDataFrame([(keys[w], r) for w, r in ratio_of.items()], "h long, ratio float")
    model = toxicity_kn.ToxicityModel(table, -0.25)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    for stretch in (1, 3):
        for limit in (0, 100):
            got = {r["doc_id"]: r["value"] for r in toxicity_kn.text_values(rows, model, limit, stretch).collect()}
            for i, text in docs:
                x = [ratio_of.get(w, -0.25) for w in text.split()]
                runs = [x[j : j + stretch] for j in range(len(x) - stretch + 1)] or ([x] if x else [])
                assert got[i] == pytest.approx(max((sum(r) / len(r) for r in runs), default=0.0))


@pytest.mark.parametrize("limit", [0, toxicity_kn.BROADCAST_ENTRIES])
def test_query_weighs_stretches_by_their_length(spark, tmp_path, monkeypatch, limit):
    """The query's value of a text is the highest mean of three words in a row: bad words side by side tell
    more than one alone, whatever the length of the text."""
    from delaykit.llm import catalogue

    rng, plain = random.Random(19), [f"w{i}" for i in range(100)]
    rows = [(i, prose(rng, rng.randint(5, 60), plain) + (" vile foul nasty" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, "w1 w2 w3 vile foul nasty w4"), (1001, "w1 w2 vile w3 w4 w5"), (1002, "vile"), (1003, "vile w1"), (1004, "")]
    label_of = {i: int(i % 4 == 0) for i, _ in rows[:400] if i % 3}
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(label_of.items()), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    keep = toxicity_kn.score
    monkeypatch.setattr(toxicity_kn, "score", lambda *a, **k: keep(*a, **k, limit=limit))
    got = {r["doc_id"]: r["log_ratio"] for r in catalogue.op2_toxicity_kn(spark, str(tmp_path)).collect()}
    ratio_of = plain_toxicity(rows, label_of)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity_kn.fit(docs, spark.createDataFrame(list(label_of.items()), "doc_id long, label int"))
    word = {r["h"]: r["ratio"] for r in model.ratios.collect()}
    for i, text in rows:
        x = [word.get(h, model.default) for h in toxicity_kn.plain_words(pa.array([text]))[0].tolist()]
        runs = [x[j : j + 3] for j in range(len(x) - 2)] or ([x] if x else [])
        assert got[i] == pytest.approx(max((sum(r) / len(r) for r in runs), default=0.0), abs=1e-4)
    assert got[1000] > got[1003] > got[1001] and got[1000] < ratio_of[1000]


def test_trees_find_the_best_cut():
    g, h = np.array([1.0, 1, 1, -4, -4, 2]), np.ones(6)
    assert len(set(quality_gam.tree_1d(g, h, 3))) == 3
    table, win = quality_gam.tree_2d(np.array([[5.0, -5], [-5, 5]]), np.ones((2, 2)))
    assert win > 0 and table[0, 0] == table[1, 1] == -table[0, 1]


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 14)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    fresh = rng.random((2000, 14)).astype(np.float32)
    want = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert ((model.scores(fresh) > 0.5) == want).mean() > 0.9
    assert any({i, j} == {0, 1} for i, j, _ in model.pairs)


def ranking(score, label):
    """Area under the curve by ranks (ties: mean rank)."""
    score, label = np.asarray(score), np.asarray(label)
    ranks = np.array([((score < s).sum() + (score <= s).sum() + 1) / 2 for s in score])
    n1 = label.sum()
    return (ranks[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@needs_tables
@pytest.mark.parametrize(("operator", "label", "least"), [(quality_gam, "quality", 0.97), (toxicity_kn, "toxic", 0.88)])
def test_held_out_accuracy(spark, operator, label, least):
    # about one in sixteen toxic labels of this table marks a text without any such word
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    scored = operator.score(docs, labels)
    assert scored.count() == docs.count()
    held = scored.filter("held_out").join(labels, "doc_id").select("score", "predicted", label).toPandas()
    assert ranking(held["score"], held[label]) > least
    assert (held["predicted"] == held[label]).mean() > 0.93


@pytest.mark.parametrize("operator", [quality_gam, toxicity_kn])
def test_classifiers_on_awkward_rows(spark, operator):
    docs = documents(spark, awkward())
    schema = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(i, i % 2, i % 2, "q") for i in range(300)] + [(None, 1, 1, ""), (5, None, None, ""), (6, 7, 7, ""), (10, 1, 1, "")], schema)
    for taught in (labels, labels.filter("false")):
        got = operator.score(docs, taught).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in got)
    assert operator.score(documents(spark, []), labels).collect() == []


@pytest.mark.parametrize("operator", [quality_gam, toxicity_kn])
def test_held_out_labels_teach_nothing(spark, operator):
    rng = random.Random(3)
    docs = documents(spark, [(i, prose(rng, 40, ["bad", "x", "y"] if i % 3 == 0 else ["good", "y", "z"])) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 3 and 1, 1 - (i % 3 and 1)) for i in range(200)], "doc_id long, quality int, toxic int")
    turned = labels.withColumns({c: F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    one, two = (sorted((r["doc_id"], r["score"]) for r in operator.score(docs, x).collect()) for x in (labels, turned))
    assert np.allclose([s for _, s in one], [s for _, s in two])


def plain_verdict(url, rules, default="allow"):
    url = url or ""
    if "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fit = [(len(h), len(p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[3] if fit else None, max(fit)[4] if fit else default


def test_url_rules_as_plain(spark):
    rng = random.Random(1)
    hosts = ["example.com", "WWW.example.com", "a.www.example.com", "example.net", "net", "com", "x.org", "notexample.com", "", "example.com.", "é.net"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/fr/a?b=/en/", "/es/#x", "?q", "#f", "/EN/", "/en/?://x", "/es/\n/y"]
    urls = [rng.choice(["http://", "https://", "", "x://y://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(600)]
    urls += [None, "", "://", "http:/example.com/en/", "a\nb://example.com/en/", urls[0], urls[0]]
    pages = spark.createDataFrame([(i % 590, u, "h", "z") for i, u in enumerate(urls)], "page_id long, url string, host string, best string")
    for rules in (url_rules.RULES, (("block", "example.com", "/e"), ("allow", "example.com", "/en/1"), ("block", "net", ""), ("allow", "net", ""))):
        got = sorted((tuple(r) for r in url_rules.judge(pages, rules).collect()), key=str)
        assert got == sorted(((i % 590, *plain_verdict(u, rules)) for i, u in enumerate(urls)), key=str)


def test_url_rules_refuse_and_take_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages).collect() == []
    with pytest.raises(ValueError, match="unknown verdicts"):
        url_rules.judge(pages, [("maybe", "a", "/")])
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r["verdict"] for r in url_rules.judge(one, [], default="block").collect()] == ["block"]
