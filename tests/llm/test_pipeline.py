"""The pipeline against plain versions of its stages, and the SQL of this package."""

import hashlib
import os
import sys

import numpy as np
import pytest
from helpers import awkward, documents, plain_repeats, plain_shingles
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_near_copies import plain_copies
from tokenizers import Tokenizer

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import corpus_pipeline  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from delaykit.llm import quality_rules  # noqa: E402
from delaykit.llm.catalogue import BYTE_BPE, QUERIES, SQL  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@needs_tables
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    problem, rows, _ = compare(spark, duck(FOLDER), FOLDER, QUERIES[name], SQL[name])
    assert problem is None and rows, problem


@needs_tables
def test_pipeline_as_plain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [plain_shingles(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    assert 0.5 * docs.count() < len(rows) < docs.count()
    near = dict(plain_copies(rows))
    rows = [(i, t) for i, t in rows if near[i] == i]
    cut = plain_repeats(rows)
    rows = [(i, " ".join(cut[i][0]) if cut[i][1] else t) for i, t in rows]
    clean = []
    for i, t in rows:
        own = plain_shingles(t)
        if not any(s and 5 * len(s & own) >= 4 * len(s) for s in items):
            clean.append((i, t))
    assert len(clean) < len(rows)
    library = Tokenizer.from_file(BYTE_BPE)
    want = []
    for i, t in clean:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(want)


@needs_tables
def test_stages_on_awkward_and_empty_rows(spark):
    for rows in (awkward(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "token_ids":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= docs.count()
            docs = out


def plain_stages(rows):
    """Rows (doc_id, text) left by the stages that drop rows by their texts."""
    items = [plain_shingles(r[0]) for r in ITEMS]
    component = [c for _, c in plain_copies([((i is None, i or 0, n), t) for n, (i, t) in enumerate(rows)])]
    order = sorted(range(len(rows)), key=lambda n: str((rows[n][0] is None, rows[n][0] or 0, n)))
    near = [rows[n] for n, c in zip(order, component) if c == (rows[n][0] is None, rows[n][0] or 0, n)]
    held = lambda t: any(s and 5 * len(s & plain_shingles(t)) >= 4 * len(s) for s in items)
    return {"near_duplicates": near, "benchmark_items": [r for r in rows if not held(r[1])]}


ITEMS = [("w1 w2 w3 w4 w5 w6 w7",), ("same text all over again same text all",), (None,), ("",)]


def test_stages_decide_row_by_row(spark, tmp_path):
    spark.createDataFrame([(n, t) for n, (t,) in enumerate(ITEMS)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = awkward() + awkward()[:12] + [(None, "x w1 w2 w3 w4 w5 w6 w7 y")] * 2
    want = plain_stages(rows)
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        if name in want:
            got = stage(spark, docs, str(tmp_path))
            left = [tuple(r) for r in got.select("doc_id", "text").collect()]
            assert sorted(left, key=str) == sorted(want[name], key=str)


def test_groups_by_fingerprint_are_checked(spark, tmp_path, monkeypatch):
    """The stage hands the links of op6 to the check; a wrong one joins nothing, a right one is kept."""
    texts = [" ".join(f"{k}{n}" for n in range(60)) for k in "abc"]
    texts += [texts[0] + " end", texts[1].upper(), None, ""]
    docs = documents(spark, list(enumerate(texts)))
    called, compared = [], []
    real, pairs = corpus_pipeline.simhash.near_duplicates, corpus_pipeline.near_copies.plausible

    def guessing(df, **options):
        called.append(real(df, **options).count())
        return real(df, **options).withColumn("component_id", F.first("doc_id").over(Window.partitionBy(F.lit(1)).orderBy("doc_id")))

    def looked_at(found, *rest):
        compared.append(found.count())
        return pairs(found, *rest)

    monkeypatch.setattr(corpus_pipeline.simhash, "near_duplicates", guessing)
    monkeypatch.setattr(corpus_pipeline.near_copies, "plausible", looked_at)
    left = corpus_pipeline.keep_one_of_each(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 5]
    # all texts guessed to be one: each of the four other sets stands beside the first
    assert called == [len(texts)] and compared[0] == 4


def test_shingles_are_made_of_small_slices(spark, monkeypatch):
    from delaykit.llm import common

    seen = []
    for module in (corpus_pipeline.simhash, corpus_pipeline.near_copies):
        real = module.in_arrow
        monkeypatch.setattr(module, "in_arrow", lambda df, fn, schema, size=common.SLICE_BYTES, real=real: seen.append(size) or real(df, fn, schema, size))
        monkeypatch.setattr(module, "SHINGLE_SLICE", 40)
    docs = documents(spark, awkward())
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert seen and set(seen) == {40}
    monkeypatch.undo()
    key = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert key(kept) == key(corpus_pipeline.keep_one_of_each(spark, docs, ""))
