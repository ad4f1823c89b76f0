import random

import pytest
from pyspark.sql import functions as F

from delaykit.operators import pagerank as pagerank_module
from delaykit.operators import sampling as S
from delaykit.operators.pagerank import pagerank, period_edges


@pytest.fixture(scope="module")
def flights(spark):
    return spark.range(6000).select(
        F.col("id").alias("flight_id"),
        (F.col("id") % 3 + 2019).cast("int").alias("YEAR"),
        (F.col("id") % 10 < F.col("id") % 3 + 1).cast("double").alias("y"),
    ).cache()


HOLD = "YEAR = 2021"


def sizes(df):
    return {(r["YEAR"], r["y"]): r["count"] for r in df.groupBy("YEAR", "y").count().collect()}


def test_downsample_keeps_holdout_and_minority(flights):
    full = sizes(flights)
    out = sizes(S.downsample(flights, "y", ["flight_id"], F.expr(HOLD)))
    for y in (0.0, 1.0):
        assert out[2021, y] == full[2021, y]
    late = full[2019, 1.0] + full[2020, 1.0]
    assert out[2019, 1.0] + out[2020, 1.0] == late
    assert abs(out[2019, 0.0] + out[2020, 0.0] - late) < 0.1 * late


def test_counting_the_holdout_keeps_more(flights):
    fixed = S.downsample(flights, "y", ["flight_id"], F.expr(HOLD)).count()
    loose = S.downsample(flights, "y", ["flight_id"], F.expr(HOLD), count_holdout=True).count()
    assert loose > fixed


def test_downsample_is_the_same_after_repartitioning(flights):
    a = S.downsample(flights, "y", ["flight_id"], F.expr(HOLD))
    b = S.downsample(flights.repartition(9), "y", ["flight_id"], F.expr(HOLD))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_downsample_by_year_balances_each_year(flights):
    out = sizes(S.downsample_by(flights, "y", ["flight_id"], "YEAR", F.expr(HOLD)))
    assert {k[0] for k in out} == {2019, 2020}
    for year in (2019, 2020):
        assert abs(out[year, 0.0] - out[year, 1.0]) < 0.2 * out[year, 1.0]


def test_upsample_keeps_every_row_and_balances(flights):
    out = S.upsample(flights, "y", ["flight_id"], out="copy")
    assert out.filter("copy = 0").count() == flights.count()
    assert out.filter("y = 0 and copy > 0").count() == 0
    n = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert abs(n[0.0] - n[1.0]) < 0.05 * n[0.0]


def test_other_samples(flights):
    assert S.hash_sample(flights, ["flight_id"], 0.0).count() == 0
    assert S.hash_sample(flights, ["flight_id"], 1.0).count() == 6000
    parts = {r["part"]: r["count"] for r in S.hash_split(flights, ["flight_id"], 0.7).groupBy("part").count().collect()}
    assert sum(parts.values()) == 6000 and abs(parts["train"] - 4200) < 150
    assert abs(S.bernoulli(flights, 0.4).count() - 2400) < 250
    assert S.upsample_replace(flights, "y", 0.5).count() > 6000


# -- PageRank ----------------------------------------------------------------


def brute(edges, reset=0.15, tol=0.01):
    """The same change-passing rounds on a list of flights."""
    nodes = sorted({n for e in edges for n in e})
    degree = {n: sum(1 for s, _ in edges if s == n) for n in nodes}
    rank, change = dict.fromkeys(nodes, reset), dict.fromkeys(nodes, reset)
    while any(c > tol for c in change.values()):
        arriving = dict.fromkeys(nodes, 0.0)
        for s, d in edges:
            if change[s] > tol:
                arriving[d] += (1 - reset) * change[s] / degree[s]
        change = arriving
        rank = {n: rank[n] + change[n] for n in nodes}
    total = sum(rank.values())
    return {n: r * len(nodes) / total for n, r in rank.items()}


def _edges(seed, n=200):
    rng = random.Random(seed)
    names = [f"a{i}" for i in range(12)]
    edges = [(rng.choice(names[:8]), rng.choice(names)) for _ in range(n)]
    return edges + [("hub", rng.choice(names)) for _ in range(100)]


@pytest.mark.parametrize("tol", [0.01, 0.001])
def test_pagerank_equals_brute_force_per_period(spark, tol):
    data = {2019: _edges(1), 2020: _edges(2)}
    df = spark.createDataFrame([(y, s, d) for y, es in data.items() for s, d in es], "YEAR int, DEST string, ORIGIN string")
    got = pagerank(period_edges(df, ["YEAR"], "DEST", "ORIGIN"), ["YEAR"], tol=tol).collect()
    for year, edges in data.items():
        expected = brute(edges, tol=tol)
        mine = {r["id"]: r["pagerank"] for r in got if r["YEAR"] == year}
        assert mine.keys() == expected.keys()
        assert all(abs(mine[k] - expected[k]) < 1e-9 for k in expected)
        assert abs(sum(mine.values()) - len(mine)) < 1e-9


def test_parts_of_hubs_do_not_change_ranks(spark, monkeypatch):
    rng = random.Random(4)
    pairs = [(f"a{rng.randint(0, 3)}", f"b{rng.randint(0, 30)}") for _ in range(200)] + [(f"b{i}", f"a{i % 4}") for i in range(31)]
    edges = period_edges(spark.createDataFrame(pairs, "s string, t string"), [], "s", "t")
    whole = {r["id"]: r["pagerank"] for r in pagerank(edges).collect()}
    monkeypatch.setattr(pagerank_module, "HUB_LINKS", 5)
    split = {r["id"]: r["pagerank"] for r in pagerank(edges, link_bytes=-1).collect()}
    assert whole.keys() == split.keys() and all(abs(whole[k] - split[k]) < 1e-9 for k in whole)
    parts = pagerank_module.linked(edges, [], False).groupBy("src").agg(F.max("part").alias("last"), F.max("parts").alias("parts"))
    assert all(r["last"] < r["parts"] for r in parts.collect()) and parts.filter("parts > 1").count() == 4


def test_rounds_carry_the_frontier_only(spark, monkeypatch):
    """A long tail: nearly all vertices stop after a few rounds, and few changes are written from then on."""
    pairs = [("x", "y")] * 3 + [("y", "x")] * 3 + [(f"l{i}", "x") for i in range(200)]
    edges = period_edges(spark.createDataFrame(pairs, "s string, t string"), [], "s", "t")
    written, stage = [], pagerank_module.staged

    def counted(df, name):
        out = stage(df, name)
        if name == "arrivals":
            written.extend(r["count"] for r in out.groupBy("round").count().orderBy("round").collect())
        return out

    monkeypatch.setattr(pagerank_module, "staged", counted)
    pagerank(edges, link_bytes=-1).collect()
    assert len(written) > 10 and max(written[1:]) <= 2


def test_source_vertices_only(spark, rows):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "DEST string, ORIGIN string")
    edges = period_edges(df, [], "DEST", "ORIGIN")
    assert {r["id"] for r in pagerank(edges).collect()} == {"a", "b", "c"}
    only = {r["id"]: r["pagerank"] for r in pagerank(edges, source_vertices_only=True).collect()}
    assert only.keys() == {"a", "b"} and abs(only["a"] - 1) < 1e-9


def test_pagerank_ends_only_when_nothing_moves(spark):
    """Two hubs with many leaves pass changes to each other for longer than a few rounds."""
    import pytest

    from delaykit.operators.pagerank import pagerank

    pairs = [(f"leaf{i}", f"hub{i % 2}", 1) for i in range(400)] + [("hub0", "hub1", 1), ("hub1", "hub0", 1)]
    edges = spark.createDataFrame(pairs, "src string, dst string, n_edges long")
    ranks = pagerank(edges, with_change=True).collect()
    assert max(r["change"] for r in ranks) <= 0.01 and abs(sum(r["pagerank"] for r in ranks) - 402) < 1e-6
    top = {r["id"]: r["pagerank"] for r in ranks}
    assert abs(top["hub0"] - top["hub1"]) < 1e-9 and abs(top["hub0"] - 171) < 0.05  # r = 0.15 + 0.85 * (30 + r)
    with pytest.raises(RuntimeError, match="left after 5 rounds"):
        pagerank(edges, max_rounds=5)


def test_spearman_leaves_nulls_without_a_rank(spark):
    from delaykit.operators.correlation import spearman_matrix
    from delaykit.operators.ranks import average_ranks

    data = [(float(i), float(i) if i % 2 else None, float(-i)) for i in range(20)]
    df = spark.createDataFrame(data, "x double, y double, z double")
    got = sorted((r["x"], r["y"]) for r in average_ranks(df, ["x", "y", "z"]).collect() if r["y"] is not None)
    assert got == [(2.0 * k + 2, float(k + 1)) for k in range(10)]
    corr = {(r["row_name"], r["col_name"]): round(r["corr"], 9) for r in spearman_matrix(df, ["x", "y", "z"]).collect()}
    assert corr["x", "y"] == 1.0 and corr["y", "z"] == -1.0 and corr["x", "z"] == -1.0
