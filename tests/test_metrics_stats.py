import random

import pytest
from pyspark.sql import functions as F

from delaykit.operators import correlation as C
from delaykit.operators import metrics as M
from delaykit.operators.ranks import running_totals


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    data = []
    for i in range(800):
        y = float(rng.random() < 0.3)
        score = rng.choice([round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2), 0.5])
        data.append((i, y, score, rng.choice(["a", "b"])))
    return spark.createDataFrame(data, "id int, y double, s double, k string").cache()


def counts(data, t, strict=True):
    hit = lambda s: s > t if strict else s >= t
    tp = sum(1 for _, y, s, _ in data if y == 1 and hit(s))
    fp = sum(1 for _, y, s, _ in data if y == 0 and hit(s))
    fn = sum(1 for _, y, s, _ in data if y == 1 and not hit(s))
    return tp, len(data) - tp - fp - fn, fp, fn


def test_threshold_table_equals_separate_counts(scored):
    data = [tuple(r) for r in scored.collect()]
    cuts = [0.0, 0.5, 0.6, 1.0]
    for r in M.threshold_table(scored, "y", "s", cuts).collect():
        tp, tn, fp, fn = counts(data, r["threshold"])
        assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (tp, tn, fp, fn)
        p = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn)
        f = 1.25 * p * rec / (0.25 * p + rec) if p + rec else 0.0
        assert abs(r["precision"] - p) < 1e-12 and abs(r["f05"] - f) < 1e-12
    keyed = M.threshold_table(scored, "y", "s", cuts, keys=["k"])
    assert keyed.count() == 8
    total = keyed.filter("threshold = 0.5").agg(F.sum("tp"), F.sum("fn")).first()
    assert tuple(total) == (counts(data, 0.5)[0], counts(data, 0.5)[3])


def test_curve_equals_brute_force(scored):
    data = [tuple(r) for r in scored.collect()]
    curve = M.score_curve(scored, "y", "s").collect()
    assert len(curve) == len({s for _, _, s, _ in data})
    for r in curve:
        assert (r["tp"], r["tn"], r["fp"], r["fn"]) == counts(data, r["threshold"], strict=False)


def test_auc_equals_pairs_and_the_evaluator(spark, scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    data = [tuple(r) for r in scored.collect()]
    pos = [s for _, y, s, _ in data if y == 1]
    neg = [s for _, y, s, _ in data if y == 0]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = M.area_under_roc(scored, "y", "s").first()
    assert abs(got["auc"] - pairs) < 1e-12
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert abs(evaluator.evaluate(scored) - pairs) < 1e-9
    assert M.area_under_roc(scored, "y", "s", keys=["k"]).count() == 2


def test_undefined_scores_are_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "y double, prediction double")
    r = M.confusion_metrics(df, "y").first()
    assert (r["precision"], r["recall"], r["f05"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.0, 0.5)


def test_best_threshold_prefers_the_lower_on_ties(spark):
    df = spark.createDataFrame([(0.7, 0.4), (0.5, 0.4), (0.6, 0.1)], "threshold double, f05 double")
    assert M.best_threshold(df).first()["threshold"] == 0.5


def test_votes(spark, rows):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 0.0), (0.0, 1.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0)],
        "y double, a double, b double, c double",
    )
    voted = df.withColumns(M.vote_columns(["a", "b", "c"]))
    got = [tuple(r) for r in voted.select("total_pred", "vote_majority", "vote_any", "vote_all").collect()]
    assert got == [(3.0, 1.0, 1.0, 1.0), (2.0, 1.0, 1.0, 0.0), (1.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 0.0)]
    table = {r["model"]: r for r in M.compare_predictions(voted, "y", ["a", "vote_majority", "vote_all"]).collect()}
    assert (table["a"]["tp"], table["a"]["fp"]) == (2, 1)
    assert table["vote_majority"]["accuracy"] == 1.0 and table["vote_all"]["fn"] == 1


def test_joined_predictions_keep_common_rows(spark, rows):
    a = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 0.0)], "id int, y double, prediction double")
    b = spark.createDataFrame([(2, 1.0, 1.0), (3, 1.0, 1.0)], "id int, y double, prediction double")
    out = M.join_predictions({"A": a, "B": b}, ["id", "y"])
    assert rows(out) == [(2, 1.0, 0.0, 1.0)]


def test_result_types_cover_all_rows(scored):
    typed = M.with_result(scored.withColumn("prediction", (F.col("s") > 0.5).cast("double")), "y")
    assert typed.filter("r_tp + r_tn + r_fp + r_fn <> 1").count() == 0
    shares = M.result_shares(typed, "y").agg(F.sum("n_rows"), F.sum("percentage")).first()
    assert shares[0] == 800 and abs(shares[1] - 100) < 1e-9
    sliced = M.error_slices(typed, "y", "prediction", ["k"]).agg(F.sum("n_rows")).first()[0]
    assert sliced == 800
    kept = typed.filter("id < 600")
    audit = M.dropped_rows(typed, kept).first()
    assert (audit["n_dropped"], audit["perc_dropped"]) == (200, 25.0)
    assert M.unscored(typed, kept, ["id"]).count() == 200


def test_matrices_equal_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    rng = random.Random(4)
    data = []
    for _ in range(400):
        a = rng.gauss(0, 1)
        data.append((a, a * 2 + rng.gauss(0, 1), float(rng.randrange(4)), float(rng.random() < 0.3)))
    columns = ["a", "b", "c", "y"]
    df = spark.createDataFrame(data, "a double, b double, c double, y double")
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(df)
    for method, mine in (("pearson", C.pearson_matrix), ("spearman", C.spearman_matrix)):
        matrix = Correlation.corr(vectors, "v", method).first()[0].toArray()
        got = {(r["row_name"], r["col_name"]): r["corr"] for r in mine(df, columns).collect()}
        assert len(got) == 16
        for i, x in enumerate(columns):
            for j, z in enumerate(columns):
                assert abs(got[x, z] - matrix[i][j]) < 1e-9, (method, x, z)
    top = C.pearson_vs_label(df, ["a", "b", "c"], "y").collect()
    assert [abs(r["corr"]) for r in top] == sorted((abs(r["corr"]) for r in top), reverse=True)
    assert C.versus(C.pearson_matrix(df, columns), "y").first()["row_name"] == "y"


def test_periods_overlap(spark):
    df = spark.createDataFrame([(y, float(i), float(i * i % 7)) for y in (2016, 2018, 2021) for i in range(20)], "YEAR int, a double, b double")
    ranges = {"all": None, "2016-2019": (2016, 2019), "2021": (2021, 2021)}
    tagged = C.tag_periods(df, "YEAR", ranges, "p").groupBy("p").count()
    assert {r["p"]: r["count"] for r in tagged.collect()} == {"all": 60, "2016-2019": 40, "2021": 20}
    for by in (C.pearson_by_period, C.spearman_by_period):
        assert by(df, ["a", "b"], "YEAR", ranges).count() == 12


def test_yearly_trend(spark, rows):
    df = spark.createDataFrame([(2019, 1.0, "a"), (2019, 0.0, "b"), (2020, 0.0, "c")], "YEAR int, y double, id string")
    assert rows(C.yearly_trend(df, "YEAR", "y", "id")) == [(2019, 2, 1.0, 50.0), (2020, 1, 0.0, 0.0)]


def test_compact_curve_keeps_the_turns(spark):
    rng = random.Random(9)
    data = [(k, rng.randint(0, 1), round(rng.random(), rng.choice([1, 9]))) for k in (None, "a", "b") for _ in range(300)]
    data += [("a", 1, None), ("b", None, 0.5), ("c", 1, 0.5), ("c", 0, 0.25)]
    df = spark.createDataFrame(data, "k string, y int, s double")
    full, short = M.score_curve(df, "y", "s", ["k"]).collect(), M.compact_curve(df, "y", "s", ["k"]).collect()
    for key in (None, "a", "b", "c"):
        points = sorted({(r["fp"], r["tp"]) for r in full if r["k"] == key})
        want, before = [], (0, 0)
        for i, (x, y) in enumerate(points):
            after = points[i + 1] if i + 1 < len(points) else None
            if after is None or (x - before[0]) * (after[1] - y) != (y - before[1]) * (after[0] - x):
                want.append((x, y))
            before = (x, y)
        assert sorted((r["fp"], r["tp"]) for r in short if r["k"] == key) == want
    areas = lambda d: {r["k"]: round(r["area"], 12) for r in d.collect()}
    assert areas(M.curve_area(M.score_curve(df, "y", "s", ["k"]), ["k"])) == areas(M.curve_area(M.compact_curve(df, "y", "s", ["k"]), ["k"]))
    assert len(short) < 0.7 * len(full)


def test_neighbours_cross_bucket_borders(spark):
    df = spark.createDataFrame([(i, i % 7 + 1) for i in range(200)], "v int, n int")
    got = running_totals(df, "v", {"m": F.col("n")}, buckets=16, neighbours=True).orderBy("v").collect()
    assert [r["m_below"] for r in got] == [None] + [i % 7 + 1 for i in range(199)]


def test_thinned_curve(spark):
    df = spark.createDataFrame([(i % 2, i / 100) for i in range(95)], "y int, s double")
    got = M.thinned_curve(M.score_curve(df, "y", "s"), 10).orderBy("threshold").collect()
    assert [r["threshold"] for r in got] == [i / 100 for i in range(0, 95, 10)]
