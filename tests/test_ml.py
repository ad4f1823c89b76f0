import random

import pytest
from pyspark.sql import functions as F

from delaykit.config import FEATURE_SETS, FeatureSet
from delaykit.ml import reports
from delaykit.ml.estimators import boosting_prefix, boosting_scores, make_estimator, naive_predictions, score_rows
from delaykit.ml.preparation import build_pipeline, cardinality, feature_names, numbered, transformed, vectors
from delaykit.ml.search import FAILURE_SCHEMA, SearchResult, blocking_search, expand_grid, kfold_search, shared_fits
from delaykit.ml.selection import best_model, best_row, holdout_metrics, mean_metrics, top_settings
from delaykit.operators.metrics import confusion_metrics, dropped_rows
from delaykit.plans.training import prepare, train_and_choose

SET = FeatureSet("small", ("carrier", "prev"), ("rate", "wind"), label="y")

def hold():
    return F.col("YEAR") == 2021


@pytest.fixture(scope="module")
def flights(spark):
    """Delays that follow from the previous delay and the wind; one carrier only in 2021."""
    rng = random.Random(8)
    data = []
    for i in range(2400):
        year = 2018 + i // 600
        prev, wind = float(rng.random() < 0.3), rng.gauss(10, 3)
        y = float(rng.random() < (0.75 if prev else 0.15) + (0.1 if wind > 12 else 0))
        carrier = "NEW" if year == 2021 and i % 50 == 0 else rng.choice(["A", "B", "C"])
        rate = None if i % 400 == 3 else rng.gauss(20, 5)
        data.append((i, f"f{i}", year, carrier, str(prev), rate, wind, y))
    df = spark.createDataFrame(
        data, "t int, flight_id string, YEAR int, carrier string, prev string, rate double, wind double, y double"
    )
    return df.withColumn("time", F.timestamp_seconds(F.col("t") * 3600).cast("timestamp_ntz")).cache()


@pytest.fixture(scope="module")
def prepared(flights):
    return prepare(flights, SET, hold(), "time")


def test_feature_sets_have_the_published_sizes():
    sizes = {n: (len(s.categoricals), len(s.numerics)) for n, s in FEATURE_SETS.items()}
    assert sizes == {"full": (13, 14), "baseline": (4, 12), "no_weather": (8, 4), "only_weather": (5, 10)}


def test_unseen_and_missing_rows_are_skipped_and_reported(flights, prepared):
    audit = dropped_rows(flights.filter(hold()), prepared.holdout).first()
    unseen = flights.filter(hold() & ((F.col("carrier") == "NEW") | F.col("rate").isNull())).count()
    assert audit["n_dropped"] == unseen > 0


def test_names_follow_vector_order(flights):
    plain = build_pipeline(flights.filter(~hold()), SET, one_hot=False).transform(flights)
    assert feature_names(plain) == ["carrier_idx", "prev_idx", "rate", "wind"]
    hot = build_pipeline(flights.filter(~hold()), SET, one_hot=True).transform(flights)
    names = feature_names(hot)
    assert len(names) == hot.first()["features"].size and names[-2:] == ["rate", "wind"]


def test_imputer_and_scaler(flights):
    fitted = build_pipeline(flights.filter(~hold()), SET, impute=True, scale=True)
    out = fitted.transform(flights.filter(~hold()))
    assert out.count() == flights.filter(~hold()).count()
    assert abs(sum(r["scaledFeatures"][-1] for r in out.select("scaledFeatures").collect())) < 1e-6


def test_category_counts_are_told(flights):
    counts = cardinality(flights, ["flight_id", "carrier"])
    assert counts["carrier"] == 4 and counts["flight_id"] > 2000
    assert cardinality(flights, []) == {}


def test_training_precedes_validation(prepared):
    ends = prepared.train.filter("fold is not null").groupBy("fold").agg(
        F.max(F.when(~F.col("is_val"), F.col("time"))).alias("a"),
        F.min(F.when(F.col("is_val"), F.col("time"))).alias("b"),
    )
    assert ends.filter("a >= b").count() == 0 and ends.count() == 4
    assert prepared.train.filter(hold()).count() == 0


FAMILIES = {
    "lr": ({"regParam": [0.0], "maxIter": [10]}, (0.4, 0.5), False),
    "rf": ({"numTrees": [5], "maxDepth": [3]}, (0.4, 0.5), False),
    "gbt": ({"maxIter": [3], "maxDepth": [2], "stepSize": [0.5]}, (0.4, 0.5), False),
    "svm": ({"regParam": [0.0], "maxIter": [10]}, (0.0,), False),
    "mlp": ({"layers": [(5, 4, 2)], "maxIter": [40], "blockSize": [64]}, (0.4, 0.5), True),
}


@pytest.mark.parametrize("family", sorted(FAMILIES))
def test_families_beat_the_naive_baseline(flights, family):
    grid, cuts, scale = FAMILIES[family]
    ready = prepare(flights, SET, hold(), "time", scale=scale)
    vectors = "scaledFeatures" if scale else "features"
    width = ready.train.first()[vectors].size
    settings = expand_grid(grid)
    for s in settings:
        if "layers" in s:
            s["layers"] = [width, 4, 2]
    outcome = train_and_choose(ready, family, settings, "y", cuts, vectors, parallelism=4)
    assert outcome.search.failures.count() == 0
    assert outcome.search.metrics.count() == 4 * len(cuts) * len(settings)
    got = confusion_metrics(outcome.predictions, "y").first()
    naive = confusion_metrics(naive_predictions(ready.holdout), "y").first()
    assert got["f05"] > naive["f05"] == 0.0
    assert got["accuracy"] > 0.5


def test_search_equals_separate_fits(prepared):
    """One fold, one setting, one threshold, by hand."""
    found = blocking_search(prepared.train, "lr", [{"maxIter": 5}], "y", (0.5,), folds=[2])
    mine = prepared.train.filter("fold = 2")
    model = make_estimator("lr", {"maxIter": 5}, "y").fit(mine.filter("not is_val"))
    byhand = score_rows(model, mine.filter("is_val")).withColumn(
        "prediction", (F.col("predicted_probability") > 0.5).cast("double")
    )
    a, b = found.metrics.first(), confusion_metrics(byhand, "y").first()
    assert (a["val_tp"], a["val_tn"], a["val_fp"], a["val_fn"]) == (b["tp"], b["tn"], b["fp"], b["fn"])


def test_failures_are_reported(prepared):
    found = blocking_search(
        prepared.train, "mlp", [{"layers": [99, 2], "maxIter": 1}], "y", (0.5,), folds=[0]
    )
    assert found.metrics.count() == 0 and found.failures.first()["cv_fold"] == 0


def test_selection(spark):
    columns = "model_id string, family string, params string, cv_fold int, threshold double, val_precision double, val_recall double, val_f05 double, val_f1 double, val_accuracy double"
    data = [
        ("a0", "lr", "a", 0, 0.5, 0.1, 0.1, 0.9, 0.1, 0.1), ("a1", "lr", "a", 1, 0.5, 0.1, 0.1, 0.1, 0.1, 0.1),
        ("b0", "lr", "b", 0, 0.5, 0.1, 0.1, 0.6, 0.1, 0.1), ("b1", "lr", "b", 1, 0.5, 0.1, 0.1, 0.7, 0.1, 0.1),
    ]
    metrics = spark.createDataFrame(data, columns)
    assert {r["params"]: round(r["val_f05"], 9) for r in mean_metrics(metrics).collect()} == {"a": 0.5, "b": 0.65}
    # the best mean wins, not the best single fold; then the best fold of that setting
    assert best_row(metrics).first()["model_id"] == "b1"
    none = spark.createDataFrame([], FAILURE_SCHEMA)
    assert best_model(SearchResult(metrics, {"b1": "model"}, none, 2))[0] == "model"
    assert top_settings(metrics, 1).count() == 2
    # a setting that was scored on one fold only is not ranked, however good the fold
    lone = metrics.unionByName(
        spark.createDataFrame([("c0", "lr", "c", 0, 0.5, 0.1, 0.1, 0.99, 0.1, 0.1)], columns)
    )
    assert best_row(lone).first()["model_id"] == "b1" == best_row(lone, n_folds=2).first()["model_id"]
    assert top_settings(lone, 20).filter("params = 'c'").isEmpty()
    failed = spark.createDataFrame([("c1", "c", 1, "no luck")], FAILURE_SCHEMA)
    with pytest.raises(RuntimeError, match="no luck"):
        best_model(SearchResult(lone, {}, failed, 3))


def test_holdout_metrics(prepared):
    found = blocking_search(prepared.train, "lr", expand_grid({"maxIter": [3, 5]}), "y", (0.4, 0.5))
    chosen = top_settings(found.metrics, 2)
    tested = holdout_metrics(chosen, found.models, prepared.holdout, "y")
    assert tested.count() == chosen.count() == 8
    assert tested.filter("test_accuracy is null").count() == 0


def test_period_folds_train_per_year(flights):
    ready = prepare(flights, SET, hold(), "time", period="YEAR")
    found = blocking_search(ready.train, "lr", [{"maxIter": 3}], "y", (0.5,))
    assert sorted(r["cv_fold"] for r in found.metrics.collect()) == [2018, 2019, 2020]


def test_reports(spark, prepared, tmp_path):
    names = feature_names(prepared.train)
    lr = make_estimator("lr", {"maxIter": 5}, "y").fit(prepared.train)
    table = reports.feature_importance(spark, lr, names).collect()
    assert len(table) == len(names)
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)
    curve = reports.training_curve(lr, prepared.train, "y")
    assert curve.columns == ["threshold", "precision", "recall", "F05"]
    scores = score_rows(lr, prepared.train).select("predicted_probability").distinct().count()
    assert curve.count() == scores == reports.training_roc(lr, prepared.train, "y").count()
    assert reports.training_loss(spark, lr).count() > 1
    area = reports.training_area(lr, prepared.train, "y").first()["auc"]
    assert area == pytest.approx(lr.summary.areaUnderROC, abs=1e-3) and area > 0.5

    gbt = make_estimator("gbt", {"maxIter": 3, "maxDepth": 2}, "y").fit(prepared.train)
    assert reports.tree_ensemble_report(spark, gbt).count() == 3
    losses = [r["loss"] for r in reports.boosting_loss(gbt, prepared.train).collect()]
    assert losses == sorted(losses, reverse=True)

    path = str(tmp_path / "model")
    reports.save_model(lr, path)
    from pyspark.ml.classification import LogisticRegressionModel

    assert LogisticRegressionModel.load(path).coefficients == lr.coefficients


def test_kfold(prepared):
    _, table = kfold_search(prepared.train, "lr", {"regParam": [0.0, 10.0], "maxIter": [3]}, "y", folds=2)
    assert table.count() == 2 and table.filter("avg_auc > 0.5").count() >= 1


def test_kfold_is_sparks_with_fewer_fits(spark, monkeypatch):
    """The areas, their spread and the chosen model of Spark's own cross-validation; fits that must end alike are made once."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    df, made, keep = boosting_rows(spark).select("y", "features"), [], LogisticRegression._fit
    grid = {"regParam": [0.0, 0.05, 3.0], "elasticNetParam": [0.0, 1.0], "maxIter": [1, 30]}
    base = make_estimator("lr", {}, "y")
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(base.getParam(name), values)
    whole = CrossValidator(
        estimator=base, estimatorParamMaps=builder.build(), evaluator=BinaryClassificationEvaluator(labelCol="y"), numFolds=3, seed=100
    ).fit(df)
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, rows: made.append(1) or keep(self, rows))
    fitted, table = kfold_search(df, "lr", grid, "y", folds=3)
    assert len(made) == 3 * 9 + 1 < 3 * len(whole.avgMetrics)  # two each without a penalty and for three others, one for the last
    assert fitted.avgMetrics == pytest.approx(whole.avgMetrics, abs=1e-9) and fitted.stdMetrics == pytest.approx(whole.stdMetrics, abs=1e-9)
    assert fitted.bestModel.coefficients.toArray() == pytest.approx(whole.bestModel.coefficients.toArray())
    assert 0.5 in fitted.avgMetrics and max(fitted.avgMetrics) > 0.8  # some settings are held at zero, some are not
    assert sorted(r["avg_auc"] for r in table.collect()) == sorted(fitted.avgMetrics) and fitted.getNumFolds() == 3
    trees = kfold_search(df, "gbt", {"maxIter": [2, 4], "maxDepth": [2]}, "y")[0].avgMetrics
    alone = [kfold_search(df, "gbt", {"maxIter": [n], "maxDepth": [2]}, "y")[0].avgMetrics[0] for n in (2, 4)]
    assert trees == pytest.approx(alone, abs=1e-12)


def test_areas_of_one_kind_of_rows(spark):
    from delaykit.ml.search import fold_areas

    df = boosting_rows(spark).select("y", "features")
    model = make_estimator("svm", {"maxIter": 2}, "y").fit(df)
    assert fold_areas([model], df.filter("y = 0"), "y") == [0.0] and fold_areas([model], df.filter("y = 1"), "y") == [1.0]
    assert fold_areas([model], df.limit(0), "y") == [0.5]


def boosting_rows(spark):
    from pyspark.ml.linalg import Vectors

    rng = random.Random(3)
    rows = []
    for i in range(600):
        x = [rng.random() for _ in range(4)]
        rows.append((int(x[0] + x[1] * x[2] + 0.3 * rng.random() > 0.9), Vectors.dense(x), i % 2, i % 5 == 0))
    return spark.createDataFrame(rows, ["y", "features", "fold", "is_val"])


def test_boosting_prefix_is_a_fit_of_its_own(spark, tmp_path):
    df = boosting_rows(spark)
    settings = {"maxDepth": 4, "maxBins": 16, "stepSize": 0.5}
    long = make_estimator("gbt", settings | {"maxIter": 8}, "y").fit(df)
    own = make_estimator("gbt", settings | {"maxIter": 3}, "y").fit(df)
    short = boosting_prefix(long, 3)
    rules = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.trees]  # noqa: E731  the first line names the tree
    assert rules(short) == rules(own)
    assert short.featureImportances == own.featureImportances and boosting_prefix(long, 8) is long
    score = lambda d, c="predicted_probability": [round(r[c], 12) for r in d.select(c).collect()]
    want = score(score_rows(own, df))
    assert score(score_rows(short, df)) == want
    assert score(boosting_scores(long, df, [3, 8]), "p3") == want
    assert score(boosting_scores(long, df, [3, 8]), "p8") == score(score_rows(long, df))
    reports.save_model(short, str(tmp_path / "m"))
    assert score(score_rows(type(short).load(str(tmp_path / "m")), df)) == want


def test_shared_fits_give_the_metrics_of_single_ones(spark):
    df = boosting_rows(spark)
    for family, grid, fits in (
        ("gbt", expand_grid({"maxIter": [2, 4], "maxDepth": [3, 2], "stepSize": [0.5, 0.1]}), 4),
        ("lr", expand_grid({"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0], "maxIter": [5]}), 3),
    ):
        assert len(shared_fits(family, grid)) == fits
        together = blocking_search(df, family, grid, "y", (0.4, 0.6))
        alone = [blocking_search(df, family, [g], "y", (0.4, 0.6)) for g in grid]
        rows = lambda found: sorted(tuple(r) for r in found.metrics.collect())
        assert rows(together) == sorted(r for a in alone for r in rows(a))
        assert set(together.models) == {i for a in alone for i in a.models} and together.failures.isEmpty()


def test_a_failed_fit_is_reported_for_every_setting_it_serves(spark):
    found = blocking_search(boosting_rows(spark), "gbt", expand_grid({"maxIter": [2, 4], "maxBins": [1]}), "y")
    assert found.metrics.isEmpty() and found.failures.count() == 4


def test_a_query_does_not_show_a_search_with_failed_fits(spark, monkeypatch):
    """The rows of the settings that went well are no result of the whole grid, nor are those of three folds."""
    from delaykit.catalogue import model_queries
    from delaykit.config import LABEL
    from delaykit.plans.training import Prepared

    df = boosting_rows(spark).withColumnRenamed("y", LABEL)
    rows = {"all": df, "no validation": df.filter("fold = 0 or not is_val")}
    monkeypatch.setattr(model_queries, "_prepared", lambda spark, sf, *a, **k: Prepared(None, rows[sf], df))
    for bins, sf, told in (([4, 1], "all", "maxBins"), ([4], "no validation", "fold 1")):
        monkeypatch.setitem(model_queries.PUBLISHED_GRIDS, "gbt", {"maxIter": [2], "maxBins": bins, "maxDepth": [2]})
        for name in ("published_gbt", "holdout_eval_gbt"):
            with pytest.raises(RuntimeError, match=told):
                getattr(model_queries, name)(spark, sf)
    found = blocking_search(df, "gbt", expand_grid({"maxIter": [2], "maxBins": [4, 1]}), LABEL)
    assert found.failures.count() == 2 and found.metrics.count() == 2
    monkeypatch.setitem(model_queries.PUBLISHED_GRIDS, "gbt", {"maxIter": [2], "maxBins": [4], "maxDepth": [2]})
    assert model_queries.published_gbt(spark, "all").count() == 2 * 3


def test_rows_are_encoded_once(flights, monkeypatch):
    """Ranking and scaling read the written vectors."""
    from pyspark.ml.feature import OneHotEncoderModel

    from delaykit.plans import training

    seen = []

    def staged(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString().count("UDF")))
        return keep(df, name)

    keep = training.staged
    monkeypatch.setattr(training, "staged", staged)
    ready = prepare(flights, SET, hold(), "time", scale=True)
    assert [name for name, _ in seen] == ["encoded", "train"] and seen[0][1] > seen[1][1]
    whole = build_pipeline(flights.filter(~hold()), SET, scale=True)
    assert any(isinstance(s, OneHotEncoderModel) for s in ready.pipeline.stages) and len(ready.pipeline.stages) == len(whole.stages)
    want = {r["t"]: r["scaledFeatures"].toArray() for r in whole.transform(flights).collect()}
    got = [r for part in (ready.train, ready.holdout) for r in part.collect()]
    assert len(got) == len(want) and all(abs(r["scaledFeatures"].toArray() - want[r["t"]]).max() < 1e-9 for r in got)
    assert (ready.pipeline.transform(flights).count()) == len(want)


def test_a_round_of_boosting_is_sent_without_the_rounds_before(spark):
    """The lineage of round n holds no tree of the rounds before it: the checkpoint folder is set, every round cuts."""
    df = boosting_rows(spark)
    assert make_estimator("gbt", {"maxIter": 2}, "y").getCheckpointInterval() == 1
    assert make_estimator("gbt", {"checkpointInterval": 4}, "y").getCheckpointInterval() == 4
    blocking_search(df, "gbt", [{"maxIter": 2, "maxDepth": 2}], "y")
    assert spark.sparkContext.getCheckpointDir() is not None
    # what is sent decides nothing
    near, far = (make_estimator("gbt", {"maxIter": 6, "maxDepth": 4, "checkpointInterval": n}, "y").fit(df) for n in (1, -1))
    assert [t.toDebugString.split("\n", 1)[1] for t in near.trees] == [t.toDebugString.split("\n", 1)[1] for t in far.trees]


def test_fits_read_their_own_fold_in_large_parts(spark, monkeypatch):
    from delaykit.ml import search

    df = boosting_rows(spark).repartition(6)
    for size, parts in ((100_000, 1), (100, 3)):
        monkeypatch.setattr(search, "FIT_ROWS", size)
        rows = search.FoldRows(df, "fold", "is_val", [0, 0, 1])
        train, held = rows.get(0)
        assert train.rdd.getNumPartitions() == parts
        assert train.count() == df.filter("fold = 0 and not is_val").count() and held.count() == df.filter("fold = 0 and is_val").count()
        rows.get(1)
        rows.done(0)
        assert set(rows.kept) == {0, 1} and train.is_cached
        rows.done(0)
        assert set(rows.kept) == {1} and not train.is_cached
        rows.release()
        assert not rows.kept


@pytest.mark.parametrize("family", ["lr", "svm"])
def test_a_fit_that_ended_on_its_own_serves_shorter_runs(spark, monkeypatch, family):
    from delaykit.ml import search

    df, made = boosting_rows(spark), []
    grid = expand_grid({"regParam": [2.0], "maxIter": [2, 30, 40]} | ({"elasticNetParam": [1.0]} if family == "lr" else {}))
    alone = [blocking_search(df, family, [g], "y", (0.4, 0.6)) for g in grid]
    keep = search.make_estimator
    monkeypatch.setattr(search, "make_estimator", lambda *a: made.append(a[1]["maxIter"]) or keep(*a))
    together = blocking_search(df, family, grid, "y", (0.4, 0.6))
    rows = lambda found: sorted(tuple(r) for r in found.metrics.collect())
    assert rows(together) == sorted(r for a in alone for r in rows(a)) and together.failures.isEmpty()
    assert set(together.models) == {i for a in alone for i in a.models}
    assert all(together.models[i].coefficients == m.coefficients for a in alone for i, m in a.models.items())
    assert len(made) < 2 * len(grid) and made.count(40) == 2


@pytest.mark.parametrize(("one_hot", "impute"), [(True, False), (True, True), (False, False)])
def test_steps_of_the_preparation_are_the_whole(spark, one_hot, impute):
    rows = [("a", 1, 0.5, 2.0), ("a", 1, 1.5, None), ("b", 2, float("nan"), 1.0), ("c", 2, 2.5, 3.0), ("c", 2, 0.0, 0.0), ("c", 3, 1.0, 4.0)]
    train = spark.createDataFrame(rows, "k string, n int, x double, y double")
    fresh = train.union(spark.createDataFrame([("z", 1, 1.0, 1.0), (None, 1, 1.0, 1.0), ("a", None, 1.0, 1.0), ("b", 3, 1.0, 7.0)], train.schema))
    pipeline = build_pipeline(train, FeatureSet("s", ("k", "n"), ("x", "y")), one_hot, impute)
    narrow, inputs = numbered(pipeline, fresh)
    steps, whole = vectors(pipeline, narrow.select("k", "n", *inputs)), pipeline.transform(fresh)
    assert steps.schema["features"].metadata == whole.schema["features"].metadata
    assert sorted(map(str, steps.select("k", "n", "features").collect())) == sorted(map(str, whole.select("k", "n", "features").collect()))


def test_encoders_vectors_are_made_once(spark):
    rows = spark.range(60).selectExpr("cast(id % 3 as string) k", "cast(id % 4 as double) x")
    pipeline = build_pipeline(rows, FeatureSet("s", ("k",), ("x",)))
    made = transformed(pipeline, rows, ["k"], in_steps=True)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and "k_idx" in plan  # no look at the encoders' vectors, and no label in this step
    assert made.count() == 60


@pytest.mark.parametrize("limit", [2, 256])
def test_vectors_of_the_plan_are_the_stages(spark, monkeypatch, limit):
    """Two calls a row make the vector, however many columns are encoded; labels beyond the limit go by the stages."""
    from delaykit.ml import preparation

    monkeypatch.setattr(preparation, "PLAN_CELLS", limit)
    rows = [("a", 1, 0.0, 0.5, -0.0), ("a", 2, 1.0, 1.5, 3.0), ("b", 2, 0.0, float("nan"), 1.0), ("it's", 3, 1.5, 2.5, 3.0), ("d d", 1, 0.0, 0.0, 0.0)]
    train = spark.createDataFrame(rows * 2, "k string, n int, b double, x double, y double")
    fresh = train.union(train.limit(1).withColumn("k", F.lit("z"))).union(train.limit(1).withColumn("n", F.lit(None).cast("int")))
    for one_hot in (True, False):
        pipeline = build_pipeline(train, FeatureSet("s", ("k", "n", "b"), ("x", "y")), one_hot)
        made, whole = transformed(pipeline, fresh, ["k", "n"], in_steps=True), pipeline.transform(fresh)
        assert made.schema["features"].metadata == whole.schema["features"].metadata
        assert sorted(map(str, made.collect())) == sorted(map(str, whole.select("k", "n", "features").collect()))
        calls = made._jdf.queryExecution().optimizedPlan().toString().count("UDF(")
        assert (calls <= 2) == (limit == 256 or not one_hot)
