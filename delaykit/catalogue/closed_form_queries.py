"""Fitted models whose answers are known in closed form, and selection on plain metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, tables
from delaykit.config import FeatureSet
from delaykit.ml.estimators import make_estimator, score_rows
from delaykit.ml.preparation import build_pipeline
from delaykit.ml.selection import best_row, mean_metrics, top_settings
from delaykit.operators.metrics import SCORES, threshold_table

# Probabilities are added up: their sum over a group is its number of delays, a whole number, so
# rounding cannot fall on either side of a tie.
_TOTALS_SQL = """SELECT o_orderpriority, count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_delayed
FROM orders GROUP BY o_orderpriority"""


def _totals(scored, group):
    total = F.round(F.sum("predicted_probability")).cast("long")
    return scored.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), total.alias("n_delayed"))


def _by_priority(spark, sf, family, settings):
    (orders,) = tables(spark, sf, "orders")
    rows = orders.select("o_orderpriority", (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    chosen = FeatureSet("priority", ("o_orderpriority",), ())
    ready = build_pipeline(rows, chosen, one_hot=True).transform(rows)
    scored = score_rows(make_estimator(family, settings, "y").fit(ready), ready)
    return _totals(scored, "o_orderpriority")


@query("closed_lr_group_rates", _TOTALS_SQL)
def closed_lr(spark, sf):
    """An unregularised regression on one one-hot column ends at the rate of every group."""
    settings = {"regParam": 0.0, "maxIter": 100, "tol": 1e-10}
    return _by_priority(spark, sf, "lr", settings)


@query(
    "closed_rf_leaf_shares",
    """WITH rows AS (
  SELECT CASE WHEN o_orderpriority < '3' THEN 'urgent' ELSE 'later' END AS kind, floor(o_totalprice) % 10 AS digit FROM orders)
SELECT kind, count(*) AS n_rows, count(*) FILTER (WHERE digit < CASE WHEN kind = 'urgent' THEN 7 ELSE 3 END) AS n_delayed
FROM rows GROUP BY kind""",
)
def closed_rf(spark, sf):
    """One tree over all rows and one categorical has a leaf for every group (of groups with the
    same majority it would merge the leaves)."""
    (orders,) = tables(spark, sf, "orders")
    kind = F.when(F.col("o_orderpriority") < "3", "urgent").otherwise("later")
    digit = F.floor("o_totalprice") % 10
    rows = orders.select(kind.alias("kind"), (digit < F.when(kind == "urgent", 7).otherwise(3)).cast("double").alias("y"))
    ready = build_pipeline(rows, FeatureSet("kind", ("kind",), ()), one_hot=False).transform(rows)
    settings = {"numTrees": 1, "maxDepth": 4, "bootstrap": False, "featureSubsetStrategy": "all"}
    scored = score_rows(make_estimator("rf", settings, "y").fit(ready), ready)
    return _totals(scored, "kind")


_RULE = FeatureSet("rule", ("o_orderpriority",), ("quarter_of_price",))
_RULE_SQL = "SELECT count(*) AS n_rows, count(*) AS n_right FROM orders"


def _rule(spark, sf, family, settings, threshold):
    """Labels follow a number by a rule with a wide gap, so a sound classifier gets them all."""
    (orders,) = tables(spark, sf, "orders")
    part = (F.floor("o_totalprice") % 4).cast("double")
    rows = orders.select("o_orderpriority", part.alias("quarter_of_price"), (part > 1.5).cast("double").alias("y"))
    one_hot = family in ("svm", "mlp")
    ready = build_pipeline(rows, _RULE, one_hot=one_hot, scale=True).transform(rows)
    vectors = "scaledFeatures" if one_hot else "features"
    if family == "mlp":
        settings = settings | {"layers": [ready.first()[vectors].size, 4, 2]}
    scored = score_rows(make_estimator(family, settings, "y", vectors).fit(ready), ready)
    right = (F.col("predicted_probability") > threshold).cast("double") == F.col("y")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(right).alias("n_right"))


@query("closed_gbt_rule", _RULE_SQL)
def closed_gbt(spark, sf):
    return _rule(spark, sf, "gbt", {"maxIter": 5, "maxDepth": 4, "maxBins": 32, "stepSize": 0.5}, 0.5)


@query("closed_svm_rule", _RULE_SQL)
def closed_svm(spark, sf):
    return _rule(spark, sf, "svm", {"regParam": 0.0, "maxIter": 100}, 0.0)


@query("closed_mlp_rule", _RULE_SQL)
def closed_mlp(spark, sf):
    return _rule(spark, sf, "mlp", {"maxIter": 100, "blockSize": 128}, 0.5)


# -- selection on metrics of closed-form scores ------------------------------

_CUTS = (0.3, 0.5, 0.7)


def _grid_metrics(spark, sf):
    """Metrics of every priority (as setting) on four folds; one setting lacks a fold."""
    rows = s.scored(spark, sf).withColumn("cv_fold", F.col("month") % 4)
    table = threshold_table(rows, "label", "score", _CUTS, ["o_orderpriority", "cv_fold"])
    return table.select(
        F.lit("x").alias("family"), F.col("o_orderpriority").alias("params"), "cv_fold", "threshold",
        *[F.col(c).alias(f"val_{c}") for c in SCORES],
    ).filter((F.col("params") != "1-URGENT") | (F.col("cv_fold") > 0))


_GRID_SQL = f"""{s.SCORED_SQL},
counts AS (
  SELECT 'x' AS family, o_orderpriority AS params, CAST(month % 4 AS INTEGER) AS cv_fold, t AS threshold,
         count(*) FILTER (WHERE label = 1 AND score > t) AS tp, count(*) FILTER (WHERE label = 0 AND score <= t) AS tn,
         count(*) FILTER (WHERE label = 0 AND score > t) AS fp, count(*) FILTER (WHERE label = 1 AND score <= t) AS fn
  FROM scored, (SELECT unnest({list(_CUTS)}::DOUBLE[]) AS t)
  WHERE o_orderpriority <> '1-URGENT' OR month % 4 > 0 GROUP BY ALL),
rates AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS val_precision,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS val_recall FROM counts),
grid AS (
  SELECT family, params, cv_fold, threshold, val_precision, val_recall,
         CASE WHEN val_precision + val_recall = 0 THEN 0
              ELSE 1.25 * val_precision * val_recall / (0.25 * val_precision + val_recall) END AS val_f05,
         CASE WHEN val_precision + val_recall = 0 THEN 0
              ELSE 2 * val_precision * val_recall / (val_precision + val_recall) END AS val_f1,
         (tp + tn) / (tp + tn + fp + fn) AS val_accuracy FROM rates),
means AS (
  SELECT family, params, threshold, {", ".join(f"avg(val_{c}) AS val_{c}" for c in SCORES)}, count(*) AS n_folds
  FROM grid GROUP BY ALL),
ranked AS (
  SELECT family, params, threshold, row_number() OVER (ORDER BY val_f05 DESC, family, params, threshold) AS place
  FROM means WHERE n_folds = 4)"""
_SHOWN = ", ".join(f"round(val_{c}, 9) AS val_{c}" for c in SCORES)


def _rounded(df):
    return df.withColumns({f"val_{c}": F.round(f"val_{c}", 9) for c in SCORES})


@query("metric_means", f"WITH {_GRID_SQL}\nSELECT family, params, threshold, {_SHOWN}, n_folds FROM means")
def metric_means(spark, sf):
    return _rounded(mean_metrics(_grid_metrics(spark, sf)))


@query(
    "metric_top",
    f"""WITH {_GRID_SQL}
SELECT family, params, cv_fold, threshold, {_SHOWN} FROM grid JOIN ranked USING (family, params, threshold) WHERE place <= 5""",
)
def metric_top(spark, sf):
    """Five best settings; the one without a fold is not ranked."""
    return _rounded(top_settings(_grid_metrics(spark, sf), 5))


@query(
    "metric_best",
    f"""WITH {_GRID_SQL}
SELECT family, params, cv_fold, threshold, {_SHOWN} FROM grid JOIN ranked USING (family, params, threshold)
WHERE place = 1 ORDER BY val_f05 DESC, cv_fold LIMIT 1""",
)
def metric_best(spark, sf):
    return _rounded(best_row(_grid_metrics(spark, sf)))
