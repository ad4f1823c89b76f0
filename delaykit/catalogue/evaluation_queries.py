"""Confusion counts, thresholds, curves, votes and error slices over scored orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9
from delaykit.ml.estimators import naive_predictions
from delaykit.operators import metrics
from delaykit.plans.analysis import ensemble_report, error_report

_SCORE_SQL = """
       round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0
             ELSE 1.25 * precision * recall / (0.25 * precision + recall) END, 9) AS f05,
       round(CASE WHEN precision + recall = 0 THEN 0
             ELSE 2 * precision * recall / (precision + recall) END, 9) AS f1,
       round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy"""
_PR_SQL = """SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM counts"""


def _counts_sql(prediction: str) -> str:
    return f"""count(*) FILTER (WHERE label = 1 AND {prediction}) AS tp,
  count(*) FILTER (WHERE label = 0 AND NOT {prediction}) AS tn,
  count(*) FILTER (WHERE label = 0 AND {prediction}) AS fp,
  count(*) FILTER (WHERE label = 1 AND NOT {prediction}) AS fn"""


def _rounded(df):
    return df.withColumns({c: r9(c) for c in metrics.SCORES})


@query(
    "confusion_metrics",
    f"""WITH {s.SCORED_SQL},
counts AS (SELECT {_counts_sql('score > 0.5')} FROM scored), pr AS ({_PR_SQL})
SELECT tp, tn, fp, fn, {_SCORE_SQL} FROM pr""",
)
def confusion_metrics(spark, sf):
    rows = s.scored(spark, sf).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    return _rounded(metrics.confusion_metrics(rows, "label"))


@query(
    "confusion_by_carrier",
    f"""WITH {s.SCORED_SQL},
counts AS (SELECT o_orderpriority, {_counts_sql('score > 0.5')} FROM scored GROUP BY ALL),
pr AS ({_PR_SQL})
SELECT o_orderpriority, tp, tn, fp, fn, {_SCORE_SQL} FROM pr""",
)
def confusion_by_carrier(spark, sf):
    rows = s.scored(spark, sf).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    return _rounded(metrics.confusion_metrics(rows, "label", keys=["o_orderpriority"]))


_CUTS = [0.5, 0.6, 0.7, 0.8]
_THRESHOLDS_SQL = f"""WITH {s.SCORED_SQL},
cuts AS (SELECT unnest({_CUTS})::DOUBLE AS threshold),
counts AS (SELECT threshold, {_counts_sql('score > threshold')} FROM scored, cuts GROUP BY threshold),
pr AS ({_PR_SQL})"""


@query("threshold_table", f"{_THRESHOLDS_SQL}\nSELECT threshold, tp, tn, fp, fn, {_SCORE_SQL} FROM pr")
def threshold_table(spark, sf):
    return _rounded(metrics.threshold_table(s.scored(spark, sf), "label", "score", _CUTS))


@query(
    "best_threshold",
    f"""{_THRESHOLDS_SQL},
t AS (SELECT threshold, tp, tn, fp, fn, {_SCORE_SQL} FROM pr)
SELECT * FROM t ORDER BY f05 DESC, threshold LIMIT 1""",
)
def best_threshold(spark, sf):
    table = metrics.threshold_table(s.scored(spark, sf), "label", "score", _CUTS)
    return _rounded(metrics.best_threshold(table))


_CURVE_SQL = f"""WITH {s.SCORED_SQL},
v AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
counts AS (
  SELECT score AS threshold,
         CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
         CAST(sum(pos) OVER () - sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS fn,
         CAST(sum(neg) OVER () - sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS tn
  FROM v),
pr AS ({_PR_SQL})"""


@query(
    "roc_pr_curve",
    f"""{_CURVE_SQL}
SELECT threshold, tp, tn, fp, fn, round(fp / (fp + tn), 9) AS fpr, {_SCORE_SQL}, round(recall, 9) AS tpr
FROM pr""",
)
def roc_pr_curve(spark, sf):
    curve = metrics.score_curve(s.scored(spark, sf), "label", "score")
    return _rounded(curve).withColumns({"fpr": r9("fpr"), "tpr": r9("tpr")})


_COMPACT_SQL = f"""{_CURVE_SQL},
turns AS (SELECT *, tp - lag(tp, 1, 0) OVER w AS dp, fp - lag(fp, 1, 0) OVER w AS dn,
                 lead(tp) OVER w - tp AS ep, lead(fp) OVER w - fp AS en
          FROM pr WINDOW w AS (ORDER BY threshold DESC)),
compact AS (SELECT * FROM turns WHERE ep IS NULL OR dp * en <> dn * ep)"""


@query(
    "roc_pr_curve_compact",
    f"""{_COMPACT_SQL}
SELECT threshold, tp, tn, fp, fn, round(fp / (fp + tn), 9) AS fpr, {_SCORE_SQL}, round(recall, 9) AS tpr
FROM compact""",
)
def roc_pr_curve_compact(spark, sf):
    """The curve to draw: points on a straight line between others are left out."""
    curve = metrics.compact_curve(s.scored(spark, sf), "label", "score")
    return _rounded(curve).withColumns({"fpr": r9("fpr"), "tpr": r9("tpr")})


@query(
    "curve_every_tenth",
    f"""{_CURVE_SQL}
SELECT threshold, tp, fp FROM (SELECT *, row_number() OVER (ORDER BY threshold) AS n FROM pr) WHERE n % 10 = 1""",
)
def curve_every_tenth(spark, sf):
    curve = metrics.score_curve(s.scored(spark, sf), "label", "score")
    return metrics.thinned_curve(curve, 10).select("threshold", "tp", "fp")


@query(
    "area_of_compact_curve",
    f"""WITH {s.SCORED_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM scored),
n AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q, sum(rk) FILTER (WHERE label = 1) AS r FROM r)
SELECT round((r - p * (p + 1) / 2) / (p * q), 9) AS area FROM n""",
)
def area_of_compact_curve(spark, sf):
    """The area below the compact curve is the one that the ranks give."""
    return metrics.curve_area(metrics.compact_curve(s.scored(spark, sf), "label", "score")).select(r9("area").alias("area"))


@query(
    "f05_by_threshold",
    f"""{_CURVE_SQL},
t AS (SELECT threshold, {_SCORE_SQL} FROM pr)
SELECT threshold, precision, recall, f05 FROM t ORDER BY f05 DESC, threshold LIMIT 1""",
)
def f05_by_threshold(spark, sf):
    curve = _rounded(metrics.score_curve(s.scored(spark, sf), "label", "score"))
    return metrics.best_threshold(curve).select("threshold", "precision", "recall", "f05")


@query(
    "auc",
    f"""WITH {s.SCORED_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk
      FROM scored)
SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg,
  round((sum(rk) FILTER (WHERE label = 1)
    - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
    / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0)), 9) AS auc
FROM r""",
)
def auc(spark, sf):
    area = metrics.area_under_roc(s.scored(spark, sf), "label", "score")
    return area.withColumn("auc", r9("auc"))


# three closed-form voters over the same rows (fixed rules of the stand-in)
_VOTERS = {
    "LR": "score > 0.5",
    "GBT": "o_custkey % 7 > 3",
    "MLP": "month > 6",
}
_VOTES_SQL = f"""WITH {s.SCORED_SQL},
m AS (SELECT label, CAST({_VOTERS['LR']} AS INTEGER) AS a, CAST({_VOTERS['GBT']} AS INTEGER) AS b,
             CAST({_VOTERS['MLP']} AS INTEGER) AS c FROM scored),
votes AS (
  SELECT label, 'LR_prediction' AS model, a = 1 AS p FROM m
  UNION ALL SELECT label, 'GBT_prediction', b = 1 FROM m
  UNION ALL SELECT label, 'MLP_prediction', c = 1 FROM m
  UNION ALL SELECT label, 'vote_majority', (a + b + c) / 3 > 0.5 FROM m
  UNION ALL SELECT label, 'vote_any', a + b + c > 0 FROM m
  UNION ALL SELECT label, 'vote_all', a + b + c = 3 FROM m),
counts AS (SELECT model, {_counts_sql('p')} FROM votes GROUP BY model),
pr AS ({_PR_SQL})"""


@query("vote_ensemble", f"{_VOTES_SQL}\nSELECT model, tp, tn, fp, fn, {_SCORE_SQL} FROM pr")
def vote_ensemble(spark, sf):
    rows = s.scored(spark, sf)
    frames = {
        name: rows.select("o_orderkey", "label", F.expr(rule).cast("double").alias("prediction"))
        for name, rule in _VOTERS.items()
    }
    return _rounded(ensemble_report(frames, ["o_orderkey"], "label"))


@query(
    "naive_baseline",
    f"""WITH {s.SCORED_SQL}, counts AS (SELECT {_counts_sql('false')} FROM scored), pr AS ({_PR_SQL})
SELECT tp, tn, fp, fn, {_SCORE_SQL} FROM pr""",
)
def naive_baseline(spark, sf):
    return _rounded(metrics.confusion_metrics(naive_predictions(s.scored(spark, sf)), "label"))


_TYPED = """typed AS (SELECT *, CASE WHEN label = 1 AND score > 0.5 THEN 'tp' WHEN label = 0 AND score <= 0.5
  THEN 'tn' WHEN label = 0 THEN 'fp' ELSE 'fn' END AS r_type FROM scored)"""


def _predicted(spark, sf):
    return s.scored(spark, sf).withColumn("prediction", (F.col("score") > 0.5).cast("double"))


@query(
    "result_types",
    f"""WITH {s.SCORED_SQL}, {_TYPED}
SELECT o_orderkey, r_type, CAST(r_type = 'tp' AS INTEGER) AS r_tp, CAST(r_type = 'tn' AS INTEGER) AS r_tn,
       CAST(r_type = 'fp' AS INTEGER) AS r_fp, CAST(r_type = 'fn' AS INTEGER) AS r_fn FROM typed""",
)
def result_types(spark, sf):
    return metrics.with_result(_predicted(spark, sf), "label").select(
        "o_orderkey", "r_type", "r_tp", "r_tn", "r_fp", "r_fn"
    )


@query(
    "result_shares",
    f"""WITH {s.SCORED_SQL}, {_TYPED}
SELECT r_type, count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM typed) * 100, 9) AS percentage
FROM typed GROUP BY r_type""",
)
def result_shares(spark, sf):
    shares = metrics.result_shares(_predicted(spark, sf), "label")
    return shares.withColumn("percentage", r9("percentage"))


_SLICED = ["o_orderpriority", "month", "weekday", "quarter", "region", "is_large"]


@query(
    "error_slices",
    f"WITH {s.SCORED_SQL}, {_TYPED}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, r_type, count(*) AS n_rows FROM typed GROUP BY ALL"
        for c in _SLICED
    ),
)
def error_slices(spark, sf):
    """Shares and slices come from the report; the shares have a query of their own."""
    return error_report(_predicted(spark, sf), "label", _SLICED)[1]


@query(
    "dropped_rows",
    f"""WITH {s.SCORED_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE score >= 0.1) AS n_scored,
       count(*) FILTER (WHERE score < 0.1) AS n_dropped,
       round(count(*) FILTER (WHERE score < 0.1) / count(*) * 100, 9) AS perc_dropped FROM scored""",
)
def dropped_rows(spark, sf):
    rows = s.scored(spark, sf)
    audit = metrics.dropped_rows(rows, rows.filter(F.col("score") >= 0.1))
    return audit.withColumn("perc_dropped", r9("perc_dropped"))


@query(
    "unscored_rows",
    f"WITH {s.SCORED_SQL}\nSELECT o_orderkey FROM scored WHERE score < 0.1",
)
def unscored_rows(spark, sf):
    rows = s.scored(spark, sf)
    missing = metrics.unscored(rows, rows.filter(F.col("score") >= 0.1), ["o_orderkey"])
    return missing.select("o_orderkey")
