"""Confusion counts, scores, threshold tables and score curves, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.functions.scalars import Col, as_col, f_beta, ratio
from delaykit.operators.lookup import null_safe_join
from delaykit.operators.ranks import running_totals

SCORES = ["precision", "recall", "f05", "f1", "accuracy"]


def confusion_columns(label: Col, prediction: Col) -> dict[str, Column]:
    y, p = as_col(label), as_col(prediction).cast("double")
    return {
        "tp": F.count_if((y == 1) & (p == 1)),
        "tn": F.count_if((y == 0) & (p == 0)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
    }


def score_columns() -> dict[str, Column]:
    """Scores from tp, tn, fp, fn; 0 where a score is undefined."""
    precision = ratio("tp", F.col("tp") + F.col("fp"))
    recall = ratio("tp", F.col("tp") + F.col("fn"))
    return {
        "precision": precision,
        "recall": recall,
        "f05": f_beta(0.5, precision, recall),
        "f1": f_beta(1.0, precision, recall),
        "accuracy": ratio(
            F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
        ),
    }


def confusion_metrics(
    df: DataFrame, label: Col, prediction: Col = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and scores, over everything or per key."""
    counts = [c.alias(n) for n, c in confusion_columns(label, prediction).items()]
    grouped = df.groupBy(*keys).agg(*counts) if keys else df.agg(*counts)
    return grouped.withColumns(score_columns())


def threshold_table(
    df: DataFrame,
    label: str,
    score: Col,
    thresholds: Sequence[float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and scores for every threshold (prediction = score > threshold).

    A row is counted once, under the number of thresholds it exceeds; the few counts are
    then added up per threshold.
    """
    keys = list(keys)
    cuts = sorted(set(float(t) for t in thresholds))
    s, y = as_col(score), F.col(label)
    passed = sum((F.when(s > t, 1).otherwise(0) for t in cuts), F.lit(0))
    counted = df.filter(s.isNotNull()).groupBy(*keys, passed.alias("__passed")).agg(
        F.count_if(y == 1).alias("__pos"), F.count_if(y == 0).alias("__neg")
    )
    levels = F.array(
        *[F.struct(F.lit(t).alias("threshold"), F.lit(i).alias("i")) for i, t in enumerate(cuts)]
    )
    spread = counted.withColumn("__level", F.explode(levels)).withColumn(
        "__hit", F.col("__passed") > F.col("__level.i")
    )
    sums = spread.groupBy(*keys, F.col("__level.threshold").alias("threshold")).agg(
        F.sum(F.when(F.col("__hit"), F.col("__pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(~F.col("__hit"), F.col("__neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(F.col("__hit"), F.col("__neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~F.col("__hit"), F.col("__pos")).otherwise(0)).alias("fn"),
    )
    return sums.withColumns(score_columns())


def best_threshold(table: DataFrame, by: str = "f05") -> DataFrame:
    """Row with the highest score; the lowest threshold wins a tie."""
    return table.orderBy(F.desc(by), F.asc("threshold")).limit(1)


def _score_totals(df: DataFrame, label: str, score: str, keys: Sequence[str], neighbours: bool = False) -> DataFrame:
    """Running totals of both labels over the distinct scores."""
    y = F.col(label)
    return running_totals(
        df.filter(F.col(score).isNotNull() & y.isin(0, 1)).select(*keys, label, score),
        score,
        {"pos": (y == 1).cast("long"), "neg": (y == 0).cast("long")},
        keys=keys,
        neighbours=neighbours,
    )


def _curve_points(totals: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    counts = totals.select(
        *keys,
        F.col(score).alias("threshold"),
        (F.col("pos_all") - F.col("pos_before")).alias("tp"),
        F.col("neg_before").alias("tn"),
        (F.col("neg_all") - F.col("neg_before")).alias("fp"),
        F.col("pos_before").alias("fn"),
    )
    return (
        counts.withColumn("fpr", ratio("fp", F.col("fp") + F.col("tn")))
        .withColumns(score_columns())
        .withColumn("tpr", F.col("recall"))
    )


def score_curve(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = ()
) -> DataFrame:
    """ROC and precision-recall points: one row per distinct score (prediction = score >= it).

    Rows with equal scores are counted before anything is ordered, and the prefix sums run
    in parallel, so neither the scores nor the curve pass through one place.
    """
    return _curve_points(_score_totals(df, label, score, list(keys)), score, list(keys))


def compact_curve(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = ()
) -> DataFrame:
    """:func:`score_curve` without the points that lie on the straight line between their
    neighbours on the ROC curve; the area below it does not change.

    A point stays if the step that leads to it (the rows at its score) and the step behind it (the
    rows at the next smaller score) have different slopes, compared as products of counts. The
    last point, (1, 1), stays.
    """
    totals = _score_totals(df, label, score, list(keys), neighbours=True)
    turns = F.col("pos") * F.col("neg_below") != F.col("neg") * F.col("pos_below")
    return _curve_points(totals.filter(F.coalesce(turns, F.lit(True))), score, list(keys))


def thinned_curve(curve: DataFrame, step: int, keys: Sequence[str] = ()) -> DataFrame:
    """Every ``step``-th point of a curve, from the smallest threshold on. Places are prefix sums
    over buckets, so no window holds the curve."""
    places = running_totals(
        curve.select(*keys, "threshold"), "threshold", {"__n": F.lit(1)}, keys=list(keys)
    )
    wanted = places.filter(F.col("__n_before") % step == 0).select(*keys, "threshold")
    return null_safe_join(curve, wanted, [*keys, "threshold"]) if keys else curve.join(wanted, "threshold")


def curve_area(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, area): area below the ROC points of a curve and (0, 0), by trapezoids."""
    steps = running_totals(
        curve.select(*keys, "threshold", "tp", "fp"), "threshold", {"tp": F.col("tp"), "fp": F.col("fp")}, keys=list(keys), neighbours=True
    )
    # tp and fp fall as the threshold grows: the point below a threshold lies further on the curve
    own = (F.col("tp_below") + F.col("tp")) * (F.col("fp_below") - F.col("fp"))
    ends = [F.max("tp").alias("__pos"), F.max("fp").alias("__neg"), F.min(F.struct("fp", "tp")).alias("__first")]
    grouped = (steps.groupBy(*keys) if keys else steps).agg(F.coalesce(F.sum(own), F.lit(0)).alias("__twice"), *ends)
    twice = F.col("__twice") + F.col("__first.tp") * F.col("__first.fp")
    return grouped.select(*keys, ratio(twice, 2 * F.col("__pos") * F.col("__neg")).alias("area"))


def area_under_roc(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in the right
    order, ties counting half. It needs the counts per distinct score, not the pairs."""
    keys = list(keys)
    y = F.col(label)
    totals = running_totals(
        df.filter(F.col(score).isNotNull() & y.isNotNull()).select(*keys, label, score),
        score,
        {"pos": (y == 1).cast("long"), "neg": (y == 0).cast("long")},
        keys=keys,
    )
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    grouped = totals.groupBy(*keys) if keys else totals
    return grouped.agg(
        F.sum(won).alias("__won"),
        F.max("pos_all").alias("n_pos"),
        F.max("neg_all").alias("n_neg"),
    ).select(
        *keys,
        "n_pos",
        "n_neg",
        F.try_divide(
            F.col("__won"), F.col("n_pos").cast("double") * F.col("n_neg")
        ).alias("auc"),
    )


def vote_columns(predictions: Sequence[str]) -> dict[str, Column]:
    """Total, mean and the three vote rules over 0/1 prediction columns."""
    from delaykit.functions.scalars import add_up

    total = add_up(predictions)
    mean = total / len(predictions)
    return {
        "total_pred": total,
        "avg_pred": mean,
        "vote_majority": (mean > 0.5).cast("double"),
        "vote_any": (mean > 0).cast("double"),
        "vote_all": (mean == 1).cast("double"),
    }


def compare_predictions(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Scores of several 0/1 prediction columns side by side, from one pass.

    Rows are first counted per combination of label and predictions, at most 2^(k+1) of
    them; only these counts are spread over the columns.
    """
    counted = df.groupBy(label, *columns).agg(F.count(F.lit(1)).alias("__n"))
    long = counted.select(
        F.col(label).alias("__y"),
        "__n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("p"))
                    for c in columns
                ]
            )
        ).alias("v"),
    )
    n = F.col("__n")
    part = lambda y, p: F.coalesce(
        F.sum(F.when((F.col("__y") == y) & (F.col("v.p") == p), n)), F.lit(0)
    )
    return (
        long.groupBy(F.col("v.model").alias("model"))
        .agg(
            part(1, 1).alias("tp"),
            part(0, 0).alias("tn"),
            part(0, 1).alias("fp"),
            part(1, 0).alias("fn"),
        )
        .withColumns(score_columns())
    )


def join_predictions(
    frames: dict[str, DataFrame], keys: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    """Predictions of several models side by side; rows that all of them scored.

    Keys stay the same through the chain, so the joins share one partitioning.
    """
    joined: DataFrame | None = None
    for name, frame in frames.items():
        part = frame.select(*keys, F.col(prediction).alias(f"{name}_prediction"))
        joined = part if joined is None else joined.join(part, list(keys))
    if joined is None:
        raise ValueError("no predictions given")
    return joined


def result_type(label: str, prediction: str) -> Column:
    """tp / tn / fp / fn of one row."""
    y, p = F.col(label), F.col(prediction).cast("double")
    return (
        F.when((y == 1) & (p == 1), "tp")
        .when((y == 0) & (p == 0), "tn")
        .when((y == 0) & (p == 1), "fp")
        .when((y == 1) & (p == 0), "fn")
    )


def with_result(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Add r_type and the four 0/1 marks r_tp, r_tn, r_fp, r_fn."""
    typed = df.withColumn("r_type", result_type(label, prediction))
    return typed.withColumns(
        {f"r_{k}": F.coalesce((F.col("r_type") == k).cast("int"), F.lit(0))
         for k in ("tp", "tn", "fp", "fn")}
    )


def result_shares(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows and percentage per result type."""
    counts = df.groupBy(result_type(label, prediction).alias("r_type")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return counts.withColumn(
        "percentage", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()) * 100
    )


def error_slices(
    df: DataFrame, label: str, prediction: str, features: Sequence[str]
) -> DataFrame:
    """Rows per (feature, value, result type), all features from one pass."""
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
            for f in features
        ]
    )
    return (
        df.select(result_type(label, prediction).alias("r_type"), F.explode(cells).alias("c"))
        .groupBy("c.feature", "c.value", "r_type")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def dropped_rows(full: DataFrame, scored: DataFrame) -> DataFrame:
    """How many rows were never scored, by count alone."""
    counts = full.agg(F.count(F.lit(1)).alias("n_rows"))
    scored_rows = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("n_scored", scored_rows).select(
        "n_rows",
        "n_scored",
        (F.col("n_rows") - F.col("n_scored")).alias("n_dropped"),
        (ratio(F.col("n_rows") - F.col("n_scored"), "n_rows") * 100).alias("perc_dropped"),
    )


def unscored(full: DataFrame, scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that were never scored."""
    return full.join(scored.select(*keys), list(keys), "left_anti")
