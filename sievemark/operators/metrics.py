"""Classifier metrics as aggregates over (label, prediction, score) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.operators.order import running_totals, with_row_id
from sievemark.session import small_frame

# How much better a candidate must be, and how much worse it may not be.
IMPROVED, DEGRADED = 0.02, -0.01
COMPARED = ("f1", "balanced_accuracy", "auc_roc")


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp, one row or one per group."""
    y, p = col(label), col(prediction)
    return df.groupBy(*[col(b) for b in by]).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, precision, recall, support) for both classes."""
    from sievemark.operators.reshape import one_row_to_long

    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return one_row_to_long(confusion(df, label, prediction), [
        {"class": F.lit(0), "precision": zero(tn, tn + fn), "recall": zero(tn, tn + fp), "support": tn + fp},
        {"class": F.lit(1), "precision": zero(tp, tp + fp), "recall": zero(tp, tp + fn), "support": tp + fn},
    ])


def _rates(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = zero(tp, tp + fp), zero(tp, tp + fn)
    return frame.select(
        *keep,
        zero(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        ((recall + zero(tn, tn + fp)) / 2).alias("balanced_accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        zero(2 * precision * recall, precision + recall).alias("f1"),
    )


def eval_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall and F1; zero where undefined."""
    return _rates(confusion(df, label, prediction, by), list(by))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, fpr, tpr) at every distinct score, highest first.

    Rows are grouped by score before anything is ordered, and the cumulative counts run
    over bounded buckets of the distinct scores.
    """
    y = col(label)
    grouped = df.groupBy(col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    run = running_totals(with_row_id(grouped, [F.desc("score")]), {"tp": "pos", "fp": "neg"})
    totals = df.agg(F.count_if(y == 1).alias("all_pos"), F.count_if(y == 0).alias("all_neg")).first()
    pos, neg = F.lit(totals["all_pos"]), F.lit(totals["all_neg"])
    return run.select(
        "_row_id", "score", "pos", "neg", F.try_divide(F.col("fp"), neg).alias("fpr"),
        F.try_divide(F.col("tp"), pos).alias("tpr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve: each step adds its width times its mean height."""
    points = roc_points(df, label, score)
    totals = df.agg(
        F.count_if(col(label) == 1).alias("p"), F.count_if(col(label) == 0).alias("n")
    ).first()
    width = F.try_divide(F.col("neg"), F.lit(totals["n"]))
    rise = F.try_divide(F.col("pos"), F.lit(totals["p"]))
    return points.agg(F.sum(width * (F.col("tpr") - rise / 2)).alias("auc_roc"))


def promotion(current: dict[str, float], candidate: dict[str, float], spark) -> DataFrame:
    """One row: metric changes, and whether the candidate may replace the model."""
    row = small_frame(
        spark, [tuple(float(m[k]) for m in (current, candidate) for k in COMPARED)],
        ", ".join(f"{w}_{k} double" for w in ("current", "candidate") for k in COMPARED),
    )
    return promote_frame(row)


def promote_frame(frame: DataFrame) -> DataFrame:
    """``promotion`` over rows with current_* and candidate_* columns."""
    delta = {k: F.col(f"candidate_{k}") - F.col(f"current_{k}") for k in COMPARED}
    count = lambda test: sum((F.when(test(d), 1).otherwise(0) for d in delta.values()), F.lit(0))
    improved: Column = count(lambda d: d > IMPROVED)
    degraded: Column = count(lambda d: d < DEGRADED)
    others = [c for c in frame.columns if not c.startswith(("current_", "candidate_"))]
    return frame.select(
        *others,
        *[d.alias(f"{k}_delta") for k, d in delta.items()],
        improved.alias("metrics_improved"), degraded.alias("metrics_degraded"),
        ((improved >= 2) & (degraded == 0)).alias("promoted"),
        F.when((improved >= 2) & (degraded == 0), "improved")
        .when(degraded > 0, "degraded").otherwise("insufficient").alias("reason"),
    )
