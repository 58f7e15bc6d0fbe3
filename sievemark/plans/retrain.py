"""Stack feedback on the base features, train, compare, promote, log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.operators.feedback import feedback_cap, feedback_train, feedback_trim
from sievemark.operators.metrics import promotion
from sievemark.operators.model import cross_validate, cross_validation_summary, evaluate, score, train
from sievemark.operators.splits import kfold_stratified
from sievemark.session import materialize, small_frame
from sievemark.sources.readers import RETRAIN_LOG_SCHEMA
from sievemark.sources.sinks import sink_append_log

MIN_SAMPLES, MIN_SAMPLES_DEMO = 20, 5


@dataclass(frozen=True)
class Retrained:
    model: PipelineModel
    decision: DataFrame
    promoted: bool


def stack_feedback(base: DataFrame, feedback: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Base rows and feedback vectors in one table with a key for folds."""
    spread = feedback.select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("sample_id"),
        *[F.element_at("feature_values", i + 1).alias(f) for i, f in enumerate(features)],
        F.col("label").cast("int").alias(label),
    )
    return base.select("sample_id", *features, F.col(label).cast("int").alias(label)).unionByName(spread)


def save_version(model: PipelineModel, root: str) -> str:
    """Save a model beside the earlier ones; it is current once its line in the log is written, with a number over all before."""
    spark = SparkSession.active()
    path = f"{root}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    known = _versions(spark, root)
    number = (known.agg(F.max("version")).first()[0] or 0) + 1 if known is not None else 1
    line = small_frame(spark, [(path, number)], "path string, version bigint").withColumn("saved_at", F.current_timestamp().cast("string"))
    line.write.mode("append").json(f"{root}/versions")
    return path


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema("path string, version bigint, saved_at string").json(f"{root}/versions")
    except AnalysisException:  # no model yet
        return None


def current_model(spark: SparkSession, root: str) -> PipelineModel | None:
    """The model saved last, or none; of two drivers that saved at once the later one."""
    versions = _versions(spark, root)
    newest = versions.orderBy(F.desc("version"), F.desc("saved_at"), "path").first() if versions is not None else None
    return PipelineModel.load(newest["path"]) if newest else None


def score_stored(df: DataFrame, root: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows scored by the current model of a folder."""
    model = current_model(df.sparkSession, root)
    if model is None:
        raise ValueError(f"no model in {root}")
    return score(model, df, keep)


def on_feedback(
    base: DataFrame, holdout: DataFrame, features: Sequence[str], model_path: str, log_path: str, **settings,
) -> Callable[[DataFrame], None]:
    """What ``stream_feedback`` calls when a retrain is due: cap, trim, train, compare, promote."""

    def run(stored: DataFrame) -> None:
        usable = feedback_train(feedback_trim(feedback_cap(stored)))
        retrain(base, usable, holdout, features, current_model(base.sparkSession, model_path), model_path, log_path, **settings)

    return run


def retrain(
    base: DataFrame, feedback: DataFrame, holdout: DataFrame, features: Sequence[str],
    current: PipelineModel | None, model_path: str, log_path: str,
    label: str = "label", folds: int = 5, min_samples: int = MIN_SAMPLES, kind: str = "forest", **settings,
) -> Retrained:
    """Train a candidate and make it the current model only if the holdout says so.

    ``model_path`` is a folder of versions: the model in use stays whole until the next is complete.
    """
    spark = base.sparkSession
    feedback = materialize(feedback, "feedback")  # the store may grow meanwhile
    stacked = materialize(stack_feedback(base, feedback, features, label), "training")
    n, n_feedback = stacked.count(), feedback.count()
    if n < min_samples:
        raise ValueError(f"{n} samples, at least {min_samples} needed")
    per_fold = cross_validate(
        materialize(kfold_stratified(stacked, label, ["sample_id"], folds), "folds"), features, kind, label, **settings
    )
    cv = cross_validation_summary(per_fold).filter("metric = 'balanced_accuracy'").first()["mean"]
    candidate = train(stacked, features, kind, label, **settings)
    theirs = evaluate(candidate, holdout, label)
    ours = evaluate(current, holdout, label) if current else {k: 0.0 for k in theirs}
    decision = promotion(ours, theirs, spark)
    verdict = decision.first()
    promoted = current is None or verdict["promoted"]
    if promoted:
        save_version(candidate, model_path)
    entry = small_frame(spark, [(
        None, float(cv), n_feedback, n, kind, "promoted" if promoted else "archived", promoted, verdict["reason"],
        [(k, verdict[k]) for k in ("f1_delta", "balanced_accuracy_delta", "auc_roc_delta")],
    )], RETRAIN_LOG_SCHEMA).withColumn("timestamp", F.current_timestamp().cast("string"))
    sink_append_log(entry, log_path)
    return Retrained(candidate, decision, promoted)
