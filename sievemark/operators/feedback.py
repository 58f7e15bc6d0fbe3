"""The feedback table: gate, cap, training view, trimming, health, retrain history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of the feedback loop.
LOW_SCORE, HIGH_SCORE = 50, 70
PER_DATASET = 3
FEATURE_COUNT = 8
KEEP_LAST = 500
RETRAIN_EVERY, RETRAIN_EVERY_DEMO = 20, 5


def feedback_gate(score: Column, label: Column) -> tuple[Column, Column]:
    """(accepted, reason): only feedback that contradicts the model teaches it anything."""
    under = (label >= 2) & (score < LOW_SCORE)
    over = (label == 0) & (score > HIGH_SCORE)
    reason = (
        F.when(label == 1, "neutral").when(under, "underestimated").when(over, "overestimated")
        .otherwise("aligned")
    )
    return under | over, reason


def gate_table(df: DataFrame) -> DataFrame:
    """Rows of (id, dataset_hash, predicted_score, actual_label, ...) with the verdict."""
    accepted, reason = feedback_gate(F.col("predicted_score"), F.col("actual_label"))
    return df.withColumns({"is_quality_gated": accepted.cast("int"), "reason": reason})


def feedback_cap(df: DataFrame, most: int = PER_DATASET) -> DataFrame:
    """The first accepted rows per dataset; each task keeps ``most`` rows per dataset."""
    order = Window.partitionBy("dataset_hash").orderBy("timestamp", "id")
    return df.filter("is_quality_gated = 1").withColumn("_n", F.row_number().over(order)).filter(
        F.col("_n") <= most
    ).drop("_n")


def feedback_per_dataset(df: DataFrame) -> DataFrame:
    return df.filter("is_quality_gated = 1").groupBy("dataset_hash").agg(F.count(F.lit(1)).alias("count"))


def with_dataset_count(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New rows with how many accepted rows their dataset already has."""
    return new.join(feedback_per_dataset(stored), "dataset_hash", "left").withColumn(
        "existing", F.coalesce("count", F.lit(0))
    ).drop("count")


def feedback_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def parsed_features(df: DataFrame) -> DataFrame:
    return df.withColumn("feature_values", F.from_json("features", "array<double>"))


def _valid() -> Column:
    v = F.col("feature_values")
    return F.coalesce((F.size(v) == FEATURE_COUNT) & ~F.exists(v, lambda x: x.isNull()), F.lit(False))


def feedback_train(df: DataFrame, last: int | None = None) -> DataFrame:
    """(id, feature_values, label) of rows with exactly eight features."""
    rows = parsed_features(df).filter(_valid()).select(
        "id", "feature_values", (F.col("actual_label") >= 2).cast("int").alias("label")
    )
    return rows.orderBy(F.desc("id")).limit(last) if last else rows


def feedback_trim(df: DataFrame, keep_last: int = KEEP_LAST) -> DataFrame:
    """The newest rows by id."""
    return df.orderBy(F.desc("id")).limit(keep_last)


def feedback_health(df: DataFrame) -> DataFrame:
    valid = F.count_if(_valid())
    total = F.count(F.lit(1))
    row = parsed_features(df).agg(total.alias("total_feedbacks"), valid.alias("valid_with_features"))
    pct = F.coalesce(F.try_divide(F.col("valid_with_features") * 100.0, F.col("total_feedbacks")), F.lit(100.0))
    return row.select(
        "total_feedbacks", "valid_with_features",
        (F.col("total_feedbacks") - F.col("valid_with_features")).alias("invalid_features"),
        F.bround(pct, 1).alias("health_percentage"),
        F.when(F.col("total_feedbacks") == 0, "no_data").when(pct > 90, "healthy")
        .when(pct > 70, "degraded").otherwise("poor").alias("status"),
    )


def retrain_due(count: Column, every: int = RETRAIN_EVERY) -> Column:
    return (count >= every) & (count % every == 0)


def until_retrain(count: Column, every: int = RETRAIN_EVERY) -> Column:
    return every - count % every


def retrain_points(df: DataFrame, every: int = RETRAIN_EVERY) -> DataFrame:
    """Rows numbered by id with the retrain flag they would have raised."""
    from sievemark.operators.order import with_row_id

    n = F.col("_row_id")
    return with_row_id(df, ["id"]).select(
        "id", n.alias("feedback_count"), retrain_due(n, every).alias("retrain"),
        until_retrain(n, every).alias("next_retrain_in"),
    )


def latest(df: DataFrame, by: str, n: int) -> DataFrame:
    """Newest n records; every task keeps only n."""
    return df.orderBy(F.desc(by)).limit(n)


def history_stats(log: DataFrame) -> DataFrame:
    """Runs, latest score, change against the first and against the previous run in %."""
    newest = F.max_by("cv_score", "timestamp")
    oldest = F.min_by("cv_score", "timestamp")
    pct = lambda now, was: F.when(was > 0, (now - was) / was * 100)
    whole = log.agg(
        F.count(F.lit(1)).alias("runs"), newest.alias("latest_score"), F.max("timestamp").alias("latest_at"),
        F.when(F.count(F.lit(1)) > 1, pct(newest, oldest)).alias("improvement_pct"),
    )
    two = log.orderBy(F.desc("timestamp")).limit(2).agg(
        F.min_by("cv_score", "timestamp").alias("previous_score"), F.count(F.lit(1)).alias("_n")
    ).select(F.when(F.col("_n") == 2, F.col("previous_score")).alias("previous_score"))
    both = whole.unionByName(two, allowMissingColumns=True).agg(*[
        F.max(c).alias(c) for c in ("runs", "latest_score", "latest_at", "improvement_pct", "previous_score")
    ])
    return both.withColumn("step_pct", pct(F.col("latest_score"), F.col("previous_score")))
