"""Aggregates of a number by a category, and their top-N forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.operators.categorical import top_values


def keep_top_categories(df: DataFrame, category: str, k: int) -> DataFrame:
    """Rows whose category is among the k most frequent; k rows are broadcast."""
    top = top_values(df, category, k).select(F.col("value").alias(category))
    return df.join(F.broadcast(top), category, "left_semi")


def group_mean_top(df: DataFrame, category: str, number: str, k: int = 10) -> DataFrame:
    """Mean, deviation and count per category for the k most frequent categories.

    The whole table is aggregated once; the frequency that picks the categories is a
    by-product of the same aggregate, so no join back to the rows is needed.
    """
    x = col(number).cast("double")
    grouped = df.filter(col(category).isNotNull()).groupBy(col(category).alias("category")).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.count(x).alias("count"),
    )
    return grouped.orderBy(F.desc("frequency"), F.asc("category")).limit(k)


def reindex_by_frequency(df: DataFrame, category: str, grouped: DataFrame, k: int) -> DataFrame:
    """Bring per-category results into frequency order, keeping categories without one."""
    top = top_values(df, category, k).select(
        F.col("value").alias("category"), F.col("count").alias("frequency")
    )
    return top.join(grouped, "category", "left").orderBy(F.desc("frequency"), F.asc("category"))


def group_mean_nlargest(df: DataFrame, x: str, y: str, k: int = 20) -> DataFrame:
    """Mean of y per x; beyond k groups only those with the largest means remain."""
    rows = df.select(col(x).alias("x"), col(y).try_cast("double").alias("y")).na.drop()
    return rows.groupBy("x").agg(F.avg("y").alias("mean")).orderBy(
        F.desc("mean"), F.asc("x")
    ).limit(k)


def other_bucket(df: DataFrame, column: str, k: int = 8) -> DataFrame:
    """The k most frequent values and one ``Other`` row with the rest, with shares.

    Other is the total minus the top, so only k counted rows reach the last step.
    """
    counts = df.filter(col(column).isNotNull()).groupBy(
        col(column).cast("string").alias("value")
    ).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("value")).limit(k)
    rest = (
        counts.select("count").unionByName(top.select((-F.col("count")).alias("count")))
        .agg(F.sum("count").alias("count"))
        .select(F.lit("Other").alias("value"), "count")
        .filter(F.col("count") > 0)
    )
    whole = Window.partitionBy()  # over at most k + 1 rows
    return top.unionByName(rest).withColumn("share", F.col("count") / F.sum("count").over(whole))


def class_distribution(df: DataFrame, split: str, label: str) -> DataFrame:
    """Label counts and their share inside each split."""
    counts = df.groupBy(col(split).alias("split"), col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    whole = Window.partitionBy("split")  # over the few (split, label) counts, not the rows
    return counts.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(whole))


def model_compare(scores: DataFrame, model: str, metric: str, value: str) -> DataFrame:
    """Mean and deviation of each metric per model, and the winner per metric."""
    per_model = scores.groupBy(col(metric).alias("metric"), col(model).alias("model")).agg(
        F.avg(col(value)).alias("mean"), F.stddev_samp(col(value)).alias("std")
    )
    best = per_model.groupBy("metric").agg(
        F.min(F.struct((-F.col("mean")).alias("neg"), "model")).alias("b")
    ).select("metric", F.col("b.model").alias("winner"))
    return per_model.join(best, "metric")
