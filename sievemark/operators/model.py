"""The quality classifier with Spark ML: training, cross-validation, scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.operators.metrics import auc, eval_metrics
from sievemark.operators.scores import rating_band
from sievemark.operators.splits import class_sizes
from sievemark.session import small_frame


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (2 * n_class) per row; rows without a label are a class."""
    sizes = class_sizes(df, label)
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for value, k in sizes.items():
        weight = F.when(col(label).eqNullSafe(F.lit(value)), F.lit(n / (2.0 * k))).otherwise(weight)
    return df.withColumn(name, weight)


def positive_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, as boosted trees weigh the positive class."""
    y = col(label)
    return df.agg(F.try_divide(F.count_if(y == 0), F.count_if(y == 1)).alias("scale_pos_weight"))


def preparation(features: Sequence[str], impute: str = "median", scale: bool = False) -> list:
    """Stages that fill, gather and scale features, fitted on the training rows only."""
    filled = [f"{f}__filled" for f in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=filled, strategy=impute),
        VectorAssembler(inputCols=filled, outputCol="assembled" if scale else "features"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True))
    return stages


def classifier(kind: str, label: str = "label", weight: str | None = None, seed: int = 42, **settings):
    """A configured estimator; settings override the fixed defaults."""
    if kind == "forest":
        base = dict(numTrees=100, maxDepth=15, minInstancesPerNode=2, seed=seed)
        make = RandomForestClassifier
    elif kind == "boosted":
        base = dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
        make = GBTClassifier
    elif kind == "logistic":
        base = dict(regParam=0.1, maxIter=200)
        make = LogisticRegression
    elif kind == "single":
        base = dict(maxDepth=3, seed=seed)
        make = DecisionTreeClassifier
    else:
        raise ValueError(f"unknown classifier {kind!r}")
    base.update(settings)
    if weight:
        base["weightCol"] = weight
    return make(labelCol=label, featuresCol="features", **base)


def train(
    df: DataFrame, features: Sequence[str], kind: str = "forest", label: str = "label",
    balanced: bool = True, scale: bool = False, impute: str = "median", **settings,
) -> PipelineModel:
    weight = "weight" if balanced else None
    data = with_class_weight(df, label) if balanced else df
    steps = preparation(features, impute, scale or kind == "logistic")
    return Pipeline(stages=[*steps, classifier(kind, label, weight, **settings)]).fit(data)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """quality, score (confidence in %, 1 decimal) and both class probabilities."""
    p = vector_to_array("probability")
    good = F.col("prediction") == 1
    out = model.transform(df)
    return out.select(
        *[col(k) for k in keep],
        F.when(good, "GOOD").otherwise("BAD").alias("quality"),
        F.bround(F.when(good, p[1]).otherwise(p[0]) * 100, 1).alias("score"),
        F.bround(p[1], 4).alias("probability_good"), F.bround(p[0], 4).alias("probability_bad"),
    )


def score_pct(probability_good: Column) -> Column:
    """Whole-number quality from 0 to 100."""
    return F.floor(probability_good * 100).cast("int")


def quality_report(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    pct = score_pct(F.col("probability_good"))
    return scored.select(
        *[col(k) for k in keep], pct.alias("quality_score"), rating_band(pct).alias("rating"),
        "probability_good", "probability_bad",
    )


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label") -> dict[str, float]:
    """All six metrics of a model on labelled rows."""
    scored = model.transform(df).select(
        col(label).alias("y"), F.col("prediction").alias("p"), vector_to_array("probability")[1].alias("s")
    ).persist()
    found = eval_metrics(scored, "y", "p").first().asDict()
    found["auc_roc"] = auc(scored, "y", "s").first()["auc_roc"] or 0.0
    scored.unpersist()
    return found


def cross_validate(
    folded: DataFrame, features: Sequence[str], kind: str = "forest", label: str = "label", **settings
) -> DataFrame:
    """(fold, metrics...) from a table that carries its ``fold`` column."""
    folds = [r["fold"] for r in folded.select("fold").distinct().orderBy("fold").collect()]
    rows = []
    names = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "auc_roc")
    for fold in folds:
        model = train(folded.filter(F.col("fold") != fold), features, kind, label, **settings)
        m = evaluate(model, folded.filter(F.col("fold") == fold), label)
        rows.append((int(fold), *[float(m[n]) for n in names]))
    return small_frame(folded.sparkSession, rows, "fold int, " + ", ".join(f"{n} double" for n in names))


def cross_validation_summary(per_fold: DataFrame) -> DataFrame:
    """(metric, mean, std) over the folds."""
    names = [c for c in per_fold.columns if c != "fold"]
    return per_fold.unpivot([], names, "metric", "value").groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def learning_curve(
    train_df: DataFrame, test_df: DataFrame, features: Sequence[str], key: Sequence[str],
    fractions: Sequence[float] = tuple(i / 10 for i in range(1, 11)), kind: str = "forest",
    label: str = "label", **settings,
) -> DataFrame:
    """(fraction, train_accuracy, test_accuracy) at growing training sizes."""
    from sievemark.operators.splits import sample_frac

    rows = []
    for f in fractions:
        part = sample_frac(train_df, f, key)
        model = train(part, features, kind, label, **settings)
        rows.append((
            float(f), float(evaluate(model, part, label)["accuracy"]),
            float(evaluate(model, test_df, label)["accuracy"]),
        ))
    return small_frame(train_df.sparkSession, rows, "fraction double, train_accuracy double, test_accuracy double")


def sweep(
    train_df: DataFrame, test_df: DataFrame, features: Sequence[str], kind: str,
    grid: Sequence[Mapping[str, object]], label: str = "label",
) -> DataFrame:
    """(setting, metrics...) of one classifier kind over a small grid."""
    names = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "auc_roc")
    rows = []
    for settings in grid:
        m = evaluate(train(train_df, features, kind, label, **settings), test_df, label)
        rows.append((", ".join(f"{k}={v}" for k, v in settings.items()), *[float(m[n]) for n in names]))
    return small_frame(train_df.sparkSession, rows, "setting string, " + ", ".join(f"{n} double" for n in names))


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(rank, feature, importance, cumulative), largest first; one row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(features, map(float, values)), key=lambda p: (-p[1], p[0]))
    rows, total = [], 0.0
    for i, (name, v) in enumerate(ranked, 1):
        total += v
        rows.append((i, name, v, total))
    from pyspark.sql import SparkSession

    return small_frame(
        SparkSession.active(), rows, "rank int, feature string, importance double, cumulative double"
    )


def batch_summary(scored: DataFrame) -> DataFrame:
    """Datasets, share judged GOOD and mean confidence."""
    return scored.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.avg((F.col("quality") == "GOOD").cast("int")).alias("good_share"),
        F.avg("score").alias("mean_confidence"),
    )
