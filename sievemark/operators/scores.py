"""Dataset scores: completeness, consistency, uniqueness, outliers, and their blend."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.functions.casts import number_prefix
from sievemark.operators.dedup import duplicate_counts
from sievemark.operators.outliers import pooled_outlier_ratio
from sievemark.operators.profile import missing_summary, numeric_pairs
from sievemark.operators.reshape import as_pairs


@dataclass(frozen=True)
class ScoringProfile:
    """Caps and weights of the dataset scores."""

    cap: float = 0.99
    untyped: float = 0.95
    accuracy: float = 0.99
    weight_completeness: float = 0.25
    weight_consistency: float = 0.25
    weight_accuracy: float = 0.20
    weight_duplicates: float = 0.15
    weight_outliers: float = 0.15


DEFAULT = ScoringProfile()


def score_completeness(df: DataFrame, profile: ScoringProfile = DEFAULT) -> DataFrame:
    m = missing_summary(df)
    raw = 1 - F.col("ratio")
    return m.select(
        F.coalesce(raw, F.lit(0.0)).alias("raw"),
        F.least(F.coalesce(raw, F.lit(0.0)), F.lit(profile.cap)).alias("completeness"),
    )


def score_uniqueness(df: DataFrame, profile: ScoringProfile = DEFAULT) -> DataFrame:
    raw = F.when(F.col("rows") > 0, 1 - F.col("duplicate_ratio")).otherwise(F.lit(0.0))
    return duplicate_counts(df).select(
        raw.alias("raw"), F.least(raw, F.lit(profile.cap)).alias("uniqueness")
    )


def score_outliers(
    df: DataFrame, profile: ScoringProfile = DEFAULT
) -> DataFrame:
    raw = 1 - F.col("ratio")
    return pooled_outlier_ratio(df).select(
        raw.alias("raw"),
        F.coalesce(F.least(raw, F.lit(profile.cap)), F.lit(profile.untyped)).alias("outlier_score"),
    )


def score_confidence(
    df: DataFrame, profile: ScoringProfile = DEFAULT
) -> DataFrame:
    """All scores of a typed table and their weighted blend, one row.

    Each score is one row, so they are stacked and folded by name rather than joined.
    """
    classes = column_classes(df)
    typed = bool(classes.numeric or classes.datetime)
    named = (
        score_completeness(df, profile).select(F.lit("c").alias("k"), F.col("completeness").alias("v"))
        .unionByName(score_uniqueness(df, profile).select(F.lit("d").alias("k"), F.col("uniqueness").alias("v")))
        .unionByName(score_outliers(df, profile).select(F.lit("o").alias("k"), F.col("outlier_score").alias("v")))
    )
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    row = named.agg(
        pick("c").alias("completeness"),
        F.lit(profile.cap if typed else profile.untyped).alias("consistency"),
        F.lit(profile.accuracy).alias("accuracy"),
        pick("d").alias("duplicates"),
        pick("o").alias("outliers"),
    )
    blend = (
        profile.weight_completeness * F.col("completeness")
        + profile.weight_consistency * F.col("consistency")
        + profile.weight_accuracy * F.col("accuracy")
        + profile.weight_duplicates * F.col("duplicates")
        + profile.weight_outliers * F.col("outliers")
    )
    return row.withColumn("confidence", F.bround(F.least(blend, F.lit(profile.cap)), 2))


def _label(pct: Column) -> Column:
    return (
        F.when(pct >= 95, "Excellent").when(pct >= 90, "Very Good").when(pct >= 80, "Good")
        .when(pct >= 70, "Fair").otherwise("Poor")
    )


def column_quality(df: DataFrame) -> DataFrame:
    """(column, complete, total, percentage, label) by non-blank values."""
    filled = F.col("value").isNotNull() & (F.trim("value") != "")
    counts = as_pairs(df, df.columns, "string").groupBy("column").agg(
        F.count_if(filled).alias("complete"), F.count(F.lit(1)).alias("total")
    )
    pct = F.col("complete") * 100.0 / F.col("total")
    return counts.select("column", "complete", "total", pct.alias("percentage"), _label(pct).alias("label"))


@dataclass(frozen=True)
class ViewerProfile:
    """Penalties of the table-quality figure."""

    numeric_share: float = 0.8
    outlier_weight: float = 50.0
    cardinality_free: float = 0.5
    cardinality_weight: float = 20.0
    cardinality_cap: float = 8.0
    column_floor: float = 70.0
    missing_factor: tuple[float, float] = (30.0, 0.92)
    outlier_factor: tuple[float, float] = (50.0, 0.97)
    cardinality_factor: tuple[float, float, float] = (0.4, 15.0, 0.93)
    consistency_factor: float = 0.98
    clamp: tuple[float, float] | None = (87.0, 96.0)


def table_quality(df: DataFrame, p: ViewerProfile = ViewerProfile()) -> DataFrame:
    """One row: columns, complete columns, raw and clamped quality of the table.

    Distinct texts are counted by a (column, value) grouping; means and deviations by a
    grouping over the parsed numbers. Both send one row per column to the last step.
    """
    texts = as_pairs(df, df.columns, "string")
    t = F.trim("value")
    filled = texts.select("column", F.when(t != "", F.lower(t)).alias("value"))
    freq = filled.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    x = number_prefix(F.col("value"))
    per = freq.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("filled"),
        F.count("value").alias("distinct"),
        F.coalesce(F.sum(F.when(x.isNotNull(), F.col("n"))), F.lit(0)).alias("numbers"),
        F.try_divide(F.sum(x * F.col("n")), F.sum(F.when(x.isNotNull(), F.col("n")))).alias("mean"),
    )
    stats = freq.join(F.broadcast(per), "column")
    dev = x - F.col("mean")
    spread = stats.groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(dev * dev * F.col("n")), F.max("numbers"))).alias("sd")
    )
    far = stats.join(F.broadcast(spread), "column").groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.abs(dev) > 3 * F.col("sd"), F.col("n"))), F.lit(0)).alias("far")
    )
    cols = per.join(F.broadcast(far), "column")
    is_num = (F.col("filled") > 0) & (F.col("numbers") / F.greatest("filled", F.lit(1)) > p.numeric_share)
    is_cat = (F.col("filled") > 0) & ~is_num
    out_ratio = F.try_divide(F.col("far"), F.col("numbers"))
    card = F.try_divide(F.col("distinct"), F.col("filled"))
    complete = F.col("filled") * 100.0 / F.col("rows")
    quality = F.greatest(
        complete
        - F.when(is_num, p.outlier_weight * out_ratio).otherwise(F.lit(0.0))
        - F.when(is_cat & (card > p.cardinality_free), F.least(
            (card - p.cardinality_free) * p.cardinality_weight, F.lit(p.cardinality_cap)
        )).otherwise(F.lit(0.0)),
        F.lit(p.column_floor),
    )
    table = cols.agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(F.col("filled") == F.col("rows")).alias("complete_columns"),
        F.avg(quality).alias("base"),
        F.avg(1 - F.col("filled") / F.col("rows")).alias("missing"),
        F.coalesce(F.avg(F.when(is_num, out_ratio)), F.lit(0.0)).alias("outliers"),
        F.coalesce(F.avg(F.when(is_cat, card)), F.lit(0.0)).alias("cardinality"),
    )
    free, weight, floor = p.cardinality_factor
    raw = (
        F.col("base")
        * F.greatest(1 - F.col("missing") * p.missing_factor[0], F.lit(p.missing_factor[1]))
        * F.greatest(1 - F.col("outliers") * p.outlier_factor[0], F.lit(p.outlier_factor[1]))
        * F.when(F.col("cardinality") > free,
                 F.greatest(1 - (F.col("cardinality") - free) * weight, F.lit(floor)))
        .otherwise(F.lit(1.0))
        * p.consistency_factor
    )
    final = F.least(F.greatest(raw, F.lit(p.clamp[0])), F.lit(p.clamp[1])) if p.clamp else raw
    return table.select("columns", "complete_columns", raw.alias("raw_quality"), final.alias("quality"))


# Target of each of the eight model features, and how it is read.
FEATURE_TARGETS = {
    "missing_ratio": 0.1,
    "duplicate_ratio": 0.05,
    "numeric_ratio": 0.5,
    "constant_cols": 0.0,
    "norm_variance": 2.0,
    "skewness": 1.0,
    "cardinality_ratio": 0.3,
    "mean_kurtosis": 3.0,
}
_LOWER_IS_BETTER = ("missing_ratio", "duplicate_ratio", "constant_cols")


def feature_radar(features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each feature as 0..1 against its target, long form (keep..., feature, value, radar)."""
    pairs = as_pairs(features, list(FEATURE_TARGETS), "double", keep=list(keep))
    v, out = F.col("value"), F.lit(None).cast("double")
    for name, target in FEATURE_TARGETS.items():
        if name in _LOWER_IS_BETTER:
            score = 1 - v / max(target, 0.01)
        elif name == "numeric_ratio":
            score = 1 - F.abs(v - target) / max(target, 0.01)
        else:
            score = 1 - v / max(target * 1.5, 0.01)
        out = F.when(F.col("column") == name, F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))).otherwise(out)
    return pairs.select(*keep, F.col("column").alias("feature"), "value", out.alias("radar"))


def feature_flags(features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """PASS or FLAG per feature."""
    pairs = as_pairs(features, list(FEATURE_TARGETS), "double", keep=list(keep))
    v, ok = F.col("value"), F.lit(None).cast("boolean")
    target_of = F.lit(None).cast("double")
    for name, target in FEATURE_TARGETS.items():
        if name in ("missing_ratio", "duplicate_ratio"):
            test = v <= target
        elif name == "numeric_ratio":
            test = F.abs(v - target) < 0.2
        elif name == "constant_cols":
            test = v == 0
        else:
            test = v < target * 1.5
        ok = F.when(F.col("column") == name, test).otherwise(ok)
        target_of = F.when(F.col("column") == name, F.lit(target)).otherwise(target_of)
    return pairs.select(
        *keep, F.col("column").alias("feature"), "value", target_of.alias("threshold"),
        F.when(ok, "PASS").otherwise("FLAG").alias("status"),
    )


def hours_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later) / 3600.0


def decay_factor(hours: Column) -> Column:
    """Trust in a model: 1 when fresh, down by 0.30 over 90 days, never under 0.70."""
    days = hours / 24.0
    return F.when(days <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.70), 1.0 - days / 90.0 * 0.30))


def model_age(hours: Column) -> Column:
    days = hours / 24.0
    return F.when(days < 7, "fresh").when(days < 30, "good").when(days < 90, "aging").otherwise("stale")


def hours_to_retrain(hours: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(30 * 24.0) - hours)


def rating_band(score: Column) -> Column:
    return (
        F.when(score >= 85, "EXCELLENT").when(score >= 60, "GOOD").when(score >= 30, "FAIR")
        .otherwise("POOR")
    )
