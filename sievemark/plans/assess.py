"""From a cleaned table to a certified one: profile, charts, checks, status."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import column_classes
from sievemark.operators.categorical import categorical_profile, distinct_counts, dominant_categories
from sievemark.operators.charts import chart_select
from sievemark.operators.checks import (
    checks_consistency, checks_correlation_sign, checks_outliers, checks_sanity, validation_status,
)
from sievemark.operators.correlation import correlation_pairs
from sievemark.operators.insights import key_insights
from sievemark.operators.outliers import iqr_anomalies
from sievemark.operators.profile import column_profile
from sievemark.session import materialize


@dataclass(frozen=True)
class Analysis:
    profile: DataFrame
    correlations: DataFrame
    categories: DataFrame
    anomalies: DataFrame
    insights: DataFrame
    charts: DataFrame


def analyse(df: DataFrame, order_by: Sequence[str]) -> Analysis:
    """Every profile table. Each is small and written once, as later steps reuse it."""
    classes = column_classes(df)
    profile = materialize(column_profile(df, order_by), "profile")
    correlations = materialize(correlation_pairs(df), "correlations")
    anomalies = materialize(iqr_anomalies(df), "anomalies")
    dominant = dominant_categories(df, classes.categorical)
    distinct = materialize(distinct_counts(df), "distinct")
    return Analysis(
        profile, correlations, categorical_profile(df), anomalies,
        key_insights(profile, correlations, anomalies, dominant),
        chart_select(df, profile, correlations, distinct),
    )


def validate(df: DataFrame, analysis: Analysis, reported_rows: int, reported_columns: int) -> tuple[DataFrame, DataFrame]:
    """(checks, status) of a table against its analysis."""
    reported = analysis.profile.filter(F.col("mean").isNotNull()).select("column", "mean", "std", "min", "max")
    checks = (
        checks_sanity(df, reported_rows, reported_columns)
        .unionByName(checks_consistency(df, reported))
        .unionByName(checks_correlation_sign(correlation_pairs(df), analysis.correlations))
        .unionByName(checks_outliers(df))
    )
    checks = materialize(checks, "checks")
    return checks, validation_status(checks)
