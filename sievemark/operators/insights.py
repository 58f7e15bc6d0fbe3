"""Findings over the small profile tables, as rows of values; wording is left to the reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shares and sizes from which something is worth telling.
MISSING_PCT, SKEW = 20, 0.5


def _finding(df: DataFrame, kind: str | Column, column: str, value: Column, other: str | None = None) -> DataFrame:
    return df.select(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        F.col(column).alias("column"),
        (F.col(other) if other else F.lit(None)).cast("string").alias("other"),
        value.cast("double").alias("value"),
    )


def key_insights(
    profile: DataFrame, correlations: DataFrame, anomalies: DataFrame, dominant: DataFrame
) -> DataFrame:
    """(kind, column, other, value), a row per column or pair with a finding.

    Kinds: missing (share in %), correlation (r with the other column), increasing and
    decreasing, outliers (their number), skew ((mean - median) / std), dominance (share of
    the value in ``other``, in %), imbalance (most frequent over rarest).
    """
    skew = F.try_divide(F.col("mean") - F.col("median"), F.col("std"))
    trending = profile.filter(F.col("trend").isin("increasing", "decreasing"))
    parts = [
        _finding(profile.filter(F.col("missing_pct") > MISSING_PCT), "missing", "column", F.col("missing_pct")),
        _finding(correlations.filter("strength = 'strong'"), "correlation", "col_a", F.col("pearson_r"), "col_b"),
        _finding(trending, F.col("trend"), "column", F.lit(None)),
        _finding(anomalies, "outliers", "column", F.col("outlier_count")),
        _finding(profile.filter((F.col("std") > 0) & (F.abs(skew) > SKEW)), "skew", "column", skew),
        _finding(dominant.filter("dominant"), "dominance", "column", F.col("top_pct"), "top_value"),
        _finding(dominant.filter("imbalanced"), "imbalance", "column", F.col("imbalance")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
