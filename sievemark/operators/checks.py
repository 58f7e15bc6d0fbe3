"""Rule checks as rows, dimension scores, overall confidence and status."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.operators.dedup import duplicate_counts
from sievemark.operators.outliers import outlier_counts
from sievemark.operators.profile import numeric_pairs
from sievemark.operators.reshape import one_row_to_long
from sievemark.operators.rows import COUNT_NAME, PERCENT_NAME, all_null
from sievemark.session import small_frame

# Weight of each dimension and of each severity, and the caps on scores.
DIMENSION_WEIGHTS = {
    "completeness": 0.20,
    "consistency": 0.20,
    "accuracy": 0.15,
    "duplicates": 0.12,
    "outliers": 0.12,
    "ml_assessment": 0.21,
}
SEVERITY_WEIGHTS = {"error": 1.0, "warning": 0.7, "info": 0.15}
DIMENSION_CAP, EMPTY_DIMENSION, CONFIDENCE_CAP = 0.85, 0.75, 0.80
REJECT_BELOW, WARN_BELOW = 0.50, 0.70
TOLERANCE = 1e-3


def _check(check_id: str, category: str, passed: Column, severity: str | Column, detail: Column) -> dict:
    return {
        "check_id": F.lit(check_id),
        "category": F.lit(category),
        "passed": passed,
        "severity": F.lit(severity) if isinstance(severity, str) else severity,
        "detail": F.when(passed, "").otherwise(detail),
    }


def _count_text(n: Column, words: str) -> Column:
    return F.concat(n.cast("string"), F.lit(words))


def checks_sanity(df: DataFrame, reported_rows: int, reported_columns: int) -> DataFrame:
    """Sizes, empty rows and columns, copies, negative counts, impossible percentages."""
    numeric = column_classes(df).numeric
    counts = [c for c in numeric if re.search(COUNT_NAME, c, re.I)]
    percents = [c for c in numeric if re.search(PERCENT_NAME, c, re.I)]
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(all_null(df)).alias("empty_rows"),
        *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[F.count_if(col(c) < 0).alias(f"neg{i}") for i, c in enumerate(counts)],
        *[F.count_if((col(c) < 0) | (col(c) > 100)).alias(f"pct{i}") for i, c in enumerate(percents)],
    )
    rows, width = F.col("rows"), len(df.columns)
    gone = F.array_compact(F.array(*[F.when(F.col(f"n{i}") == 0, F.lit(c)) for i, c in enumerate(df.columns)]))
    records = [
        _check("row_count_match", "accuracy", rows == reported_rows, "error",
               F.concat(F.lit(f"analysis={reported_rows}, actual="), rows.cast("string"))),
        _check("col_count_match", "accuracy", F.lit(reported_columns == width), "warning",
               F.lit(f"analysis={reported_columns}, actual={width}")),
        _check("no_all_na_rows", "completeness", F.col("empty_rows") == 0, "error",
               _count_text(F.col("empty_rows"), " fully-empty rows")),
        _check("no_all_na_cols", "completeness", F.size(gone) == 0, "error", F.array_join(gone, ", ")),
        *[
            _check(f"non_negative_{c}", "accuracy", F.col(f"neg{i}") == 0, "error",
                   _count_text(F.col(f"neg{i}"), " negatives"))
            for i, c in enumerate(counts)
        ],
        *[
            _check(f"pct_range_{c}", "accuracy", F.col(f"pct{i}") == 0, "warning",
                   _count_text(F.col(f"pct{i}"), " out-of-range values"))
            for i, c in enumerate(percents)
        ],
        _check("min_row_count", "accuracy", rows >= 3, "error", F.concat(F.lit("rows="), rows.cast("string"))),
        _check("min_col_count", "accuracy", F.lit(width >= 2), "error", F.lit(f"cols={width}")),
    ]
    copies = one_row_to_long(duplicate_counts(df), [
        _check("no_duplicates", "duplicates", F.col("duplicates") == 0, "warning",
               _count_text(F.col("duplicates"), " duplicate rows"))
    ])
    return one_row_to_long(row, records).unionByName(copies)


def recompute(df: DataFrame) -> DataFrame:
    """(column, mean, std, min, max) of the numeric columns that have values."""
    v = F.col("value")
    return numeric_pairs(df, list(column_classes(df).numeric)).groupBy("column").agg(
        F.avg(v).alias("actual_mean"), F.stddev_samp(v).alias("actual_std"),
        F.min(v).alias("actual_min"), F.max(v).alias("actual_max"),
    ).filter("actual_mean IS NOT NULL")


def reported_against_actual(df: DataFrame, reported: DataFrame) -> DataFrame:
    """Reported column statistics beside recomputed ones; ``known`` tells missing columns."""
    known = F.col("column").isin(list(df.columns))
    return reported.withColumn("known", known).join(F.broadcast(recompute(df)), "column", "left")


def checks_consistency(df: DataFrame, reported: DataFrame) -> DataFrame:
    """Reported mean, std, min and max within tolerance of the table's own."""
    both = reported_against_actual(df, reported)
    missing = both.filter(~F.col("known")).select(
        F.concat(F.lit("col_exists_"), "column").alias("check_id"),
        F.lit("consistency").alias("category"), F.lit(False).alias("passed"),
        F.lit("error").alias("severity"), F.lit("missing in table").alias("detail"),
    )
    records = []
    for stat, severity in (("mean", "warning"), ("std", "info"), ("min", "info"), ("max", "info")):
        rep, act = F.col(stat), F.col(f"actual_{stat}")
        ok = F.abs(act - rep) <= TOLERANCE * (F.abs(rep) + 1e-9)
        records.append(F.struct(
            F.concat(F.lit(f"{stat}_match_"), "column").alias("check_id"),
            F.lit("consistency").alias("category"),
            F.coalesce(ok, F.lit(False)).alias("passed"),
            F.lit(severity).alias("severity"),
            F.when(F.coalesce(ok, F.lit(False)), "").otherwise(
                F.format_string("reported=%.6g, actual=%.6g", rep, act)).alias("detail"),
        ))
    tested = both.filter(
        F.col("known") & F.col("mean").isNotNull() & F.col("actual_mean").isNotNull()
    ).select(F.inline(F.array(*records)))
    return tested.unionByName(missing)


def checks_correlation_sign(actual: DataFrame, reported: DataFrame) -> DataFrame:
    """Reported pairs keep their sign when recomputed."""
    both = reported.select("col_a", "col_b", F.col("pearson_r").alias("rep")).join(
        actual.select("col_a", "col_b", F.col("pearson_r").alias("act")), ["col_a", "col_b"]
    )
    ok = (F.col("act") >= 0) == (F.col("rep") >= 0)
    return both.select(
        F.concat_ws("_", F.lit("corr_direction"), "col_a", "col_b").alias("check_id"),
        F.lit("consistency").alias("category"), ok.alias("passed"), F.lit("warning").alias("severity"),
        F.when(ok, "").otherwise(F.format_string("reported=%+.4f, actual=%+.4f", "rep", "act")).alias("detail"),
    )


def checks_charts(chart_rows: DataFrame) -> DataFrame:
    """At least one chart, and data behind every chart; input is (chart_id, rows)."""
    any_chart = chart_rows.agg(F.count(F.lit(1)).alias("n"))
    first = one_row_to_long(any_chart, [
        _check("chart_count_nonzero", "visualization", F.col("n") > 0, "error", F.lit("no charts"))
    ])
    each = chart_rows.select(
        F.concat(F.lit("chart_has_data_"), "chart_id").alias("check_id"),
        F.lit("visualization").alias("category"), (F.col("rows") > 0).alias("passed"),
        F.lit("error").alias("severity"),
        F.when(F.col("rows") > 0, "").otherwise("no rows").alias("detail"),
    )
    return first.unionByName(each)


def checks_outliers(df: DataFrame) -> DataFrame:
    """Pooled outlier share under 5 %; the detail lists every affected column."""
    per_column = outlier_counts(df)
    hit = F.when(F.col("outliers") > 0, F.struct(
        "position", F.format_string("%s=%d/%d", "column", "outliers", "n").alias("t"),
    ))
    pooled = per_column.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("outliers"), F.lit(0)).alias("out"),
        F.sort_array(F.collect_list(hit)).alias("hits"),  # at most one entry per column
    )
    pct = F.try_divide(F.col("out") * 100.0, F.col("n"))
    detail = F.array_join(F.concat(
        F.array(F.format_string("pooled=%d/%d", "out", "n")), F.transform("hits", lambda h: h["t"])
    ), " ")
    return pooled.select(
        F.lit("outliers_evaluation").alias("check_id"), F.lit("outliers").alias("category"),
        F.coalesce(pct < 5.0, F.lit(True)).alias("passed"),
        F.when(pct.isNull() | (pct < 3.0), "info").when(pct < 7.0, "warning").otherwise("error").alias("severity"),
        F.when(F.col("n") > 0, detail).otherwise("pooled=0/0").alias("detail"),
    )


def check_ml(scored: DataFrame) -> DataFrame:
    """GOOD above 70 passes; input has quality, score, probability_good, probability_bad."""
    good = F.col("quality") == "GOOD"
    return scored.select(
        F.lit("ml_quality_assessment").alias("check_id"), F.lit("ml_assessment").alias("category"),
        (good & (F.col("score") > 70)).alias("passed"),
        F.when(good & (F.col("score") > 75), "info").otherwise("warning").alias("severity"),
        F.format_string("verdict=%s score=%.1f good=%.4f bad=%.4f", "quality", "score",
                        "probability_good", "probability_bad").alias("detail"),
    )


def dimension_scores(checks: DataFrame) -> DataFrame:
    """(dimension, score, weight, checks_passed, checks_total) of every weighted dimension."""
    dims = small_frame(
        checks.sparkSession,
        list(DIMENSION_WEIGHTS.items()), "dimension string, weight double"
    )
    w = F.lit(None).cast("double")
    for severity, weight in SEVERITY_WEIGHTS.items():
        w = F.when(F.col("severity") == severity, F.lit(weight)).otherwise(w)
    sums = checks.groupBy(F.col("category").alias("dimension")).agg(
        F.sum(w).alias("total"),
        F.sum(F.when(~F.col("passed"), w).otherwise(F.lit(0.0))).alias("penalty"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )
    score = F.when(F.col("checks_total").isNull(), F.lit(EMPTY_DIMENSION)).otherwise(
        F.least(1 - F.try_divide(F.col("penalty"), F.col("total")), F.lit(DIMENSION_CAP))
    )
    return dims.join(sums, "dimension", "left").select(
        "dimension", F.bround(F.greatest(score, F.lit(0.0)), 4).alias("score"), "weight",
        F.coalesce("checks_passed", F.lit(0)).alias("checks_passed"),
        F.coalesce("checks_total", F.lit(0)).alias("checks_total"),
    )


def overall_confidence(dimensions: DataFrame) -> DataFrame:
    blend = F.try_divide(F.sum(F.col("score") * F.col("weight")), F.sum("weight"))
    return dimensions.agg(
        F.bround(F.least(F.coalesce(blend, F.lit(0.70)), F.lit(CONFIDENCE_CAP)), 4).alias("confidence")
    )


def validation_status(checks: DataFrame) -> DataFrame:
    """(confidence, blocking_errors, status), one row."""
    scores = overall_confidence(dimension_scores(checks)).select(
        "confidence", F.lit(0).cast("bigint").alias("blocking_errors")
    )
    errors = checks.agg(
        F.count_if(~F.col("passed") & (F.col("severity") == "error")).alias("blocking_errors")
    ).select(F.lit(None).cast("double").alias("confidence"), "blocking_errors")
    row = scores.unionByName(errors).agg(
        F.max("confidence").alias("confidence"), F.max("blocking_errors").alias("blocking_errors")
    )
    return row.withColumn(
        "status",
        F.when((F.col("blocking_errors") > 0) | (F.col("confidence") < REJECT_BELOW), "REJECTED")
        .when(F.col("confidence") < WARN_BELOW, "APPROVED_WITH_WARNINGS").otherwise("APPROVED"),
    )


def messages(checks: DataFrame) -> DataFrame:
    """Failed details grouped by severity; a check table holds a few rows per column."""
    return checks.filter(~F.col("passed")).groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.concat_ws(": ", "check_id", "detail"))).alias("details"),
    )


def issues_by_category(checks: DataFrame) -> DataFrame:
    """(category, failed, check_ids) of categories with failed checks."""
    return checks.filter(~F.col("passed")).groupBy("category").agg(
        F.count(F.lit(1)).alias("failed"), F.array_join(F.sort_array(F.collect_list("check_id")), ", ").alias("check_ids")
    ).orderBy("category")


def before_after(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(metric, before, after, change) of rows, columns, missing cells and duplicates."""
    from sievemark.operators.profile import missing_summary

    def side(df: DataFrame, name: str) -> DataFrame:
        missing = missing_summary(df).select(F.lit("missing").alias("metric"), F.col("missing").alias("v"))
        counts = one_row_to_long(duplicate_counts(df), [
            {"metric": F.lit("rows"), "v": F.col("rows")},
            {"metric": F.lit("columns"), "v": F.lit(len(df.columns)).cast("bigint")},
            {"metric": F.lit("duplicates"), "v": F.col("duplicates")},
        ])
        return counts.unionByName(missing).withColumn("side", F.lit(name))

    both = side(raw, "before").unionByName(side(cleaned, "after"))
    pick = lambda s: F.max(F.when(F.col("side") == s, F.col("v")))
    return both.groupBy("metric").agg(pick("before").alias("before"), pick("after").alias("after")).withColumn(
        "change", F.col("after") - F.col("before")
    )
