"""Per-column statistics, one row per column.

Statistics are grouped aggregates over (column, value) pairs: the same few aggregate
buffers serve every column, so the generated code stays small whatever the table's width,
and each task sends one row per column to the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.casts import number_prefix
from sievemark.functions.columns import col, column_classes
from sievemark.functions.stats import coef_variation, kurt_adjusted, skew_adjusted, stable_round
from sievemark.operators.categorical import numeric_modes
from sievemark.operators.correlation import trend_labels
from sievemark.operators.quantiles import Sketch, quantiles_of, sketch
from sievemark.operators.reshape import as_pairs, number
from sievemark.session import small_frame

QUARTILES = (0.25, 0.5, 0.75)
MIN_FENCE_VALUES = 4

Quartiles = dict[str, tuple[float | None, float | None, float | None]]


def number_or_null(value: float | None) -> Column:
    return F.lit(None).cast("double") if value is None else F.lit(float(value))


def sized_quartiles(
    df: DataFrame, columns: Sequence[str], also: Mapping[str, Column] | None = None
) -> tuple[Quartiles, Sketch]:
    """Quartiles, and the sketch they came from: counts and further aggregates over ``value`` of its scan."""
    scanned = sketch(df, columns, QUARTILES, also)
    found = quantiles_of(df, scanned, columns)
    return {c: tuple(found[c, p] for p in QUARTILES) for c in columns}, scanned


def quartile_map(df: DataFrame, columns: Sequence[str]) -> Quartiles:
    return sized_quartiles(df, columns)[0]


def scanned_stats(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], stats: Mapping[str, Column], schema: str
) -> DataFrame:
    """(column, stats..., quantiles...), one row per column; ``schema`` types them in this order."""
    scanned = sketch(df, columns, probs, stats)
    found = quantiles_of(df, scanned, columns)
    rows = [(c, *[scanned.also[c][n] for n in stats], *[found[c, p] for p in scanned.probs]) for c in columns]
    return small_frame(df.sparkSession, rows, schema)


def fences_of(q1: float | None, q3: float | None, width: float = 1.5):
    if q1 is None:
        return None, None
    return q1 - width * (q3 - q1), q3 + width * (q3 - q1)


def outside(c: Column, low: float | None, high: float | None) -> Column:
    """True outside the fences, false for null and where there are no fences."""
    if low is None:
        return F.lit(False)
    return F.coalesce((c < F.lit(low)) | (c > F.lit(high)), F.lit(False))


def numeric_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return as_pairs(df, columns, "double")


def quartile_frame(df: DataFrame, quartiles: Quartiles) -> DataFrame:
    """(column, position, q1, median, q3, low, high), one row per column."""
    return small_frame(
        df.sparkSession,
        [(c, i, *q, *fences_of(q[0], q[2])) for i, (c, q) in enumerate(quartiles.items())],
        "column string, position int, q1 double, median double, q3 double, low double, high double",
    )


def column_profile(
    df: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Mean, quartiles, spread, range, missing share and outliers of every column.

    The scan that proposes the quartiles gives all other statistics too; one further scan counts
    outliers. The trend needs a row order and is null without one.
    """
    numeric = list(column_classes(df).numeric)
    others = [c for c in df.columns if c not in numeric]
    six = lambda e: stable_round(e, 6)
    missing_pct = F.coalesce(
        F.bround(F.try_divide(F.col("missing_count") * 100.0, F.col("rows")), 2), F.lit(0.0)
    )
    parts = []
    if numeric:
        v = F.col("value")
        stats = {
            "rows": F.count(F.lit(1)), "missing_count": F.count(F.lit(1)) - F.count(v), "mean": F.avg(v),
            "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v),
        }
        quartiles, scanned = sized_quartiles(df, numeric, stats)
        rows = [
            (c, *[scanned.also[c][n] if scanned.also[c][n] is not None else 0 if n in ("rows", "missing_count") else None for n in stats], *quartiles[c])
            for c in numeric
        ]
        known = small_frame(
            df.sparkSession, rows,
            "column string, rows bigint, missing_count bigint, mean double, std double, min double, max double, q1 double, median double, q3 double",
        )
        fences = {c: fences_of(q[0], q[2]) for c, q in quartiles.items() if scanned.sizes[c] >= MIN_FENCE_VALUES}
        known = known.select("column", "rows", "missing_count", *[six(F.col(c)).alias(c) for c in known.columns[3:]])
        if fences:
            bounds = small_frame(df.sparkSession, [(c, *f) for c, f in fences.items()], "column string, low double, high double")
            beyond = numeric_pairs(df, list(fences)).join(F.broadcast(bounds), "column").groupBy("column").agg(
                F.count_if((v < F.col("low")) | (v > F.col("high"))).alias("outlier_count")
            )
            stats = known.join(F.broadcast(beyond), "column", "left")  # a row per column
        else:
            stats = known.withColumn("outlier_count", F.lit(0).cast("bigint"))
        stats = stats.filter("rows > 0")
        parts.append(stats)
    if others:
        flags = df.select(*[F.isnull(col(c)).alias(c) for c in others]).unpivot(
            [], [col(c) for c in others], "column", "gone"
        )
        parts.append(flags.groupBy("column").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("gone").alias("missing_count")
        ))
    out = parts[0]
    if len(parts) > 1:
        out = out.unionByName(parts[1], allowMissingColumns=True)
    elif not numeric:
        out = out.withColumns({
            **{k: F.lit(None).cast("double") for k in ("mean", "median", "std", "min", "max", "q1", "q3")},
            "outlier_count": F.lit(None).cast("bigint"),
        })
    dtypes = F.create_map(*[
        F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())
    ])
    out = out.select(
        "column", dtypes[F.col("column")].alias("dtype"),
        "mean", "median", "std", "min", "max", "q1", "q3",
        "missing_count", missing_pct.alias("missing_pct"),
        F.coalesce("outlier_count", F.lit(0)).alias("outlier_count"),
    )
    if order_by is None:
        return out.withColumn("trend", F.lit(None).cast("string"))
    trends = trend_labels(df, order_by, numeric).select("column", "trend")
    return out.join(F.broadcast(trends), "column", "left")  # one row per column


def descriptive_stats(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Sample deviation and variance, range, median and mode of numeric columns."""
    columns = list(columns or column_classes(df).numeric)
    v = F.col("value")
    stats = scanned_stats(
        df, columns, [0.5],
        {
            "n": F.count(v), "standard_deviation": F.stddev_samp(v), "variance": F.var_samp(v), "min": F.min(v),
            "max": F.max(v), "range": F.max(v) - F.min(v),
        },
        "column string, n bigint, standard_deviation double, variance double, min double, max double, range double, median double",
    ).filter("n > 0").drop("n")
    return stats.join(F.broadcast(numeric_modes(df, columns)), "column", "left")


def viewer_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population statistics over the leading numbers of any columns; mode is the smallest."""
    parsed = df.select(*[number_prefix(col(c)).alias(c) for c in columns])
    v = F.col("value")
    stats = scanned_stats(
        parsed, columns, [0.5],
        {
            "count": F.count(v), "mean": F.avg(v), "variance": F.var_pop(v), "std": F.stddev_pop(v), "min": F.min(v),
            "max": F.max(v), "range": F.max(v) - F.min(v),
        },
        "column string, count bigint, mean double, variance double, std double, min double, max double, range double, median double",
    ).filter("count IS NOT NULL")
    return stats.join(F.broadcast(numeric_modes(parsed, columns)), "column", "left")


def shape_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adjusted and population skewness and kurtosis, coefficient of variation, variance."""
    v = F.col("value")
    return numeric_pairs(df, list(columns or column_classes(df).numeric)).groupBy("column").agg(
        skew_adjusted(v).alias("skew_adj"),
        kurt_adjusted(v).alias("kurt_adj"),
        F.skewness(v).alias("skew_pop"),
        F.kurtosis(v).alias("kurt_pop"),
        coef_variation(v).alias("coef_variation"),
        F.var_samp(v).alias("variance"),
    )


def pearson_skew(profile: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(mean - median) / std per profiled column where it exceeds the threshold in size."""
    skew = F.try_divide(F.col("mean") - F.col("median"), F.col("std"))
    return profile.filter(F.col("std") > 0).select(
        "column", skew.alias("skew"), F.when(skew > 0, "right").otherwise("left").alias("side")
    ).filter(F.abs("skew") > threshold)


def describe(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """count, mean, std, min, quartiles and max with exact quartiles."""
    columns = list(columns or column_classes(df).numeric)
    v = F.col("value")
    return scanned_stats(
        df, columns, QUARTILES, {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)},
        "column string, count bigint, mean double, std double, min double, max double, p25 double, p50 double, p75 double",
    ).filter("count IS NOT NULL")


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, rows, missing, ratio) of every column from one scan."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    flags = df.select(*[F.isnull(number(df, c) if c in floats else col(c)).alias(c) for c in df.columns]).unpivot(
        [], [col(c) for c in df.columns], "column", "gone"
    )
    return flags.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("gone").alias("missing")
    ).withColumn("ratio", F.col("missing") / F.col("rows"))


def missing_summary(df: DataFrame) -> DataFrame:
    """One row: missing cells, all cells and their ratio."""
    return missing_counts(df).agg(
        F.sum("missing").alias("missing"), F.sum("rows").alias("cells")
    ).withColumn("ratio", F.try_divide(F.col("missing"), F.col("cells")))


def null_ratio_summary(df: DataFrame) -> DataFrame:
    """Mean, maximum and population deviation of the null ratios; columns over one half."""
    return missing_counts(df).agg(
        F.avg("ratio").alias("null_ratio_mean"),
        F.max("ratio").alias("null_ratio_max"),
        F.stddev_pop("ratio").alias("null_ratio_std"),
        F.count_if(F.col("ratio") > 0.5).alias("num_high_null_columns"),
    )
