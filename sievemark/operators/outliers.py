"""IQR fences and everything that tests values against them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.operators.order import with_row_id
from sievemark.operators.profile import (
    MIN_FENCE_VALUES, Quartiles, fences_of, numeric_pairs, outside, quartile_map, sized_quartiles,
)
from sievemark.operators.reshape import as_pairs
from sievemark.session import small_frame

FLAG = "_is_outlier"


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(FLAG)


def _fences(quartiles: Quartiles, sizes: dict[str, int]) -> dict[str, tuple[float | None, float | None]]:
    return {c: fences_of(q[0], q[2]) if sizes[c] >= MIN_FENCE_VALUES else (None, None) for c, q in quartiles.items()}


def fence_map(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple[float | None, float | None]]:
    """(low, high) per numeric column; none for columns with fewer than four values."""
    quartiles, scanned = sized_quartiles(df, list(columns or column_classes(df).numeric))
    return _fences(quartiles, scanned.sizes)


def iqr_fences(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, q1, q3, lower_fence, upper_fence), one row per numeric column."""
    columns = list(columns or column_classes(df).numeric)
    quartiles, scanned = sized_quartiles(df, columns)
    fences = _fences(quartiles, scanned.sizes)
    return small_frame(
        df.sparkSession,
        [(c, quartiles[c][0], quartiles[c][2], *fences[c]) for c in columns],
        "column string, q1 double, q3 double, lower_fence double, upper_fence double",
    )


def outlier_predicate(fences: dict[str, tuple[float | None, float | None]]) -> Column:
    """True where any column is outside its fences."""
    tests = [outside(F.nanvl(col(c).cast("double"), F.lit(None)), lo, hi) for c, (lo, hi) in fences.items()]
    return reduce(or_, tests) if tests else F.lit(False)


def _outlying_cells(df: DataFrame, fences: dict, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) of the cells outside the fences of their column."""
    slim = df.select(*[col(k) for k in keep], *[
        F.when(outside(col(c).cast("double"), *f), col(c).cast("double")).alias(c) for c, f in fences.items()
    ])
    return as_pairs(slim, list(fences), "double", keep=keep).filter(F.col("value").isNotNull())


def iqr_anomalies(df: DataFrame) -> DataFrame:
    """(column, lower_fence, upper_fence, outlier_count) of the columns with outliers."""
    fences = {c: f for c, f in fence_map(df).items() if f[0] is not None}
    schema = "column string, lower_fence double, upper_fence double"
    bounds = small_frame(df.sparkSession, [(c, *f) for c, f in fences.items()], schema)
    if not fences:
        return bounds.withColumn("outlier_count", F.lit(0).cast("bigint"))
    counts = _outlying_cells(df, fences).groupBy("column").agg(F.count(F.lit(1)).alias("outlier_count"))
    return counts.join(F.broadcast(bounds), "column").select(
        "column", F.bround("lower_fence", 6).alias("lower_fence"),
        F.bround("upper_fence", 6).alias("upper_fence"), "outlier_count",
    )


def anomaly_rows(
    df: DataFrame, order_by: Sequence[str], cap: int | None = None
) -> DataFrame:
    """(column, row_index, value): every outlying cell with the 0-based position of its row.

    ``cap`` keeps the first so many per column.
    """
    fences = {c: f for c, f in fence_map(df).items() if f[0] is not None}
    if not fences:
        return small_frame(df.sparkSession, [], "column string, row_index bigint, value double")
    numbered = with_row_id(df, order_by).withColumn("row_index", F.col("_row_id") - 1)
    cells = _outlying_cells(numbered, fences, ["row_index"]).select("column", "row_index", "value")
    if cap is None:
        return cells
    first = Window.partitionBy("column").orderBy("row_index")
    return cells.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= cap).drop("_n")


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    cap: int | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``_is_outlier``: outside the fences of any numeric column.

    Without a cap this is a predicate on literals: no join, no shuffle. With a cap only
    the first ``cap`` outliers per column in row order count.
    """
    fences = fence_map(df, columns)
    if cap is None:
        return df.withColumn(FLAG, outlier_predicate(fences))
    numbered = with_row_id(df, order_by or [])
    hits = {c: outside(col(c).cast("double"), *f) for c, f in fences.items() if f[0] is not None}
    cells = numbered.select(
        "_row_id", F.explode(F.array(*[F.when(h, F.lit(c)) for c, h in hits.items()])).alias("column")
    ).filter(F.col("column").isNotNull())
    first = Window.partitionBy("column").orderBy("_row_id")
    kept = cells.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= cap)
    flagged = kept.select("_row_id").distinct().withColumn(FLAG, F.lit(True))
    return numbered.join(flagged, "_row_id", "left").select(
        *[col(c) for c in df.columns], F.coalesce(FLAG, F.lit(False)).alias(FLAG)
    )


def split_by_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not / is in the id set, as an anti and a semi join."""
    return df.join(ids, key, "left_anti"), df.join(ids, key, "left_semi")


def mark_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Existence join: flag rows whose key is in the id set."""
    marked = ids.select(key).distinct().withColumn(FLAG, F.lit(True))
    return df.join(marked, key, "left").withColumn(FLAG, F.coalesce(FLAG, F.lit(False)))


def cells_outside_fences(
    df: DataFrame, key: str, fences: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(key, column, value) of every cell outside its column's fences.

    The fence table has one row per column, so it is broadcast and joined on the name.
    """
    cells = as_pairs(df, columns, "double", keep=[key]).filter(F.col("value").isNotNull())
    v = F.col("value")
    return cells.join(F.broadcast(fences), "column").filter(
        (v < F.col("lower_fence")) | (v > F.col("upper_fence"))
    ).select(key, "column", "value", "lower_fence", "upper_fence")


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """(column, n, outliers); a column whose quartiles are equal has none."""
    columns = list(columns or column_classes(df).numeric)
    schema = "column string, position int, low double, high double"
    bounds = []
    for i, (c, (q1, _, q3)) in enumerate(quartile_map(df, columns).items()):
        spread = q1 is not None and q3 > q1
        bounds.append((c, i, *(fences_of(q1, q3) if spread else (None, None))))
    frame = small_frame(df.sparkSession, bounds, schema)
    if not columns:
        return frame.select("position", "column", F.lit(0).alias("n"), F.lit(0).alias("outliers"))
    v = F.col("value")
    return numeric_pairs(df, columns).join(F.broadcast(frame), "column").groupBy(
        "position", "column"
    ).agg(
        F.count(v).alias("n"),
        F.count_if((v < F.col("low")) | (v > F.col("high"))).alias("outliers"),
    )


def pooled_outlier_ratio(df: DataFrame) -> DataFrame:
    """One row: values, outliers and their ratio pooled over all numeric columns."""
    return outlier_counts(df).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("values"),
        F.coalesce(F.sum("outliers"), F.lit(0)).alias("outliers"),
    ).withColumn("ratio", F.try_divide(F.col("outliers"), F.col("values")))


def zscore_ratio(df: DataFrame, columns: Sequence[str], z: float = 3.0) -> DataFrame:
    """Share of values further than z population deviations from the mean."""
    v = F.col("value")
    pairs = numeric_pairs(df, columns)
    centre = pairs.groupBy("column").agg(
        F.avg(v).alias("mean"), (z * F.stddev_pop(v)).alias("reach")
    )
    return pairs.join(F.broadcast(centre), "column").groupBy("column").agg(
        F.try_divide(F.count_if(F.abs(v - F.col("mean")) > F.col("reach")), F.count(v)).alias("ratio")
    )
