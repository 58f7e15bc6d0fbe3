"""Cleaning a table end to end from a fixed profile of rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.casts import nan_to_null
from sievemark.functions.columns import col, rename_snake, renamed_count
from sievemark.operators.dedup import dedup_rows
from sievemark.operators.impute import Fill, apply_fills, fill_log, fill_plan, remove_outliers
from sievemark.operators.infer import coerce_numeric
from sievemark.operators.order import forward_fill
from sievemark.operators.rows import all_null, drop_empty_rows
from sievemark.session import materialize, small_frame


# Names and defaults of the options.
@dataclass(frozen=True)
class CleaningProfile:
    drop_empty_rows: bool = True
    drop_empty_cols: bool = True
    drop_duplicates: bool = True
    standardize_column_names: bool = True
    auto_detect_dtypes: bool = True
    fill_missing_strategy: str = "smart"  # drop, ffill, mean, median or smart
    handle_outliers: bool = False
    sequential_outliers: bool = False
    keep_null_in_outlier_filter: bool = True


@dataclass(frozen=True)
class Cleaned:
    table: DataFrame
    metrics: DataFrame  # one row
    fills: list[Fill] = field(default_factory=list)

    def fill_log(self) -> DataFrame:
        return fill_log(self.table, self.fills)


def _counts(df: DataFrame) -> tuple[int, int, dict[str, int]]:
    """(rows, rows with any value, values per column) from one scan."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~all_null(df)).alias("filled_rows"),
        *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    ).first()
    return row["rows"], row["filled_rows"], {c: row[f"n{i}"] for i, c in enumerate(df.columns)}


def clean_table(
    df: DataFrame,
    profile: CleaningProfile = CleaningProfile(),
    order_by: Sequence[str] | None = None,
) -> Cleaned:
    """Names, empty rows and columns, copies, types, gaps, outliers, in that order.

    The de-duplicated table is written once to shared scratch: it is the last step that
    shuffles rows, and the parameter passes after it each read only a few columns of it.
    """
    spark = df.sparkSession
    before_names = df.columns
    df = nan_to_null(df)
    if profile.standardize_column_names:
        df = rename_snake(df)
    renamed = renamed_count(before_names, df.columns)

    rows_in, rows_with_value, present = _counts(df)
    kept = drop_empty_rows(df) if profile.drop_empty_rows else df
    empty_columns = [c for c in df.columns if not present[c]] if profile.drop_empty_cols else []
    kept = kept.select(*[col(c) for c in df.columns if c not in empty_columns])
    rows_full = rows_with_value if profile.drop_empty_rows else rows_in
    if profile.drop_duplicates:
        kept = dedup_rows(kept)
    kept = materialize(kept, "distinct")
    rows_distinct = kept.count()

    if profile.auto_detect_dtypes:
        kept = coerce_numeric(kept)
    fills: list[Fill] = []
    filled = 0
    strategy = profile.fill_missing_strategy
    if strategy == "ffill":
        gaps = _counts(kept)[2]
        kept = forward_fill(kept, kept.columns, order_by or [])
        filled = sum(_counts(kept)[2].values()) - sum(gaps.values())
    elif strategy in ("mean", "median", "smart"):
        fills = fill_plan(kept, strategy)
        kept = apply_fills(kept, fills)
        filled = sum(f.filled for f in fills)
    rows_out = rows_distinct
    if profile.handle_outliers:
        kept = remove_outliers(
            kept,
            sequential=profile.sequential_outliers,
            keep_nulls=profile.keep_null_in_outlier_filter,
        )
        rows_out = kept.count()
    metrics = small_frame(
        spark,
        [(
            rows_in, len(before_names), renamed, rows_in - rows_full, len(empty_columns),
            rows_full - rows_distinct, filled, rows_distinct - rows_out, rows_out, len(kept.columns),
        )],
        "rows_input bigint, columns_input int, columns_standardized int, empty_rows_removed bigint, "
        "empty_columns_removed int, duplicates_removed bigint, missing_values_filled bigint, "
        "outliers_removed bigint, rows_output bigint, columns_output int",
    )
    return Cleaned(kept, metrics, fills)


def clean_simple(df: DataFrame) -> DataFrame:
    """Fallback cleaning: plain names and distinct rows, nothing filled."""
    from sievemark.functions.columns import rename_simple

    return dedup_rows(rename_simple(df))
