"""Row-level filters, search, sorting, paging and simple removals."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.casts import to_number
from sievemark.functions.columns import col, column_classes
from sievemark.operators.reshape import one_row_to_long
from sievemark.session import small_frame

# Names that promise counts or percentages.
COUNT_NAME = r"(count|total|freq|num_|n_)"
PERCENT_NAME = r"(pct|percent|rate|ratio)"


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def empty_columns(df: DataFrame) -> list[str]:
    row = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"n{i}"] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    gone = set(empty_columns(df))
    return df.select(*[col(c) for c in df.columns if c not in gone])


def all_null(df: DataFrame) -> Column:
    return reduce(and_, [col(c).isNull() for c in df.columns])


def empty_row_stats(df: DataFrame) -> DataFrame:
    empty = F.count_if(all_null(df))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        empty.alias("empty_rows"),
        F.try_divide(empty, F.greatest(F.count(F.lit(1)), F.lit(1))).alias("empty_row_ratio"),
    )


def filter_equals(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Rows equal to every given value; names the table lacks are ignored."""
    tests = [col(c) == F.lit(v) for c, v in wanted.items() if c in df.columns]
    return df.filter(reduce(and_, tests)) if tests else df


def filter_search(df: DataFrame, term: str, visible: Sequence[str] | None = None) -> DataFrame:
    """Rows in which any visible column contains the term, whatever the case."""
    if not term.strip():
        return df
    needle = F.lit(term.lower())
    return df.filter(reduce(or_, [
        F.coalesce(F.lower(col(c).cast("string")).contains(needle), F.lit(False))
        for c in (visible or df.columns)
    ]))


def filter_pairwise(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows that can be plotted: x present and y a number."""
    y_is_text = y in column_classes(df).text
    number = to_number(col(y)) if y_is_text else col(y).cast("double")
    return df.withColumn(y, number).na.drop(subset=[x, y])


def negative_counts(df: DataFrame) -> DataFrame:
    """Negatives in numeric columns whose name promises a count."""
    names = [c for c in column_classes(df).numeric if re.search(COUNT_NAME, c, re.I)]
    return _violations(df, names, lambda x: x < 0)


def percent_out_of_range(df: DataFrame) -> DataFrame:
    """Values outside 0..100 in numeric columns whose name promises a percentage."""
    names = [c for c in column_classes(df).numeric if re.search(PERCENT_NAME, c, re.I)]
    return _violations(df, names, lambda x: (x < 0) | (x > 100))


def _violations(df: DataFrame, names: list[str], test) -> DataFrame:
    if not names:
        return small_frame(df.sparkSession, [], "column string, violations bigint")
    row = df.agg(*[F.count_if(test(col(c))).alias(f"v{i}") for i, c in enumerate(names)])
    return one_row_to_long(row, [
        {"column": F.lit(c), "violations": F.col(f"v{i}")} for i, c in enumerate(names)
    ])


def sort_keys(df: DataFrame, column: str, ascending: bool = True, natural: bool = True) -> list[Column]:
    """Order with nulls last either way; natural order puts numbers by value first."""
    keys = []
    if natural and column in column_classes(df).text:
        keys.append(to_number(col(column)))
    keys.append(col(column))
    return [k.asc_nulls_last() if ascending else k.desc_nulls_last() for k in keys]


def sort_column(df: DataFrame, column: str, ascending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*sort_keys(df, column, ascending), *[col(t) for t in tie])


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 25) -> DataFrame:
    """Page ``number`` (from 1) of a totally ordered table."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows as text; Spark keeps n rows per task before it merges them."""
    top = df.orderBy(*[col(c) for c in order_by]).limit(n)
    return top.select(*[col(c).cast("string").alias(c) for c in df.columns])


def numeric_first(df: DataFrame) -> DataFrame:
    """Column roles (column, role) read off the schema."""
    classes = column_classes(df)
    roles = [
        (c, "numeric" if c in classes.numeric else "datetime" if c in classes.datetime else "categorical")
        for c in df.columns
    ]
    return small_frame(df.sparkSession, roles, "column string, role string")
