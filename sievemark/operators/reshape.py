"""Wide one-row aggregates to long form, and tables to (column, value) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col, is_integral


def one_row_to_long(row: DataFrame, records: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame into one row per record of expressions over it."""
    structs = [F.struct(*[e.alias(n) for n, e in r.items()]) for r in records]
    return row.select(F.inline(F.array(*structs)))


def as_pairs(df: DataFrame, columns: Sequence[str], to: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) with every value cast to one type."""
    cast = df.select(*[col(k) for k in keep], *[_plain(df, c, to).alias(c) for c in columns])
    return cast.unpivot(
        [col(k) for k in keep], [col(c) for c in columns], "column", "value"
    )


def _plain(df: DataFrame, c: str, to: str) -> Column:
    data_type = df.schema[c].dataType
    if to == "string" and isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col(c))
    return number(df, c) if to == "double" else col(c).cast(to)


def number(df: DataFrame, c: str) -> Column:
    """A column as double in which NaN is null."""
    value = col(c).cast("double")
    is_float = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    return F.when(~F.isnan(value), value) if is_float else value


def families(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type their values can share without losing anything."""
    out: dict[str, list[str]] = {}
    for c in columns:
        data_type = df.schema[c].dataType
        if is_integral(data_type):
            kind = "bigint"
        elif isinstance(data_type, (T.FloatType, T.DoubleType)):
            kind = "double"
        elif isinstance(data_type, T.DecimalType):
            kind = "decimal(38,18)"
        else:
            kind = "string"
        out.setdefault(kind, []).append(c)
    return out
