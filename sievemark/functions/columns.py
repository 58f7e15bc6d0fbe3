"""Column classes and names, decided from the schema without a job."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.NumericType,)
_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def col(name: str) -> Column:
    """Reference to a top-level column whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class ColumnClasses:
    """The three views of "numeric" that statistics, frequencies and charts need."""

    numeric: tuple[str, ...]  # numbers without booleans
    chart_numeric: tuple[str, ...]  # numbers and booleans
    categorical: tuple[str, ...]  # everything that is not a number
    datetime: tuple[str, ...]
    text: tuple[str, ...]


def column_classes(df: DataFrame) -> ColumnClasses:
    fields = [f for f in df.schema.fields]
    pick = lambda *types: tuple(f.name for f in fields if isinstance(f.dataType, types))
    numeric = pick(*_NUMERIC)
    return ColumnClasses(
        numeric=numeric,
        chart_numeric=pick(*_NUMERIC, T.BooleanType),
        categorical=tuple(f.name for f in fields if f.name not in numeric),
        datetime=pick(*_DATETIME),
        text=pick(T.StringType),
    )


def logical_type(data_type: T.DataType) -> str:
    if isinstance(data_type, _INTEGRAL):
        return "integer"
    if isinstance(data_type, T.NumericType):
        return "float"
    if isinstance(data_type, _DATETIME):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "categorical"


def is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, _INTEGRAL)


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, _NESTED)


def _unique(names: list[str]) -> list[str]:
    """Suffix repeated names with _2, _3, ... keeping the first as it is."""
    taken: set[str] = set()
    out = []
    for name in names:
        candidate, i = name, 1
        while candidate in taken:
            i += 1
            candidate = f"{name}_{i}"
        taken.add(candidate)
        out.append(candidate)
    return out


def snake_names(names: list[str]) -> list[str]:
    """snake_case of every name; clashes get a numeric suffix."""
    # Which characters become an underscore.
    snake = [re.sub(r"[^a-z0-9]+", "_", n.strip().lower()).strip("_") for n in names]
    return _unique([s or "column" for s in snake])


def simple_names(names: list[str]) -> list[str]:
    """Trimmed lower case with spaces and hyphens turned into underscores."""
    # The two characters that are replaced.
    return _unique([n.strip().lower().replace(" ", "_").replace("-", "_") for n in names])


def rename_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def rename_simple(df: DataFrame) -> DataFrame:
    return df.toDF(*simple_names(df.columns))


def renamed_count(before: list[str], after: list[str]) -> int:
    return sum(b != a for b, a in zip(before, after))


def project_visible(df: DataFrame, visible: list[str]) -> DataFrame:
    """The chosen columns in table order; unknown names are ignored."""
    keep = set(visible)
    return df.select(*[col(c) for c in df.columns if c in keep])
