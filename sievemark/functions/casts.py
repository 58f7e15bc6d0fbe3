"""Casts that never raise: text to numbers, timestamps and booleans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col

# Tokens read as missing in delimited text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A plain decimal number. Spark's own cast also takes "1d" and "2f", so the text is
# matched first.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NUMBER_PREFIX = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def to_number(c: Column) -> Column:
    """Number held by a text column, null where the text is not a plain number."""
    t = F.trim(c)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def to_timestamp(c: Column) -> Column:
    """ISO date or timestamp text, else null."""
    return F.try_to_timestamp(c)


def to_boolean(c: Column) -> Column:
    """Only the words true and false; Spark's cast would accept yes, 1 and t as well."""
    word = F.lower(c.cast("string"))
    return F.when(word == "true", True).when(word == "false", False)


def number_prefix(c: Column) -> Column:
    """Leading number of a text ("12 kg" is 12), null where there is none."""
    return F.regexp_extract(F.trim(c.cast("string")), NUMBER_PREFIX, 0).try_cast("double")


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        F.when(~col(c).isin(*NA_TOKENS), col(c)).alias(c) if c in texts else col(c)
        for c in df.columns
    ])


def _floats(df: DataFrame) -> set[str]:
    return {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes null."""
    floats = _floats(df)
    return df.select(*[
        F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns
    ])


def inf_to_null(df: DataFrame) -> DataFrame:
    """Infinite values become null in floating-point columns."""
    floats = _floats(df)
    inf = F.lit(float("inf"))
    return df.select(*[
        F.when(F.abs(col(c)) != inf, col(c)).alias(c) if c in floats else col(c)
        for c in df.columns
    ])
