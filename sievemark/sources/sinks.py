"""Writing tables, records, logs and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col, is_nested


def sink_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Parquet, read back with the same schema."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per task; nested values as JSON text."""
    flat = df.select(*[
        F.to_json(col(f.name)).alias(f.name) if is_nested(f.dataType) else col(f.name) for f in df.schema.fields
    ])
    # Quotes are doubled and blanks kept, so that any text comes back as it was.
    flat.write.mode(mode).csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def csv_export(df: DataFrame, path: str) -> None:
    """A download: a folder of CSV files, each with the header; the caller may coalesce first."""
    sink_csv(df, path)


def sink_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def sink_append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def sink_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per split, so reading a split reads only its files."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def sink_errors(errors: DataFrame, path: str) -> None:
    """(source, reason) rows as CSV."""
    errors.select("source", "reason").write.mode("append").csv(path, header=True)
