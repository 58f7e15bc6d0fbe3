"""Exact duplicates of rows and keep-first by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.functions.hashing import row_digests, row_hash
from sievemark.session import materialize


def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each exact row; nulls are equal. Copies are combined before the shuffle."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """rows, distinct_rows, duplicates and their ratio.

    Rows are told apart by 128 bits of hash, so 16 bytes per distinct row are shuffled.
    """
    groups = df.select(*row_digests(df)).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).select(
        "rows", "distinct_rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
        F.coalesce(
            F.try_divide(F.col("rows") - F.col("distinct_rows"), F.col("rows")), F.lit(0.0)
        ).alias("duplicate_ratio"),
    )


BROADCAST_HASHES = 2_000_000  # 16 MB of 64-bit hashes


def duplicate_counts_hashed(df: DataFrame, broadcast_limit: int = BROADCAST_HASHES) -> DataFrame:
    """``duplicate_counts`` that compares suspects value by value; only these are shuffled whole.

    Pass one shuffles 64-bit hashes. Rows whose hash is unique cannot be copies. The
    others are compared in full, so a hash collision never counts as a duplicate. The
    repeated hashes are written and counted first: a set of known small size is broadcast,
    which leaves the wide rows in place; a larger one is joined on the hash.
    """
    hashes = df.select(row_hash(df).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(hashes, "row-hashes")
    repeated_hashes = counted.filter(F.col("_n") > 1).select("_h")
    alone = counted.agg(
        F.count_if(F.col("_n") == 1).alias("rows"), F.count_if(F.col("_n") == 1).alias("distinct_rows")
    )
    small = repeated_hashes.count() <= broadcast_limit
    suspects = df.withColumn("_h", row_hash(df)).join(
        F.broadcast(repeated_hashes) if small else repeated_hashes, "_h", "left_semi"
    ).drop("_h")
    groups = suspects.groupBy(*[col(c) for c in suspects.columns]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = groups.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"))
    both = alone.unionByName(repeated).agg(
        F.sum("rows").alias("rows"), F.sum("distinct_rows").alias("distinct_rows")
    )
    return both.select(
        "rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
        F.coalesce(
            F.try_divide(F.col("rows") - F.col("distinct_rows"), F.col("rows")), F.lit(0.0)
        ).alias("duplicate_ratio"),
    )


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in order. Each task keeps one row per key before the shuffle."""
    w = Window.partitionBy(*[col(k) for k in key]).orderBy(*[col(o) for o in order_by])
    return df.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")


def drop_masked(df: DataFrame, mask: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the duplicate set."""
    return df.join(mask.select(key), key, "left_anti")
