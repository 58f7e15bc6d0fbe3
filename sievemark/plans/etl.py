"""Training samples from raw tables: batches, features, damaged twins, labels, splits, errors."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.operators.corrupt import Dice, corrupt_mix
from sievemark.operators.features import FEATURES17, features17, with_batches
from sievemark.operators.splits import balance_classes, split_ratio
from sievemark.session import materialize
from sievemark.sources.sinks import sink_errors, sink_splits

MIN_BATCH_ROWS = 10


@dataclass(frozen=True)
class Samples:
    samples: DataFrame  # sample_id, source, batch_no, label and the features
    errors: DataFrame  # source, reason


def build_samples(
    df: DataFrame, source: str, row_key: Sequence[str], order_by: Sequence[str], size: int = 100_000,
    least: int = MIN_BATCH_ROWS, seed: int = 42, algorithm: str = "xxhash64",
    damage: Callable[[DataFrame, Dice], DataFrame] = corrupt_mix,
) -> Samples:
    """Features of every batch of every source, labelled 1, and of its damaged twin, labelled 0.

    All batches are one job: they are keys of a grouping, not tables of their own. Batches of
    fewer than ``least`` rows give an error row instead of samples.
    """
    key = [source, "batch_no"]
    batches = materialize(with_batches(df, order_by, file=source, size=size), "batches")
    sizes = materialize(batches.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    short = sizes.filter(F.col("_n") < least)
    same = col(source).eqNullSafe(F.col("_k0")) & (F.col("batch_no") == F.col("_k1"))
    usable = batches.join(short, same, "left_anti")
    twin = damage(usable, Dice((*row_key, *key), seed, algorithm))

    def labelled(table: DataFrame, label: int) -> DataFrame:
        found = features17(table, key).withColumn("label", F.lit(label))
        name = F.concat_ws("#", F.coalesce(col(source).cast("string"), F.lit("")), F.col("batch_no"), F.col("label"))
        return found.select(name.alias("sample_id"), col(source).alias("source"), "batch_no", "label", *FEATURES17)

    errors = short.select(F.col("_k0").cast("string").alias("source"), F.format_string(f"batch %d: rows<{least}", "_k1").alias("reason"))
    return Samples(labelled(usable, 1).unionByName(labelled(twin, 0)), errors)


def split_samples(samples: DataFrame, seed: int = 42, algorithm: str = "xxhash64") -> DataFrame:
    """Equally many samples of each label, and ``split`` by source, so that twins stay together."""
    balanced = balance_classes(samples, "label", ["sample_id"], seed, algorithm=algorithm)
    return split_ratio(balanced, ["sample_id"], by=["source"], seed=seed, algorithm=algorithm)


def run_etl(df: DataFrame, path: str, source: str, row_key: Sequence[str], order_by: Sequence[str], **settings) -> DataFrame:
    """Build, split and write the samples below ``path`` (``samples``, ``errors``); returns the samples."""
    built = build_samples(df, source, row_key, order_by, **settings)
    samples = materialize(built.samples, "samples")
    sink_splits(split_samples(samples), f"{path}/samples")
    sink_errors(built.errors, f"{path}/errors")
    return df.sparkSession.read.parquet(f"{path}/samples")
