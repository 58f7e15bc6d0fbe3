"""Seeded, order-free randomness and fingerprints from row content."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence
from dataclasses import asdict, is_dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col
from sievemark.functions.file_chain import LargeFile, can_chain, chained_md5, is_unpacked
from sievemark.session import small_frame

_FILE_BLOCK = 128 * 2**20
_MD5_DIGITS = 13  # 52 bits, exact in a double


def uniform(key: list[Column], seed: int, tag: str, algorithm: str = "xxhash64") -> Column:
    """Number in [0, 1) fixed by the row key, whatever partition the row is in.

    ``md5`` gives the same numbers in any SQL engine; ``xxhash64`` is faster.
    """
    if algorithm == "md5":
        digits = F.substring(_md5(key, seed, tag), 1, _MD5_DIGITS)
        return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**52))
    bits = F.xxhash64(*key, F.lit(seed), F.lit(tag)).bitwiseAND(F.lit(2**53 - 1))
    return bits / F.lit(float(2**53))


def _md5(key: list[Column], seed: int, tag: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in key]))


def uniform_from(key: list[Column], seed: int, tag: str, rate: float, algorithm: str = "xxhash64") -> Column:
    """Whether ``uniform`` is ``rate`` or more.

    The digits of an md5 are compared as text with those of the least number that is; that is the same
    and spares the number.
    """
    if algorithm != "md5" or not 0 < rate < 1:
        return uniform(key, seed, tag, algorithm) >= F.lit(rate)
    return _md5(key, seed, tag) >= F.lit(f"{math.ceil(rate * 2**52):0{_MD5_DIGITS}x}")


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[col(c) for c in df.columns])


def row_digests(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of a row with different seeds; equal rows agree, and 128 bits tell others apart.

    Missing values are marked, since the hash passes them over, and -0.0 counts as 0.0.
    """
    names = list(columns if columns is not None else df.columns)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    values = [col(c) + F.lit(0.0) if c in floats else col(c) for c in names]
    gaps = [F.isnull(col(c)) for c in names]
    return [F.xxhash64(F.lit(seed), *values, *gaps).alias(f"_h{seed}") for seed in (1, 2)]


def data_fingerprint(df: DataFrame) -> DataFrame:
    """One md5 per table content, the same for any row order.

    Row hashes are folded by a wrapping sum and by xor; the sum keeps pairs of equal
    rows visible, which xor alone would cancel.
    """
    hashed = df.select(row_hash(df).alias("h"))
    folded = hashed.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("s"),
        F.bit_xor("h").alias("x"),
    )
    return folded.select(
        F.md5(F.concat_ws("|", F.col("n").cast("string"), F.col("s").cast("string"),
                          F.col("x").cast("string"))).alias("data_hash"),
        F.col("n").alias("num_rows"),
    )


def config_fingerprint(config) -> str:
    """md5 of a configuration with its keys sorted."""
    plain = asdict(config) if is_dataclass(config) else dict(config)
    return hashlib.md5(json.dumps(plain, sort_keys=True).encode()).hexdigest()


def file_hashes(spark, path: str, block: int = _FILE_BLOCK) -> DataFrame:
    """md5 of the bytes of every file below ``path``.

    A file of up to ``block`` bytes is one row; a larger one is hashed by turns, ``block`` bytes a task. A large file
    that the line reader would unpack by its name (``.gz``) is one row too, and past 2 GB refused by the reader; so is
    any file where Python has no OpenSSL.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    hashed = ("path", "length", F.md5("content").alias("md5"))
    over = files.filter(F.col("length") > block).select("path", "length", F.col("_metadata.file_path").alias("name")).collect()
    if not over or not can_chain():
        return files.select(*hashed)
    large = [LargeFile(*r) for r in over]
    unpacked = [f for f in large if is_unpacked(spark, f.path)]
    out = files.filter(F.col("length") <= block).select(*hashed)
    if unpacked:
        out = out.unionByName(files.filter(F.col("_metadata.file_path").isin([f.name for f in unpacked])).select(*hashed))
    if len(unpacked) < len(large):
        chained = chained_md5(spark, path, [f for f in large if f not in unpacked], block)
        out = out.unionByName(small_frame(spark, chained, "path string, length long, md5 string"))
    return out
