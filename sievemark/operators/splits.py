"""Balanced classes, splits and folds fixed by a seeded hash of the row key.

A cut through a class is an order statistic of that hash. It is found by counting, and
rows are then told apart by a comparison with it: they are neither sorted nor moved. Sizes
are exact while keys are unique; rows with the same key stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.functions.hashing import uniform
from sievemark.operators.quantiles import order_statistics

_U = "_u"
MAX_CLASSES = 1000  # labels come to the driver, one row each


def _drawn(df: DataFrame, key: Sequence[str], seed: int, tag: str, algorithm: str) -> DataFrame:
    return df.withColumn(_U, uniform([col(k) for k in key], seed, tag, algorithm))


def shuffle(df: DataFrame, key: Sequence[str], seed: int = 42, algorithm: str = "xxhash64") -> DataFrame:
    """The same random order on every run, as a distributed sort."""
    return _drawn(df, key, seed, "shuffle", algorithm).orderBy(_U, *[col(k) for k in key]).drop(_U)


def sample_frac(
    df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42, algorithm: str = "xxhash64"
) -> DataFrame:
    """Seeded fraction; a row is in or out whatever its partition."""
    return df.filter(uniform([col(k) for k in key], seed, "sample", algorithm) < fraction)


def _is(label: str, value: object) -> Column:
    return col(label).isNull() if value is None else col(label) == F.lit(value)


def class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows of every class, null being one; a column with more than ``MAX_CLASSES`` values is no label."""
    rows = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has over {MAX_CLASSES} values")
    return {r["label"]: r["n"] for r in rows}


def _class_cuts(
    drawn: DataFrame, label: str, sizes: dict[object, int], cuts: dict[object, Sequence[int]]
) -> dict[object, list[float]]:
    """For each class and number of rows, a hash that so many rows of the class do not exceed.

    Minus infinity for none of them, infinity for all.
    """
    known = [c for c in cuts if sizes.get(c)]
    names = {c: f"class{i}" for i, c in enumerate(known)}
    frame = drawn.select(*[F.when(_is(label, c), F.col(_U)).alias(n) for c, n in names.items()])
    ranks = {names[c]: {k - 1 for k in cuts[c] if 0 < k < sizes[c]} for c in known}
    ranks = {n: r for n, r in ranks.items() if r}
    found = order_statistics(frame, ranks, {names[c]: sizes[c] for c in known}) if ranks else {}

    def edge(c: object, k: int) -> float:
        return float("-inf") if k <= 0 else float("inf") if k >= sizes[c] else found[names[c], k - 1]

    return {c: [edge(c, k) for k in cuts[c]] for c in known}


def balance_classes(
    df: DataFrame, label: str, key: Sequence[str], seed: int = 42,
    ratio: float | None = None, algorithm: str = "xxhash64",
) -> DataFrame:
    """Cut both classes to the smaller, or class 0 to ``ratio`` times class 1."""
    sizes = class_sizes(df.filter(col(label).isin(0, 1)), label)
    ones = sizes.get(1, 0)
    allowed = {1: ones, 0: int(ratio * ones)} if ratio is not None else dict.fromkeys((0, 1), min(sizes.get(0, 0), ones))
    drawn = _drawn(df, key, seed, "balance", algorithm)
    cuts = _class_cuts(drawn, label, sizes, {c: [k] for c, k in allowed.items()})
    kept = F.lit(False)
    for c, (edge,) in cuts.items():
        kept = kept | (_is(label, c) & (F.col(_U) <= edge))
    return drawn.filter(kept).drop(_U)


def filter_class(df: DataFrame, extra: DataFrame, label: str, keep: int = 1) -> DataFrame:
    """Add only the extra rows of one class."""
    return df.unionByName(extra.filter(col(label) == keep), allowMissingColumns=True)


def split_ratio(
    df: DataFrame, key: Sequence[str], ratios: Sequence[float] = (0.7, 0.15, 0.15),
    names: Sequence[str] = ("train", "val", "test"), seed: int = 42,
    by: Sequence[str] | None = None, algorithm: str = "xxhash64",
) -> DataFrame:
    """Add ``split`` with exact sizes after a seeded shuffle.

    ``by`` splits groups instead of rows, so twins of one source stay on one side; group
    splits take the hash against the ratios and need no order at all.
    """
    edges, total = [], 0.0
    for r in ratios[:-1]:
        total += r
        edges.append(total)

    if by:
        u = uniform([col(b) for b in by], seed, "split", algorithm)
        out = F.lit(names[-1])
        for name, edge in reversed(list(zip(names, edges))):
            out = F.when(u < F.lit(edge), F.lit(name)).otherwise(out)
        return df.withColumn("split", out)
    drawn = _drawn(df, key, seed, "split", algorithm).withColumn("_all", F.lit(0))
    n = df.count()
    found = _class_cuts(drawn, "_all", {0: n}, {0: [int(n * e) for e in edges]}).get(0, [0.0] * len(edges))
    out = F.lit(names[-1])
    for name, edge in reversed(list(zip(names, found))):
        out = F.when(F.col(_U) <= edge, F.lit(name)).otherwise(out)
    return drawn.withColumn("split", out).drop(_U, "_all")


def split_stratified(
    df: DataFrame, label: str, key: Sequence[str], test: float = 0.25, seed: int = 42,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """Add ``split`` with the test share exact inside every class; a null label is a class."""
    sizes = class_sizes(df, label)
    drawn = _drawn(df, key, seed, "strata", algorithm)
    held = F.lit(False)
    for c, (edge,) in _class_cuts(drawn, label, sizes, {c: [round(n * test)] for c, n in sizes.items()}).items():
        held = held | (_is(label, c) & (F.col(_U) <= edge))
    return drawn.withColumn("split", F.when(held, "test").otherwise("train")).select(*[col(c) for c in df.columns], "split")


def kfold_stratified(
    df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed: int = 42, algorithm: str = "xxhash64"
) -> DataFrame:
    """Add ``fold`` 0..k-1: equal runs of every class in the order of the hash; a null label is a class."""
    sizes = class_sizes(df, label)
    drawn = _drawn(df, key, seed, "folds", algorithm)
    cuts = _class_cuts(drawn, label, sizes, {c: [n * j // k for j in range(1, k)] for c, n in sizes.items()})
    fold = F.lit(None).cast("int")
    for c, edges in cuts.items():
        passed = sum(((F.col(_U) > e).cast("int") for e in edges), F.lit(0))
        fold = F.when(_is(label, c), passed).otherwise(fold)
    return drawn.withColumn("fold", fold).drop(_U)


def kfold_group(
    df: DataFrame, source: str, k: int = 5, seed: int = 42, algorithm: str = "xxhash64"
) -> DataFrame:
    """Add ``fold`` by source, so a source is never on both sides. No shuffle."""
    u = uniform([col(source)], seed, "group", algorithm)
    return df.withColumn("fold", F.floor(u * k).cast("int"))
