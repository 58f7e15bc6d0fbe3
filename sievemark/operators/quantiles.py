"""Exact linear-interpolated quantiles without a shuffle of the data.

One scan builds a mergeable quantile sketch of every column and counts its values. The sketch
proposes an interval around each wanted order statistic that its error bound makes
narrow; a second scan counts the values under, inside and over every interval, and a third sorts what lies
inside. Where that is still too much to sort, a sketch of the inside narrows the interval
first. The sketch only proposes; the counts decide, so the answer is exact, and a
value that fills a third of the rows ends up as the answer or as an excluded edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.operators.reshape import number
from sievemark.session import small_frame

INSIDE_LIMIT = 500_000  # values of an interval that may be sorted in one task
_FINEST, _COARSEST = 10_000, 500  # reciprocal rank error of a sketch, by the number of columns
_GRID = 1_000  # fractions asked of the sketch of an interval lie on a grid of so many
_OBJECT_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


@dataclass(frozen=True)
class _Interval:
    """Open interval (low, high) of one column that holds the given ranks."""

    column: str
    ranks: tuple[int, ...]
    low: float | None
    high: float | None
    below: int  # values at or under low
    inside: int


def _pairs(df: DataFrame) -> DataFrame:
    names = [col(c) for c in df.columns]
    return df.unpivot([], names, "column", "value").filter("value IS NOT NULL")


def _numbered(intervals: list[_Interval]) -> dict[str, list[_Interval]]:
    out: dict[str, list[_Interval]] = {}
    for b in intervals:
        out.setdefault(b.column, []).append(b)
    return out


def _held_values(df: DataFrame, intervals: list[_Interval]) -> DataFrame:
    """(column, slot, value) of the values inside any interval of their column.

    Intervals of a column do not overlap, so a value has at most one slot. The bounds
    come from a broadcast row per column, which keeps the generated code as small as one
    column needs.
    """
    grouped = _numbered(intervals)
    slots = max(map(len, grouped.values()))
    rows = []
    for c, bs in grouped.items():
        padded = [(b.low, b.high) for b in bs] + [(None, None)] * (slots - len(bs))
        rows.append((c, len(bs), *[x for pair in padded for x in pair]))
    schema = "column string, slots int, " + ", ".join(f"low{j} double, high{j} double" for j in range(slots))
    bounds = small_frame(df.sparkSession, rows, schema)
    v, slot = F.col("value"), F.lit(None).cast("int")
    for j in range(slots):
        mine = (
            (F.col("slots") > j)
            & (F.col(f"low{j}").isNull() | (v > F.col(f"low{j}")))
            & (F.col(f"high{j}").isNull() | (v < F.col(f"high{j}")))
        )
        slot = F.when(mine, F.lit(j)).otherwise(slot)
    kept = _pairs(df.select(*[col(c) for c in grouped])).join(F.broadcast(bounds), "column")
    return kept.select("column", slot.alias("slot"), "value").filter("slot IS NOT NULL")


@contextmanager
def _many_groups(spark: SparkSession, groups: int) -> Iterator[None]:
    """Let a task keep that many sketches before it falls back to sorting its rows."""
    before = spark.conf.get(_OBJECT_GROUPS)
    spark.conf.set(_OBJECT_GROUPS, str(max(int(before), 2 * groups)))
    try:
        yield
    finally:
        spark.conf.set(_OBJECT_GROUPS, before)


def _accuracy(groups: int) -> int:
    """Finer for few columns, so that the sketches of a task stay at some megabytes."""
    return max(_COARSEST, min(_FINEST, 1_000_000 // groups))


def _propose(df: DataFrame, intervals: list[_Interval]) -> list[list[float]]:
    """Edges around the wanted ranks, read off a sketch of the values inside each interval."""
    accuracy = _accuracy(len(intervals))
    wanted: list[set[float]] = []
    for b in intervals:
        at = [(r - b.below) / b.inside for r in b.ranks]
        slack = 2 / accuracy
        wanted.append({max(0, math.floor((x - slack) * _GRID)) / _GRID for x in at} | {min(_GRID, math.ceil((x + slack) * _GRID)) / _GRID for x in at})
    fractions = sorted(set().union(*wanted))
    sketched = _held_values(df, intervals).groupBy("column", "slot").agg(F.percentile_approx("value", fractions, accuracy).alias("at"))
    with _many_groups(df.sparkSession, len(intervals)):
        found = {(r["column"], r["slot"]): dict(zip(fractions, r["at"])) for r in sketched.collect()}
    slots = {id(b): (c, j) for c, bs in _numbered(intervals).items() for j, b in enumerate(bs)}
    return [sorted(found[slots[id(b)]][x] for x in xs) for b, xs in zip(intervals, wanted)]


def _narrow(
    df: DataFrame, intervals: list[_Interval], proposed: list[list[float]], answers: dict
) -> list[_Interval]:
    """Count the zones between all proposed edges and move each rank into its zone."""
    edges: dict[str, list[float]] = {}
    for c, bs in _numbered(intervals).items():
        points = {e for b, found in zip(intervals, proposed) if b.column == c for e in found}
        points |= {e for b in bs for e in (b.low, b.high) if e is not None}
        edges[c] = sorted(points)
    most = max(map(len, edges.values()))
    bounds = small_frame(
        df.sparkSession,
        [(c, *es, *[None] * (most - len(es))) for c, es in edges.items()],
        "column string, " + ", ".join(f"e{i} double" for i in range(most)),
    )
    # Zone 2i lies before edge i and zone 2i + 1 on it.
    zone = F.lit(0)
    for i in range(most):
        e = F.col(f"e{i}")
        zone = zone + F.coalesce((F.col("value") >= e).cast("int") + (F.col("value") > e).cast("int"), F.lit(0))
    # One scan for all columns; a few rows per column come back.
    coded = _pairs(df.select(*[col(c) for c in edges])).join(F.broadcast(bounds), "column").select(
        "column", zone.alias("zone")
    )
    sizes = {c: [0] * (2 * len(es) + 1) for c, es in edges.items()}
    for r in coded.groupBy("column", "zone").count().collect():
        sizes[r["column"]][r["zone"]] = r["count"]
    out = []
    for c, es in edges.items():
        ranks = sorted({r for b in intervals if b.column == c for r in b.ranks})
        start = 0
        for zone, size in enumerate(sizes[c]):
            held = tuple(r for r in ranks if start <= r < start + size)
            if held and zone % 2:
                answers.update({(c, r): es[zone // 2] for r in held})
            elif held:
                low = es[zone // 2 - 1] if zone else None
                high = es[zone // 2] if zone // 2 < len(es) else None
                out.append(_Interval(c, held, low, high, start, size))
            start += size
    return out


def _select(df: DataFrame, intervals: list[_Interval], answers: dict) -> None:
    """Sort what is left of each interval, at most ``INSIDE_LIMIT`` values, and read the wanted places."""
    numbered = [(c, j, b) for c, bs in _numbered(intervals).items() for j, b in enumerate(bs)]
    asked = small_frame(
        df.sparkSession, [(c, j, [r - b.below + 1 for r in b.ranks]) for c, j, b in numbered], "column string, slot int, places array<int>"
    )
    rows = (
        _held_values(df, intervals).groupBy("column", "slot").agg(F.sort_array(F.collect_list("value")).alias("sorted"))
        .join(F.broadcast(asked), ["column", "slot"])
        .select("column", "slot", F.transform("places", lambda p: F.element_at("sorted", p)).alias("v"))
    )
    with _many_groups(df.sparkSession, len(intervals)):
        found = {(r["column"], r["slot"]): r["v"] for r in rows.collect()}
    for c, j, b in numbered:
        answers.update({(c, k): v for k, v in zip(b.ranks, found[c, j])})


def _settle(df: DataFrame, open_: list[_Interval], answers: dict, inside: int) -> None:
    """Answer the ranks of all intervals."""
    while open_:
        few = [b for b in open_ if b.inside <= inside]
        many = [b for b in open_ if b.inside > inside]
        if few:
            _select(df, few, answers)
        open_ = _narrow(df, many, _propose(df, many), answers) if many else []


def order_statistics(
    df: DataFrame, wanted: dict[str, set[int]], sizes: dict[str, int], inside: int = INSIDE_LIMIT
) -> dict[tuple[str, int], float]:
    """{(column, rank): value} for 0-based ranks among the ``sizes`` non-null doubles of each column."""
    answers: dict[tuple[str, int], float] = {}
    _settle(df, [_Interval(c, tuple(sorted(rs)), None, None, 0, sizes[c]) for c, rs in wanted.items()], answers, inside)
    return answers


@dataclass(frozen=True)
class Sketch:
    """Of each column: the number of values, the edges proposed for ``probs``, and further aggregates."""

    probs: tuple[float, ...]
    sizes: dict[str, int]
    edges: dict[str, list[float]]
    also: dict[str, dict[str, object]] = field(default_factory=dict)


def sketch(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], also: Mapping[str, Column] | None = None
) -> Sketch:
    """One scan of all columns: their sketches, their counts, and aggregates over ``value`` under the given names."""
    columns, also = list(columns), dict(also or {})
    accuracy = _accuracy(len(columns) or 1)
    share = 2 / accuracy  # the edges themselves are off by one part in the accuracy
    fractions = sorted({x for p in probs for x in (max(0.0, p - share), min(1.0, p + share))})
    if not columns:
        return Sketch(tuple(probs), {}, {}, {})
    numbers = df.select(*[number(df, c).alias(c) for c in columns])
    asked = F.percentile_approx("value", fractions, accuracy) if fractions else F.lit(None)
    grouped = numbers.unpivot([], [col(c) for c in columns], "column", "value").groupBy("column").agg(
        F.count("value").alias("__n"), asked.alias("__at"), *[e.alias(n) for n, e in also.items()]
    )
    with _many_groups(df.sparkSession, len(columns)):
        rows = {r["column"]: r for r in grouped.collect()}
    there = lambda c, n: rows[c][n] if c in rows else None  # noqa: E731  no row at all in an empty table
    return Sketch(
        tuple(probs), {c: there(c, "__n") or 0 for c in columns}, {c: sorted(set(there(c, "__at") or ())) for c in columns},
        {c: {n: there(c, n) for n in also} for c in columns},
    )


def quantiles_of(
    df: DataFrame, found: Sketch, columns: Sequence[str], inside: int = INSIDE_LIMIT
) -> dict[tuple[str, float], float | None]:
    """{(column, p): value} from a sketch of the same rows; None for a column without values."""
    columns, sizes = list(columns), found.sizes
    places = {(c, p): p * (sizes[c] - 1) for c in columns for p in found.probs if sizes[c]}
    open_ = []
    for c in columns:
        ranks = sorted({k for p in found.probs if sizes[c] for k in (math.floor(places[c, p]), math.ceil(places[c, p]))})
        if ranks:
            open_.append(_Interval(c, tuple(ranks), None, None, 0, sizes[c]))
    answers: dict[tuple[str, int], float] = {}
    if open_:
        numbers = df.select(*[number(df, b.column).alias(b.column) for b in open_])
        _settle(numbers, _narrow(numbers, open_, [found.edges[b.column] for b in open_], answers), answers, inside)

    def interpolated(c: str, p: float) -> float | None:
        if not sizes[c]:
            return None
        low, high = math.floor(places[c, p]), math.ceil(places[c, p])
        return answers[c, low] + (places[c, p] - low) * (answers[c, high] - answers[c, low])

    return {(c, p): interpolated(c, p) for c in columns for p in found.probs}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], inside: int = INSIDE_LIMIT
) -> dict[tuple[str, float], float | None]:
    """{(column, p): value}; None for a column without values. Three scans, whatever the number of columns."""
    probs = [float(p) for p in probs]
    return quantiles_of(df, sketch(df, columns, probs), columns, inside)


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000
) -> dict[tuple[str, float], float | None]:
    """One-pass quantiles within ``1/accuracy`` of the rank."""
    row = df.agg(*[
        F.percentile_approx(col(c).cast("double"), [float(p) for p in probs], accuracy).alias(f"q{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {
        (c, p): (row[f"q{i}"][j] if row[f"q{i}"] else None)
        for i, c in enumerate(columns)
        for j, p in enumerate(probs)
    }


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Long form (column, prob, value), one row per column and probability."""
    found = exact_quantiles(df, columns, probs)
    return small_frame(
        df.sparkSession,
        [(c, float(p), v) for (c, p), v in found.items()],
        "column string, prob double, value double",
    )
