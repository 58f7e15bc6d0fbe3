"""Pearson correlation of all pairs, Spearman trend, straight-line fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.functions.stats import stable_round
from sievemark.operators.order import number_rows, running_totals, with_row_id
from sievemark.operators.reshape import number
from sievemark.session import small_frame

# Strength bands of |r|.
STRONG, MODERATE = 0.7, 0.4

#: Columns whose products one task adds up at once: six matrices of 8 MB.
_BLOCK = 1024
_SUMS = ("n", "x", "y", "xx", "yy", "xy")

# Two-sided 5 % points of Student's t for 3 to 41 degrees of freedom.
# Beyond that a correlation of 0.3 is always significant.
T_CRITICAL = (
    3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262, 2.228, 2.201, 2.179, 2.160, 2.145, 2.131,
    2.120, 2.110, 2.101, 2.093, 2.086, 2.080, 2.074, 2.069, 2.064, 2.060, 2.056, 2.052, 2.048,
    2.045, 2.042, 2.040, 2.037, 2.035, 2.032, 2.030, 2.028, 2.026, 2.024, 2.023, 2.021, 2.020,
)
_T_FIRST_DF = 3


def _block_sums(left: np.ndarray, right: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over the rows in which both of a pair are present, a matrix each; NaN is missing."""
    there = [~np.isnan(m) for m in (left, right)]
    x, y = (np.where(t, m, 0.0) for t, m in zip(there, (left, right)))
    shape = (left.shape[1], right.shape[1])
    if there[0].all() and there[1].all():  # no product is needed to know who is present
        wide = lambda v: np.broadcast_to(v[:, None], shape)
        tall = lambda v: np.broadcast_to(v[None, :], shape)
        return {
            "n": np.full(shape, float(len(left))), "x": wide(x.sum(0)), "y": tall(y.sum(0)),
            "xx": wide((x * x).sum(0)), "yy": tall((y * y).sum(0)), "xy": x.T @ y,
        }
    p, q = (t.astype(np.float64) for t in there)
    return {"n": p.T @ q, "x": x.T @ q, "y": p.T @ y, "xx": (x * x).T @ q, "yy": p.T @ (y * y), "xy": x.T @ y}


def _block_frame(df: DataFrame, names: Sequence[str], first: range, second: range) -> DataFrame:
    """(i, j, sums...): one scan of two blocks of centred columns. Each task adds up matrices, batch by batch,
    and gives a row for each pair i < j."""
    used = sorted({*first, *second})
    left, right = [used.index(i) for i in first], [used.index(j) for j in second]
    i, j = (m.ravel() for m in np.meshgrid(first, second, indexing="ij"))
    wanted = np.flatnonzero(i < j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            for name, part in _block_sums(table[:, left], table[:, right]).items():
                total[name] = total[name] + part if name in total else np.array(part)
        if total:
            columns = [pa.array(i[wanted]), pa.array(j[wanted]), *(pa.array(total[s].ravel()[wanted]) for s in _SUMS)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *_SUMS])

    fields = "i long, j long, " + ", ".join(f"{s} double" for s in _SUMS)
    return df.select(*[F.col(names[k]) for k in used]).mapInArrow(run, fields)


def _pair_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col_a, col_b, r) of all pairs over rows where both are present; r is null if either is constant.

    A first scan gives the means, on which columns are centred, so that plain sums of products are
    stable. A second one adds up products of whole blocks of columns with their presence masks, so
    that neither pairs nor gaps add scans: one for up to ``_BLOCK`` columns, then one for each pair of blocks.
    """
    columns = list(columns)
    row = df.agg(*[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    names = [f"c{i}" for i in range(len(columns))]
    means = [row[f"m{i}"] or 0.0 for i in range(len(columns))]
    centred = df.select(*[(number(df, c) - F.lit(m)).alias(n) for c, m, n in zip(columns, means, names)])
    starts = range(0, len(columns), _BLOCK)
    blocks = [range(s, min(s + _BLOCK, len(columns))) for s in starts]
    sums = None
    for k, first in enumerate(blocks):
        for second in blocks[k:]:
            part = _block_frame(centred, names, first, second)
            sums = part if sums is None else sums.unionByName(part)
    total = sums.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    spread = lambda own, square: F.col(square) - F.try_divide(F.col(own) * F.col(own), F.col("n"))
    cov = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    var_x, var_y = spread("x", "xx"), spread("y", "yy")
    # what is left of equal values after rounding is no spread
    label = F.array(*[F.lit(c) for c in columns])
    scale = F.array(*[F.lit(float(m * m)) for m in means])
    floor = lambda square, at: F.lit(1e-12) * F.col(square) + F.lit(1e-29) * F.col("n") * F.element_at(scale, (F.col(at) + 1).cast("int"))
    r = F.when((var_x > floor("xx", "i")) & (var_y > floor("yy", "j")), F.try_divide(cov, F.sqrt(var_x) * F.sqrt(var_y)))
    return total.select(
        F.element_at(label, (F.col("i") + 1).cast("int")).alias("col_a"), F.element_at(label, (F.col("j") + 1).cast("int")).alias("col_b"), r.alias("r")
    )


def correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, k: int | None = None
) -> DataFrame:
    """Pearson r of every numeric pair (or the ``k`` strongest), strongest first; undefined pairs are left out."""
    columns = list(columns or column_classes(df).numeric)
    if len(columns) < 2:
        return small_frame(
            df.sparkSession,
            [], "col_a string, col_b string, pearson_r double, strength string, direction string"
        )
    r = F.col("r")
    rated = _pair_frame(df, columns).filter(r.isNotNull()).select(
        "col_a", "col_b",
        stable_round(r, 6).alias("pearson_r"),
        F.when(F.abs(r) >= STRONG, "strong").when(F.abs(r) >= MODERATE, "moderate")
        .otherwise("weak").alias("strength"),
        F.when(r >= 0, "positive").otherwise("negative").alias("direction"),
    )
    ordered = rated.orderBy(F.desc(F.abs("pearson_r")), "col_a", "col_b")
    return ordered.limit(k) if k else ordered


def heatmap_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lower triangle of the correlation matrix, row below column."""
    columns = list(columns or column_classes(df).numeric)
    return _pair_frame(df, columns).select(
        F.col("col_b").alias("row"), F.col("col_a").alias("col"), "r"
    )


def lookup_pair(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Correlation of (x, y) pairs given in either order."""
    key = [F.least("col_a", "col_b").alias("lo"), F.greatest("col_a", "col_b").alias("hi")]
    known = pairs.select(*key, "pearson_r", "strength")
    asked = wanted.select(
        "x", "y", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")
    )
    return asked.join(known, ["lo", "hi"], "left").select("x", "y", "pearson_r", "strength")


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line over rows with both values, and the x range it is drawn on."""
    a, b = col(x).cast("double"), col(y).cast("double")
    return df.agg(
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        F.count(F.when(a.isNotNull() & b.isNotNull(), 1)).alias("n"),
        F.min(a).alias("x_min"),
        F.max(a).alias("x_max"),
    )


def column_positions(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str]
) -> tuple[DataFrame, dict[str, int]]:
    """((column, value, pos), values per column): each value's place among the non-null ones of its column.

    Rows are numbered once for all columns. The row number is the position in a column without gaps; where there are
    gaps, it is a running count, kept for all such columns together.
    """
    keys = {f"_k{i}": k for i, k in enumerate(order_by)}
    values = {f"_v{i}": c for i, c in enumerate(columns)}
    slim = df.select(*[col(k).alias(n) for n, k in keys.items()], *[number(df, c).alias(n) for n, c in values.items()])
    numbered, rows = number_rows(slim, list(keys))
    numbered = numbered.select("_row_id", *values)
    counts = numbered.agg(*[F.count(v).alias(v) for v in values]).first()
    places = {v: "_row_id" for v in values if counts[v] == rows}
    gappy = {v: f"_p{v}" for v in values if 0 < counts[v] < rows}

    def long(frame: DataFrame, at: dict[str, str]) -> DataFrame:
        cells = [F.struct(F.lit(values[v]).alias("column"), F.col(v).alias("value"), F.col(p).alias("pos")) for v, p in at.items()]
        return frame.select(F.inline(F.array(*cells))).filter("value IS NOT NULL")

    out = long(numbered, places) if places else None
    if gappy:
        flagged = numbered.select("_row_id", *gappy, *[F.col(v).isNotNull().cast("bigint").alias(f"_f{v}") for v in gappy])
        counted = long(running_totals(flagged, {p: f"_f{v}" for v, p in gappy.items()}), gappy)
        out = counted if out is None else out.unionByName(counted)
    if out is None:
        out = small_frame(df.sparkSession, [], "column string, value double, pos bigint")
    return out, {values[v]: counts[v] for v in values if counts[v]}


def spearman_with_order(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """(column, n, rho): rank correlation of each column with its row order.

    With positions p and average ranks k, the sum of p*k only needs, per distinct value,
    its rank, its count and the sum of its positions. So the rows are grouped by value
    before ranks exist and no ranked rows are joined back: a value held by a third of all
    rows stays one row of the grouped table.
    """
    columns = list(columns or column_classes(df).numeric)
    placed, counts = column_positions(df, order_by, columns)
    freq = placed.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(F.col("pos").cast("double")).alias("sum_pos")
    )
    ranked = running_totals(with_row_id(freq, ["column", "value"]), {"upto": "cnt"}).withColumn(
        "avg_rank", F.col("upto") - (F.col("cnt") - 1) / 2
    )
    # One row per column. Ranks run on from column to column, positions start anew.
    before, centres = 0, []
    for c in sorted(counts):
        centres.append((c, counts[c], (counts[c] + 1) / 2, before + (counts[c] + 1) / 2))
        before += counts[c]
    centre = small_frame(df.sparkSession, centres, "column string, n bigint, mid_pos double, mid_rank double")
    d = F.col("avg_rank") - F.col("mid_rank")
    sums = ranked.join(F.broadcast(centre), "column").groupBy("column", "n").agg(
        F.sum(d * (F.col("sum_pos") - F.col("cnt") * F.col("mid_pos"))).alias("cov"),
        F.sum(F.col("cnt") * d * d).alias("var_rank"),
    )
    n = F.col("n").cast("double")
    var_pos = n * (n * n - 1) / 12
    return sums.select(
        "column", "n",
        F.try_divide(F.col("cov"), F.sqrt(F.col("var_rank") * var_pos)).alias("rho"),
    )


def trend_labels(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """increasing / decreasing / flat per column, null under 5 values."""
    edges = " ".join(
        f"WHEN {df_ + 2} THEN {t / (df_ + t * t) ** 0.5!r}D" for df_, t in enumerate(T_CRITICAL, _T_FIRST_DF)
    )
    critical = F.expr(f"CASE n {edges} ELSE 0.0D END")
    rho = F.col("rho")
    return spearman_with_order(df, order_by, columns).select(
        "column", "n", "rho",
        F.when(F.col("n") < 5, None)
        .when(F.abs(rho) < critical, "flat")
        .when(rho > 0.3, "increasing")
        .when(rho < -0.3, "decreasing")
        .otherwise("flat").alias("trend"),
    )


def trend_halves(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Trend by comparing the means of the first and second half of the values."""
    columns = list(columns or column_classes(df).numeric)
    placed, counts = column_positions(df, order_by, columns)
    span = small_frame(df.sparkSession, list(counts.items()), "column string, n bigint")
    early = F.col("pos") <= F.floor(F.col("n") / 2)
    means = placed.join(F.broadcast(span), "column").groupBy("column", "n").agg(
        F.avg(F.when(early, F.col("value"))).alias("first_mean"),
        F.avg(F.when(~early, F.col("value"))).alias("second_mean"),
    )
    diff = F.col("second_mean") - F.col("first_mean")
    return means.select(
        "column", "n", "first_mean", "second_mean",
        F.when(F.col("n") < 5, None)
        .when(F.abs(diff) < 0.05 * (F.abs("first_mean") + 1e-9), "flat")
        .when(diff > 0, "increasing").otherwise("decreasing").alias("trend"),
    )
