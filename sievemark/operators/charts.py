"""Chart data: the small aggregate a plotting client needs, and which charts to draw."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.operators.categorical import top_values
from sievemark.operators.correlation import heatmap_cells, linear_fit
from sievemark.operators.grouped import group_mean_nlargest, group_mean_top, other_bucket
from sievemark.operators.order import with_row_id
from sievemark.operators.outliers import FLAG, flag_outliers
from sievemark.operators.profile import fences_of, numeric_pairs, quartile_frame, quartile_map, sized_quartiles
from sievemark.operators.reshape import number
from sievemark.operators.rows import filter_equals, filter_pairwise
from sievemark.session import small_frame


def auto_bins(n: int, low: float, high: float, q1: float, q3: float) -> int:
    """Bin count as the larger of the Freedman-Diaconis and Sturges rules."""
    if not n or high <= low:
        return 1
    sturges = (high - low) / (math.log2(n) + 1)
    diaconis = 2 * (q3 - q1) / n ** (1 / 3)
    width = min(sturges, diaconis) if diaconis > 0 else sturges
    return max(1, math.ceil((high - low) / width))


def hist_bins(
    df: DataFrame, column: str, bins: int | None = None
) -> DataFrame:
    """(bin, low, high, count, outliers) of one numeric column, empty bins left out."""
    x, v = number(df, column), F.col("value")
    found, scanned = sized_quartiles(df, [column], {"n": F.count(v), "lo": F.min(v), "hi": F.max(v)})
    quartiles, row = found[column], scanned.also[column]
    if not row["n"]:
        return small_frame(
            df.sparkSession, [], "bin int, low double, high double, count bigint, outliers bigint"
        )
    low, high = row["lo"], row["hi"]
    n_bins = bins or auto_bins(row["n"], low, high, quartiles[0], quartiles[2])
    width = (high - low) / n_bins if high > low else 1.0
    fence_low, fence_high = fences_of(quartiles[0], quartiles[2])
    place = F.least(F.floor((x - low) / width), F.lit(n_bins - 1)).cast("int")
    return df.filter(x.isNotNull()).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if((x < fence_low) | (x > fence_high)).alias("outliers"),
    ).select(
        "bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"),
        "count", "outliers",
    )


def bar_topn(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    return top_values(df, column, k)


def pie_share(df: DataFrame, column: str, k: int = 8) -> DataFrame:
    return other_bucket(df, column, k)


def grouped_bar(df: DataFrame, category: str, number: str, k: int = 10) -> DataFrame:
    return group_mean_top(df, category, number, k)


def counts_top20(df: DataFrame, column: str) -> DataFrame:
    return top_values(df.select(col(column).cast("string").alias(column)), column, 20)


def line_rowindex(
    df: DataFrame, column: str, order_by: Sequence[str], run: int = 1
) -> DataFrame:
    """(point, first_index, mean, count): non-null values over their own row index.

    Every value is a point; ``run`` averages that many neighbours instead.
    """
    kept = df.filter(col(column).isNotNull()).select(
        *[col(k).alias(f"_k{i}") for i, k in enumerate(order_by)], col(column).cast("double").alias("y")
    )
    numbered = with_row_id(kept, [f"_k{i}" for i in range(len(order_by))])
    index = F.col("_row_id") - 1
    return numbered.groupBy(F.floor(index / F.lit(run)).alias("point")).agg(
        F.min(index).alias("first_index"), F.avg("y").alias("mean"), F.count("y").alias("count")
    )


def timeseries(df: DataFrame, ts: str, number: str, unit: str | None = None) -> DataFrame:
    """(time, value) sorted by time; with a unit, one averaged row per unit of time."""
    pairs = df.select(col(ts).alias("time"), col(number).cast("double").alias("value")).na.drop()
    if unit:
        pairs = pairs.groupBy(F.date_trunc(unit, "time").alias("time")).agg(F.avg("value").alias("value"))
    return pairs.orderBy("time", "value")


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the furthest values inside the fences, points beyond."""
    bounds = quartile_frame(df, quartile_map(df, columns))
    v = F.col("value")
    inside = (v >= F.col("low")) & (v <= F.col("high"))
    return numeric_pairs(df, columns).filter(v.isNotNull()).join(F.broadcast(bounds), "column").groupBy("column").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("beyond"),
        F.try_divide(F.count_if(~inside), F.count(v)).alias("extreme_ratio"),
    )


def scatter_points(
    df: DataFrame, x: str, y: str, points: int | None = None, seed: int = 42
) -> DataFrame:
    """(x, y, _is_outlier): all points, or a seeded sample of so many for drawing."""
    flagged = flag_outliers(df).select(
        col(x).cast("double").alias("x"), col(y).cast("double").alias("y"), FLAG
    ).na.drop(subset=["x", "y"])
    return flagged.orderBy(F.xxhash64("x", "y", F.lit(seed)), "x", "y").limit(points) if points else flagged


def scatter_summary(df: DataFrame, x: str, y: str) -> DataFrame:
    """(_is_outlier, n) over all drawable points."""
    return flag_outliers(df).na.drop(subset=[x, y]).groupBy(FLAG).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class ChartLimits:
    """What is worth drawing; a number of charts is unlimited unless the caller sets it."""

    histograms: int | None = None
    trends: int | None = None
    scatters: int | None = None
    scatter_r: float = 0.4
    boxes: int | None = None
    categories: int | None = None
    pie_max: int = 8
    bar_max: int = 30
    grouped: int | None = None
    grouped_range: tuple[int, int] = (2, 15)
    time_columns: int | None = None
    time_numbers: int | None = None


def chart_select(
    df: DataFrame,
    profile: DataFrame,
    correlations: DataFrame,
    distinct: DataFrame,
    limits: ChartLimits = ChartLimits(),
) -> DataFrame:
    """(chart_id, chart_type, title, columns_used) from the profile tables.

    The tables have a row per column or pair; first-N choices follow the table's own
    column order, which is known from the schema.
    """
    classes = column_classes(df)
    numeric = [c for c in classes.chart_numeric if c != FLAG]
    dates = list(classes.datetime)
    cats = [c for c in df.columns if c not in numeric and c not in dates and c != FLAG]
    spark = df.sparkSession
    place = lambda names: small_frame(
        spark, [(c, i) for i, c in enumerate(names)], "column string, position int"
    )

    def charts(frame: DataFrame, prefix: str, kind: str, title: str, *names) -> DataFrame:
        used = [F.col(n) if isinstance(n, str) else n for n in names]
        return frame.select(
            F.concat_ws("_", F.lit(prefix), *used).alias("chart_id"), F.lit(kind).alias("chart_type"),
            F.format_string(title, *used).alias("title"), F.concat_ws(",", *used).alias("columns_used"),
        )

    first = lambda frame, n: frame if n is None else frame.limit(n)
    out = charts(place(numeric[: limits.histograms]), "hist", "histogram", "Distribution of %s", "column")
    trending = profile.filter(F.col("trend").isin("increasing", "decreasing")).join(place(numeric), "column")
    out = out.unionByName(charts(
        first(trending.orderBy("position"), limits.trends), "line", "line", "Trend of %s", "column"
    ))
    paired = first(correlations.filter(F.abs("pearson_r") >= limits.scatter_r).orderBy(
        F.desc(F.abs("pearson_r")), "col_a", "col_b"
    ), limits.scatters)
    out = out.unionByName(charts(paired, "scatter", "scatter", "%s against %s", "col_a", "col_b"))
    fixed = []
    if len(numeric) >= 2:
        fixed.append(("correlation_heatmap", "heatmap", "Correlation heatmap", ",".join(numeric)))
    if numeric:
        fixed.append(("boxplot_numeric", "box", "Box plots of numeric columns", ",".join(numeric[: limits.boxes])))
    schema = "chart_id string, chart_type string, title string, columns_used string"
    for ts in dates[: limits.time_columns]:
        for n in numeric[: limits.time_numbers]:
            fixed.append((f"ts_{ts}_{n}", "line", f"{n} over {ts}", f"{ts},{n}"))
    out = out.unionByName(small_frame(spark, fixed, schema))
    counted = place(cats).join(distinct, "column")
    early = counted if limits.categories is None else counted.filter(F.col("position") < limits.categories)
    n = F.col("n_distinct")
    out = out.unionByName(charts(
        early.filter((n > 0) & (n <= limits.pie_max)), "pie", "pie", "Share of %s", "column"
    )).unionByName(charts(
        early.filter((n > limits.pie_max) & (n <= limits.bar_max)), "bar", "bar", "Top values of %s", "column"
    ))
    if numeric:
        ranged = first(counted.filter(n.between(*limits.grouped_range)).orderBy("position"), limits.grouped)
        out = out.unionByName(charts(
            ranged, "grouped", "bar", "By %s: mean of %s", "column", F.lit(numeric[0])
        ))
    return out


def attach_stats(charts: DataFrame, profile: DataFrame) -> DataFrame:
    """Each chart with the statistics of its first column; the profile is a row per column."""
    first = F.element_at(F.split("columns_used", ","), 1)
    return charts.withColumn("column", first).join(F.broadcast(profile), "column", "left")


@dataclass(frozen=True)
class PlotSpec:
    chart_type: str
    x: str | None = None
    y: str | None = None
    filters: Mapping[str, object] = field(default_factory=dict)


def custom_chart_data(
    df: DataFrame, kind: str, columns: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Data of a named chart kind over matched columns, with the usual fallbacks."""
    numeric = [c for c in columns if c in column_classes(df).numeric]
    if kind == "scatter" and len(numeric) < 2:
        kind = "histogram"
    if kind == "scatter":
        return scatter_points(filter_pairwise(df, *numeric[:2]), *numeric[:2])
    if kind == "line" and numeric:
        return line_rowindex(df, numeric[0], order_by)
    if kind == "heatmap" and len(numeric) >= 2:
        return heatmap_cells(df, numeric)
    if kind == "box" and numeric:
        return box_stats(df, numeric)
    if kind == "pie":
        return pie_share(df, columns[0])
    if kind == "bar" and len(columns) >= 2 and numeric:
        category = next(c for c in columns if c != numeric[-1])
        return group_mean_nlargest(df, category, numeric[-1])
    if kind == "histogram" and numeric:
        return hist_bins(df, numeric[0])
    return counts_top20(df, columns[0])


def execute_spec(df: DataFrame, spec: PlotSpec, order_by: Sequence[str] = ()) -> DataFrame:
    """Filters first, then the chart's aggregate over what is left."""
    named = [c for c in (spec.x, spec.y) if c]
    return custom_chart_data(filter_equals(df, spec.filters), spec.chart_type, named, order_by)
