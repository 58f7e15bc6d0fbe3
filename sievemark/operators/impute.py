"""Fill values chosen from one pass of statistics, applied as constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col, column_classes
from sievemark.functions.stats import skew_adjusted
from sievemark.operators.categorical import column_modes
from sievemark.operators.profile import fences_of, quartile_map
from sievemark.operators.outliers import outside
from sievemark.operators.quantiles import Sketch, approx_quantiles, exact_quantiles, quantiles_of, sketch
from sievemark.session import small_frame

# When a mean is a fair fill.
MIN_SKEW_VALUES = 8
SKEW_LIMIT = 0.5
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Fill:
    column: str
    strategy: str
    value: object
    filled: int


def _numeric_state(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, tuple], Sketch]:
    """((missing, present, mean, skew) per column, sketch for their medians) from one scan."""
    v = F.col("value")
    scanned = sketch(df, columns, [0.5], {"rows": F.count(F.lit(1)), "mean": F.avg(v), "skew": skew_adjusted(v)})
    state = {c: ((a["rows"] or 0) - scanned.sizes[c], scanned.sizes[c], a["mean"], a["skew"]) for c, a in scanned.also.items()}
    return state, scanned


def choose_fill(present: int, skew: float | None) -> str:
    """Mean for roughly symmetric columns with enough values, else median."""
    return "mean" if present >= MIN_SKEW_VALUES and skew is not None and abs(skew) < SKEW_LIMIT else "median"


def fill_plan(
    df: DataFrame, strategy: str = "smart", approximate: bool = False
) -> list[Fill]:
    """What goes into each column that has gaps; the plan is one entry per column."""
    classes = column_classes(df)
    state, scanned = _numeric_state(df, classes.numeric)
    gaps = [c for c in classes.numeric if state[c][0] and state[c][1]]
    chosen = {
        c: strategy if strategy in ("mean", "median") else choose_fill(state[c][1], state[c][3])
        for c in gaps
    }
    by_median = [c for c in gaps if chosen[c] == "median"]
    if approximate and by_median:
        medians = approx_quantiles(df, by_median, [0.5])
    else:
        medians = quantiles_of(df, scanned, by_median)
    plan = [
        Fill(c, chosen[c], state[c][2] if chosen[c] == "mean" else medians[c, 0.5], state[c][0])
        for c in gaps
    ]
    if strategy == "smart":
        plan += _category_fills(df, classes.categorical)
    return plan


def _category_fills(df: DataFrame, columns: Sequence[str]) -> list[Fill]:
    if not columns:
        return []
    row = df.agg(*[F.count_if(col(c).isNull()).alias(f"g{i}") for i, c in enumerate(columns)]).first()
    gaps = {c: row[f"g{i}"] for i, c in enumerate(columns) if row[f"g{i}"]}
    if not gaps:
        return []
    # One row per column with gaps comes back.
    modes = {r["column"]: r["mode"] for r in column_modes(df, list(gaps)).collect()}
    return [
        Fill(c, "mode" if c in modes else "unknown_fallback", modes.get(c, UNKNOWN), n)
        for c, n in gaps.items()
    ]


def apply_fills(df: DataFrame, plan: Sequence[Fill]) -> DataFrame:
    """Put the planned constants into the gaps; filled numbers are doubles."""
    by_column: Mapping[str, Fill] = {f.column: f for f in plan}
    numeric = set(column_classes(df).numeric)
    out = []
    for f in df.schema.fields:
        fill = by_column.get(f.name)
        if fill is None:
            out.append(col(f.name))
        elif f.name in numeric:
            out.append(F.coalesce(col(f.name).cast("double"), F.lit(float(fill.value))).alias(f.name))
        else:
            kind = T.StringType() if fill.strategy == "unknown_fallback" else f.dataType
            out.append(
                F.coalesce(col(f.name).cast(kind), F.lit(str(fill.value)).cast(kind)).alias(f.name)
            )
    return df.select(*out)


def fill_missing(
    df: DataFrame, strategy: str = "smart", approximate: bool = False
) -> DataFrame:
    return apply_fills(df, fill_plan(df, strategy, approximate))


def fill_log(df: DataFrame, plan: Sequence[Fill]) -> DataFrame:
    """(column, strategy, fill_value, filled) of a plan."""
    return small_frame(
        df.sparkSession,
        [
            (f.column, f.strategy, str(round(f.value, 4)) if isinstance(f.value, float) else str(f.value), f.filled)
            for f in plan
        ],
        "column string, strategy string, fill_value string, filled bigint",
    )


def global_fills(df: DataFrame) -> list[Fill]:
    """One plan from all rows, for parts of a table that are filled separately."""
    return fill_plan(df, "median")


def train_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Medians of the training rows only, to fill any split with."""
    found = exact_quantiles(train, columns, [0.5])
    return {c: v for (c, _), v in found.items() if v is not None}


def fill_constants(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.select(*[
        F.coalesce(col(c).cast("double"), F.lit(float(values[c]))).alias(c) if c in values else col(c)
        for c in df.columns
    ])


def fill_feature_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null features take the mean over all rows, both classes together."""
    row = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return fill_constants(
        df, {c: row[f"m{i}"] for i, c in enumerate(columns) if row[f"m{i}"] is not None}
    )


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    sequential: bool = False,
    keep_nulls: bool = True,
) -> DataFrame:
    """Rows inside the IQR fences of every numeric column.

    The default takes all fences from the whole table: one quantile step, one filter.
    ``sequential`` recomputes the fences of each column on what earlier columns left,
    which costs one quantile step per column.
    """
    columns = list(columns or column_classes(df).numeric)

    def inside(frame: DataFrame, names: Sequence[str]) -> DataFrame:
        quartiles = quartile_map(frame, names)
        for c in names:
            x = col(c).cast("double")
            bad = outside(x, *fences_of(quartiles[c][0], quartiles[c][2]))
            frame = frame.filter(~bad if keep_nulls else (x.isNotNull() & ~bad))
        return frame

    if not sequential:
        return inside(df, columns)
    for c in columns:
        df = inside(df, [c])
    return df
