"""Column types inferred from text, with the thresholds each step uses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.casts import number_prefix, to_boolean, to_number, to_timestamp
from sievemark.functions.columns import col, column_classes, logical_type
from sievemark.operators.reshape import as_pairs, one_row_to_long
from sievemark.session import small_frame

# Share of all rows, nulls included, that must parse as numbers.
SCOUT_SHARE = 0.70
HINT_SHARE = 0.10
CLEAN_SHARE = 0.20

# Name parts that mark a text column as numeric while cleaning.
NUMERIC_NAME_HINTS = (
    "age", "salary", "price", "cost", "amount", "revenue", "score", "rating", "years",
    "experience", "count", "total", "quantity", "id", "year", "month", "day",
)

# Scores of the parse check.
CONSISTENCY_CAP = 0.99
UNTYPED_CONSISTENCY = 0.95


@dataclass(frozen=True)
class ParseCounts:
    rows: int
    present: int
    numbers: int
    timestamps: int

    def number_share(self) -> float:
        return self.numbers / self.rows if self.rows else 0.0


def parse_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, ParseCounts]:
    """How many values of each text column parse, all columns in one scan."""
    if not columns:
        return {}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs += [
            F.count(col(c)).alias(f"p{i}"),
            F.count(to_number(col(c))).alias(f"n{i}"),
            F.count(to_timestamp(col(c))).alias(f"t{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        c: ParseCounts(row["rows"], row[f"p{i}"], row[f"n{i}"], row[f"t{i}"])
        for i, c in enumerate(columns)
    }


def _recast(df: DataFrame, casts: Mapping[str, Column]) -> DataFrame:
    return df.select(*[casts[c].alias(c) if c in casts else col(c) for c in df.columns])


def infer_types(df: DataFrame, share: float = SCOUT_SHARE) -> DataFrame:
    """Text columns become timestamps if every value parses, numbers if enough do."""
    counts = parse_counts(df, column_classes(df).text)
    casts: dict[str, Column] = {}
    for c, n in counts.items():
        if n.present and n.timestamps == n.present and n.numbers < n.present:
            casts[c] = to_timestamp(col(c))
        elif n.number_share() > share:
            casts[c] = to_number(col(c))
    return _recast(df, casts)


def inferred_type_table(df: DataFrame, share: float = SCOUT_SHARE) -> DataFrame:
    """(column, logical_type) after inference."""
    typed = infer_types(df, share)
    return small_frame(
        df.sparkSession,
        [(f.name, logical_type(f.dataType)) for f in typed.schema.fields],
        "column string, logical_type string",
    )


def apply_hints(df: DataFrame, hints: Mapping[str, str], share: float = HINT_SHARE) -> DataFrame:
    """Cast columns to hinted types unless a numeric cast would lose almost everything."""
    texts = set(column_classes(df).text)
    wanted = [c for c, t in hints.items() if c in texts and t in ("integer", "float", "numeric")]
    counts = parse_counts(df, wanted)
    casts: dict[str, Column] = {}
    for c, hint in hints.items():
        if c not in df.columns:
            continue
        if c in counts:
            if counts[c].number_share() > share or counts[c].present == 0:
                casts[c] = to_number(col(c))
        elif hint == "datetime" and c in texts:
            casts[c] = to_timestamp(col(c))
        elif hint == "boolean":
            casts[c] = to_boolean(col(c))
    return _recast(df, casts)


def hinted_numeric(name: str) -> bool:
    return any(h in name.lower() for h in NUMERIC_NAME_HINTS)


def coerce_numeric(df: DataFrame, share: float = CLEAN_SHARE) -> DataFrame:
    """Cleaning-time cast: enough values parse, or the name says number and any does."""
    counts = parse_counts(df, column_classes(df).text)
    return _recast(df, {
        c: to_number(col(c))
        for c, n in counts.items()
        if n.number_share() > share or (hinted_numeric(c) and n.numbers > 0)
    })


def prefix_numeric(df: DataFrame, columns: Sequence[str], share: float = 0.8) -> DataFrame:
    """(column, filled, numbers, is_numeric) by the leading-number test of the viewer."""
    aggs = []
    for i, c in enumerate(columns):
        t = F.trim(col(c).cast("string"))
        filled = F.when(t != "", t)
        aggs += [F.count(filled).alias(f"f{i}"), F.count(number_prefix(filled)).alias(f"n{i}")]
    return one_row_to_long(df.agg(*aggs), [
        {
            "column": F.lit(c), "filled": F.col(f"f{i}"), "numbers": F.col(f"n{i}"),
            "is_numeric": F.coalesce(
                F.try_divide(F.col(f"n{i}"), F.col(f"f{i}")) > share, F.lit(False)
            ),
        }
        for i, c in enumerate(columns)
    ])


def mixed_type_columns(
    df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = ()
) -> DataFrame:
    """Text columns whose present values parse in part, judged on all of them."""
    columns = list(columns or column_classes(df).text)
    pairs = as_pairs(df, columns, "string", keep=list(groups)).filter(F.col("value").isNotNull())
    tested = pairs.groupBy(*groups, "column").agg(
        F.count(F.lit(1)).alias("present"), F.count(to_number(F.col("value"))).alias("parsed")
    )
    return tested.withColumn(
        "mixed", (F.col("parsed") > 0) & (F.col("parsed") < F.col("present"))
    )


def type_consistency(before: DataFrame, typed: DataFrame) -> DataFrame:
    """Share of cells in typed columns that are null or parse, measured on the text.

    ``typed`` is the inferred version of ``before``; only its schema is used.
    """
    targets = {
        f.name: logical_type(f.dataType) for f in typed.schema.fields
        if logical_type(f.dataType) in ("integer", "float", "datetime")
    }
    texts = set(column_classes(before).text)
    rows = F.count(F.lit(1))
    if not targets:
        return before.agg(
            F.when(rows > 0, F.lit(UNTYPED_CONSISTENCY)).otherwise(F.lit(0.0)).alias("consistency")
        )
    ok = []
    for c, kind in targets.items():
        if c not in texts:
            ok.append(rows)
            continue
        parsed = to_timestamp(col(c)) if kind == "datetime" else to_number(col(c))
        ok.append(F.count_if(col(c).isNull() | parsed.isNotNull()))
    total = ok[0]
    for o in ok[1:]:
        total = total + o
    share = F.try_divide(total, rows * F.lit(len(targets)))
    return before.agg(
        F.least(F.coalesce(share, F.lit(0.0)), F.lit(CONSISTENCY_CAP)).alias("consistency")
    )
