"""Row numbers, running totals and forward fill over one global order.

A window without a partition would pull the whole table into one task. Here the rows are
range-partitioned on the order keys, numbered inside each partition, and shifted by the
sizes of the partitions before it. Anything cumulative then works on buckets of a fixed
number of rows, so no key, however hot, makes a task larger than a bucket.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.columns import col
from sievemark.functions.hashing import row_hash
from sievemark.session import materialize, small_frame

BUCKET_ROWS = 16_384  # also the number of buckets in a super bucket
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits

OrderKey = str | Column


def _keys(order_by: Sequence[OrderKey]) -> list[Column]:
    if not order_by:
        raise ValueError("this operator depends on row order: name the order_by columns")
    return [col(k) if isinstance(k, str) else k for k in order_by]


def same_keys(names: Sequence[str], prefix: str) -> Column:
    """Join condition on columns renamed to ``prefix`` and their place; nulls are equal."""
    out = F.lit(True)
    for i, c in enumerate(names):
        out = out & col(c).eqNullSafe(F.col(f"{prefix}{i}"))
    return out


def number_rows(
    df: DataFrame, order_by: Sequence[OrderKey], name: str = "_row_id", partitions: int | None = None
) -> tuple[DataFrame, int]:
    """(numbered rows, row count): numbers 1..n in the given order; a hash of the row breaks ties.

    So numbers do not depend on chance, and a key with few values is still dealt to many
    tasks. One range shuffle. The sorted rows are written once to shared scratch, because the
    offsets and the numbers must come from the same partitioning. What comes back to the
    driver is one size per range partition.
    """
    keys = _keys(order_by)
    if not re.search(r"\b(map|variant)\b", df.schema.simpleString().split("<", 1)[1]):  # these have no hash
        keys = [*keys, row_hash(df)]
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("_pos", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).collect()
    rows, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((r["part"], rows))
        rows += r["size"]
    before = small_frame(spark, offsets, "_part bigint, _offset bigint")
    inside = F.col("_pos").bitwiseAND(F.lit(2**_POSITION_BITS - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(before), "_part").select(
        *[col(c) for c in df.columns], (F.col("_offset") + inside + 1).alias(name)
    )
    return numbered, rows


def with_row_id(
    df: DataFrame, order_by: Sequence[OrderKey], name: str = "_row_id", partitions: int | None = None
) -> DataFrame:
    """``number_rows`` without the count."""
    return number_rows(df, order_by, name, partitions)[0]


def _bucketed(df: DataFrame, row_id: str) -> DataFrame:
    return df.withColumn("_bucket", F.floor((col(row_id) - 1) / F.lit(BUCKET_ROWS)))


def _carry(buckets: DataFrame, fold: dict[str, dict]) -> DataFrame:
    """For each bucket, every folded value over all buckets before it.

    Buckets are folded within super buckets, and these in the only window that has no
    partition: a few thousand rows for 10^12 rows of data.
    """
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    supers = buckets.withColumn("_super", F.floor(F.col("_bucket") / F.lit(BUCKET_ROWS)))
    per_super = supers.groupBy("_super").agg(
        *[f["over_group"](n, "_bucket").alias(n) for n, f in fold.items()]
    )
    top = per_super.select(
        "_super", *[f["over_window"](n, before("_super")).alias(f"{n}_top") for n, f in fold.items()]
    )
    return supers.join(F.broadcast(top), "_super").select(
        "_bucket",
        *[
            f["combine"](f["over_window"](n, before("_super", "_bucket")), F.col(f"{n}_top")).alias(f"{n}_carry")
            for n, f in fold.items()
        ],
    )


_SUM = {
    "over_group": lambda n, _key: F.sum(n),
    "over_window": lambda n, w: F.sum(n).over(w),
    "combine": lambda near, far: F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0)),
}
_LAST = {
    "over_group": lambda n, key: F.max_by(n, F.when(F.col(n).isNotNull(), F.col(key))),
    "over_window": lambda n, w: F.last(n, ignorenulls=True).over(w),
    "combine": lambda near, far: F.coalesce(near, far),
}


def running_totals(numbered: DataFrame, totals: dict[str, str], row_id: str = "_row_id") -> DataFrame:
    """Add inclusive running sums to numbered rows, bucket by bucket; ``totals`` maps new name to column."""
    rows = _bucketed(numbered, row_id)
    temp = {f"_rt{i}": (new, old) for i, (new, old) in enumerate(totals.items())}
    sums = rows.groupBy("_bucket").agg(*[F.sum(col(old)).alias(t) for t, (_, old) in temp.items()])
    carry = _carry(sums, {t: _SUM for t in temp})
    inside = Window.partitionBy("_bucket").orderBy(col(row_id)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.join(carry, "_bucket").select(
        *[col(c) for c in numbered.columns],
        *[
            (F.coalesce(F.sum(col(old)).over(inside), F.lit(0)) + F.col(f"{t}_carry")).alias(new)
            for t, (new, old) in temp.items()
        ],
    )


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Fill nulls with the last value before them in order, never across ``within`` groups.

    The group columns lead the order, so one global pass serves every group and a group
    with a third of the rows is spread over many buckets.
    """
    keys = [*within, *order_by]
    rows = _bucketed(with_row_id(df, keys), "_row_id")
    held = {
        f"_ff{i}": F.when(
            col(c).isNotNull(), F.struct(*[col(k).alias(f"k{j}") for j, k in enumerate(within)],
                                         col(c).alias("v"))
        )
        for i, c in enumerate(columns)
    }
    rows = rows.withColumns(held)
    inside = Window.partitionBy("_bucket").orderBy("_row_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    target = dict(zip(columns, held))
    seen = {t: F.last(t, ignorenulls=True).over(inside) for t in held}
    last = rows.groupBy("_bucket").agg(*[
        F.max_by(t, F.when(F.col(t).isNotNull(), F.col("_row_id"))).alias(t) for t in held
    ])
    rows = rows.join(_carry(last, {t: _LAST for t in held}), "_bucket")
    seen = {t: F.coalesce(e, F.col(f"{t}_carry")) for t, e in seen.items()}
    wide = rows.withColumns({f"{t}_seen": e for t, e in seen.items()})

    def filled(c: str) -> Column:
        s = F.col(f"{target[c]}_seen")
        same = F.lit(True)
        for j, k in enumerate(within):
            same = same & s[f"k{j}"].eqNullSafe(col(k))
        return F.when(same, s["v"]).alias(c)

    return wide.select(*[filled(c) if c in target else col(c) for c in df.columns])


def with_run_starts(numbered: DataFrame, group: str, name: str, row_id: str = "_row_id") -> DataFrame:
    """Add the number of the first row of each row's group to rows that are numbered group by group.

    Groups are intervals of the row numbers. Within a bucket a group starts where its value changes; the start of the group that
    a bucket begins with is looked up once for the bucket. So rows are never dealt out by their group, however large it is.
    """
    rows = _bucketed(numbered, row_id)
    starts = numbered.groupBy(col(group).alias("_g")).agg(F.min(col(row_id)).alias("_first"))
    heads = rows.groupBy("_bucket").agg(F.min_by(F.struct(col(group).alias("g")), col(row_id)).alias("_head"))
    heads = heads.join(starts, F.col("_head.g").eqNullSafe(F.col("_g"))).select("_bucket", "_first")
    inside = Window.partitionBy("_bucket").orderBy(col(row_id))
    same = F.lag(F.struct(col(group).alias("g"))).over(inside)
    change = F.when(same.isNotNull() & ~same["g"].eqNullSafe(col(group)), col(row_id))
    marked = rows.join(heads, "_bucket").withColumn("_change", change)
    seen = F.max("_change").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn(name, F.coalesce(seen, F.col("_first"))).select(*[col(c) for c in numbered.columns], name)
