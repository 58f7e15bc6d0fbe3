"""Helpers of this subpackage: Arrow passes over texts, row keys, components of a link table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.session import materialize

ROW = "__row"
#: Rows that cross into Python at once; texts keep a batch at some megabytes.
BATCH = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

PerText = Callable[..., tuple]


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; lowers the session's Arrow batch size, since texts are long for the default of 10,000 rows."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING, "10000")) <= BATCH:
        conf.set(_BATCH_SETTING, str(BATCH))
    return df


def per_text(
    df: DataFrame, column: str, make: Callable[[], PerText], fields: str, keep: Sequence[str] | None = None,
    also: str | None = None,
) -> DataFrame:
    """Append ``fields`` computed from one text at a time.

    ``make`` runs once per task and returns the function of a text. ``keep`` names the columns
    that stay (default all); a kept column with the name of a new one is replaced. The values of
    the column ``also`` are passed to the function too.
    """
    added = T.StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c not in added.names]
    schema = T.StructType([df.schema[c] for c in kept] + list(added))
    name = column if column in kept else "__text"
    needed = df.select(*kept, *([] if name in kept else [F.col(column).alias(name)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        function, extra = make(), [also] if also else []
        types = [to_arrow_type(f.dataType) for f in added]
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                texts = texts_of(batch, name)
                results = [function(*x) for x in zip(texts, *[batch.column(c).to_pylist() for c in extra])]
                columns = [pa.array([r[i] for r in results], type=t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in kept] + columns, names=kept + added.names
                )

    return small_batches(needed).mapInArrow(run, schema)


def with_rows(df: DataFrame, label: str) -> DataFrame:
    """``df`` with a row number in ``__row``, unique and the same in every later job.

    The numbers depend on how the input was split, so they are written down at once; equal
    rows and equal or missing ids stay apart.
    """
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def apart(groups: DataFrame, label: str) -> DataFrame:
    """Write a table of groups that is joined back to the rows it was made from.

    Planned together, both would share one shuffle, and a group with very many rows would
    stay in one task; a join of two shuffles of their own is split where it is skewed.
    """
    return materialize(groups, label)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(a, b): every node of an edge list (a, b) but the smallest of its component, and that smallest.

    Large-star and small-star steps in turn; each makes at most as many edges as it was given,
    and the number of rounds grows with the logarithm of the longest path. A node with very many
    links is one row of the smaller side of a join whose larger side Spark may split.
    """
    now = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return now
        seen = state
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = apart(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, label)
        lowest = apart(large.groupBy("a").agg(F.min("b").alias("m")), label)
        met = large.join(lowest, "a")
        small = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct(), label)
