"""The same operators on files that keep arriving.

Each function returns a streaming frame or a started query; ``drain`` runs one to the end
of what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col
from sievemark.operators.feedback import RETRAIN_EVERY, gate_table
from sievemark.operators.impute import Fill, apply_fills
from sievemark.session import scratch_path, small_frame


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files called ``name`` in a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with a time zone."""
    return df.withColumn(column, col(column).cast("timestamp"))


def drain(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into shared scratch and read the result."""
    spark = stream.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_clean(stream: DataFrame, plan: Sequence[Fill]) -> DataFrame:
    """Fixed fill values applied to arriving rows: stateless, no shuffle."""
    return apply_fills(stream, plan)


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str) -> DataFrame:
    """First row per key; keys are forgotten once the watermark passes them."""
    return event_time(stream, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def stream_profile(
    stream: DataFrame, ts: str, number: str, length: str = "1 hour", slide: str | None = None,
    lateness: str = "10 minutes", by: Sequence[str] = (),
) -> DataFrame:
    """Quality features of each tumbling or sliding window."""
    x = col(number).cast("double")
    return event_time(stream, ts).withWatermark(ts, lateness).groupBy(
        F.window(ts, length, slide) if slide else F.window(ts, length), *[col(b) for b in by]
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(x.isNull()).alias("missing"),
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *by, "rows", "missing", "mean", "std", "min", "max",
    )


def _stored_counts(spark: SparkSession, path: str) -> dict[int, int]:
    """Rows by batch id of a store that earlier runs have left, if any."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:  # nothing stored yet
        return {}
    return {r["batch"]: r["n"] for r in stored.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}


_TRIGGERS = "due long, rows long, batch long"


def triggers_of(spark: SparkSession, path: str) -> DataFrame:
    """(due, rows, batch): the retrains that a store's feedback has led to, the multiple each answers and the rows there were."""
    try:
        return spark.read.schema(_TRIGGERS).json(f"{path}-triggers")
    except AnalysisException:  # none yet
        return small_frame(spark, [], _TRIGGERS)


def stream_feedback(
    stream: DataFrame, path: str, state: str, every: int = RETRAIN_EVERY,
    on_due: Callable[[DataFrame], None] | None = None,
) -> None:
    """Gate arriving feedback, append what passes, and call back when a retrain is due.

    A retrain is due whenever the number of accepted rows passes a multiple of ``every``, be
    it in the middle of a batch. A batch id names its folder, so a batch repeated after a
    failure replaces itself. The multiple that a call has answered is written down beside the store once the call is
    over, so a run that fails before leaves the retrain due for the next one, and one that was answered is not
    asked for again. The rows stored before are counted once, at the start.
    """
    spark = stream.sparkSession
    counts = _stored_counts(spark, path)
    done = triggers_of(spark, path).agg(F.max("due")).first()[0] or 0

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal done
        folder = f"{path}/batch={batch_id}"
        gate_table(batch).filter("is_quality_gated = 1").write.mode("overwrite").parquet(folder)
        counts[batch_id] = spark.read.parquet(folder).count()
        total = sum(counts.values())
        due = total // every * every
        if on_due is not None and due > done:
            on_due(spark.read.parquet(path))
            small_frame(spark, [(due, total, batch_id)], _TRIGGERS).write.mode("append").json(f"{path}-triggers")
            done = due

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
