"""Session helpers: shared scratch storage and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="sievemark-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder; the innermost open scope deletes it at its end."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at its end what operators have written to scratch inside; their results must be written or collected by then.

    Paths go through the file system that holds them, so the folder may be in any store Spark writes to.
    """
    mine: list[str] = []
    _SCOPES.append(mine)
    try:
        yield
    finally:
        _SCOPES.remove(mine)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in mine:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to shared scratch and read it back, cutting its lineage.

    Parquet instead of ``checkpoint()``: later jobs still prune columns, and a lost
    executor re-reads files instead of re-running the shuffle that made them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table planned as a local scan, for parameters with a row per column."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    table = pa.Table.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, struct)
