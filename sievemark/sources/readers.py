"""Reading tables: delimited text, JSON, logs, whole folders."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.casts import na_tokens_to_null, nan_to_null
from sievemark.functions.columns import col, column_classes, logical_type
from sievemark.operators.infer import infer_types
from sievemark.session import small_frame
from sievemark.sources.csv_records import CORRUPT, csv_records, headers_of, lines_of, names_of, parsed, survey

# Wrapper keys in the order they are looked for, and smallest useful tables.
WRAPPER_KEYS = ("data", "results", "records", "items", "value")
MIN_ROWS, MIN_COLUMNS = 3, 2
MIN_ROWS_ACQUIRED, MIN_ROWS_FEATURES = 50, 10


def _as_struct(schema: T.StructType | str | None) -> T.StructType | None:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _csv(
    lines: DataFrame, schema: T.StructType | str | None, header: bool = True, corrupt: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """The records of some files as columns, all text without a schema; columns of a schema go by their place."""
    blocks = survey(lines)
    records = csv_records(lines, blocks)
    schema = _as_struct(schema)
    if schema is None:
        heads = headers_of(records, blocks)
        names = names_of(heads[min(heads)]) if heads else []
        schema = T.StructType([T.StructField(n if header else f"_c{i}", T.StringType()) for i, n in enumerate(names)])
    if corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    return parsed(records.filter(~F.col("first")) if header else records, schema, keep)


def _typed(text: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns with the types their values have; ``keep`` stays as it is."""
    apart = text.withColumns({c: col(c).cast("binary") for c in keep})  # not text for the steps between
    found = narrow_integers(infer_types(na_tokens_to_null(apart)))
    return found.withColumns({c: col(c).cast("string") for c in keep})


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, header: bool = True
) -> DataFrame:
    """CSV with a header; NA tokens become null and types come from the values.

    Quoted values may hold line breaks and doubled quotes; a large file is still read by many tasks.

    Without a schema the text is read once to count what parses and once with the types;
    give a schema to save that.
    """
    found = _csv(lines_of(spark, path), schema, header)
    return nan_to_null(found) if schema is not None else _typed(found)


def narrow_integers(df: DataFrame) -> DataFrame:
    """Doubles that hold only whole numbers without gaps become bigint, as readers infer."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not doubles:
        return df
    row = df.agg(*[
        F.bool_and(col(c).isNotNull() & (col(c) == F.floor(col(c))) & (F.abs(col(c)) < 2.0**53)).alias(f"w{i}")
        for i, c in enumerate(doubles)
    ]).first()
    whole = {c for i, c in enumerate(doubles) if row[f"w{i}"]}
    return df.select(*[
        F.expr(f"try_cast(`{c}` AS BIGINT)").alias(c) if c in whole else col(c) for c in df.columns
    ])


def read_csv_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, encoding: str = "UTF-8", header: bool = True
) -> DataFrame:
    """CSV that drops malformed records and replaces undecodable bytes."""
    rows = _csv(lines_of(spark, path, encoding=encoding), schema, header, corrupt=True)
    good = rows.filter(col(CORRUPT).isNull()).drop(CORRUPT)
    return good if schema is not None else _typed(good)


def read_csv_ragged(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, header: bool = True
) -> DataFrame:
    """CSV that cuts long records and pads short ones; what fails to parse is null.

    The corrupt-record column keeps such records for ``quarantine``.
    """
    rows = _csv(lines_of(spark, path), schema, header, corrupt=True)
    return rows if schema is not None else _typed(rows, [CORRUPT])


def quarantine(df: DataFrame, source: str | Column) -> DataFrame:
    """(source, reason) of the lines a tolerant read could not take."""
    src = F.lit(source) if isinstance(source, str) else source
    return df.filter(col(CORRUPT).isNotNull()).select(
        src.alias("source"), F.concat(F.lit("malformed line: "), col(CORRUPT)).alias("reason")
    )


def read_csv_text(spark: SparkSession, lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """CSV held as text lines in a column named ``value``, without a header."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    return lines.select(F.from_csv(F.col("value"), F.lit(ddl)).alias("r")).select("r.*")


def flatten(df: DataFrame) -> DataFrame:
    """Nested records as columns with dotted names; arrays and maps stay."""
    out: list[Column] = []

    def walk(struct: T.StructType, path: Sequence[str]) -> None:
        for f in struct.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here)
            else:
                ref = F.col(".".join(f"`{p}`" for p in here))
                out.append(ref.alias(".".join(here)))

    walk(df.schema, [])
    return df.select(*out)


def _records_of(df: DataFrame, name: str) -> DataFrame:
    """Rows of one array column; records are flattened, scalars stay one column."""
    item = df.schema[name].dataType.elementType
    exploded = df.select(F.explode(col(name)).alias(name))
    return flatten(exploded.select(f"{name}.*")) if isinstance(item, T.StructType) else exploded


_HEAD = 1 << 16  # characters of the first record in which the names of its keys are looked for


def read_json(spark: SparkSession, path: str | list[str], multi_line: bool = True, records: bool | None = None) -> DataFrame:
    """A list of records, or the first list-valued key of a record, else the record.

    ``records`` tells that the text holds a list of records or a line for each, and False that every record wraps a list. Without
    it, text that starts with a bracket or holds two records is taken for a list.
    """
    df = spark.read.json(path, multiLine=multi_line)
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if records is None:
        records = bool(lists) and (_head(spark, path).lstrip().startswith("[") or len(df.take(2)) > 1)
    if lists and not records:
        return _records_of(df, _first_key(spark, path, lists) if len(lists) > 1 else lists[0])
    return flatten(df)


def _head(spark: SparkSession, path: str | list[str]) -> str:
    """The first characters of the first file; no more lines are read than they take."""
    lines = spark.read.text(path).select(F.substring("value", 1, _HEAD).alias("value")).limit(1000).collect()
    return "\n".join(r["value"] for r in lines)[:_HEAD]


def _first_key(spark: SparkSession, path: str | list[str], names: Sequence[str]) -> str:
    """The list that stands first in the text of a record, since the reader sorts the keys."""
    head = _head(spark, path)
    at = {n: found.start() for n in names if (found := re.search(re.escape(json.dumps(n, ensure_ascii=False)) + r"\s*:\s*\[", head))}
    return min(at, key=at.__getitem__, default=names[0])


def read_json_wrapped(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Records under the first wrapper key present, flattened."""
    df = spark.read.json(path, multiLine=multi_line)
    for key in WRAPPER_KEYS:
        if key in df.columns and isinstance(df.schema[key].dataType, T.ArrayType):
            return _records_of(df, key)
    return flatten(df)


def read_folder(spark: SparkSession, folder: str, schema: T.StructType | str | None = None, pattern: str = "*.csv") -> DataFrame:
    """Every matching file below a folder, with the file it came from."""
    rows = _csv(lines_of(spark, folder, pattern=pattern, recursive=True), schema, keep=["file"])
    return (rows if schema is not None else _typed(rows, ["file"])).withColumnRenamed("file", "_file")


def union_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files of one dataset stacked by column name.

    One scan finds all headers. Files with the same header are parsed together, so the plan grows with the
    number of headers.
    """
    lines = lines_of(spark, paths)
    blocks = survey(lines)
    records = csv_records(lines, blocks)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, head in headers_of(records, blocks).items():
        by_header.setdefault(tuple(names_of(head)), []).append(file)
    out = None
    for names, files in sorted(by_header.items()):
        schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
        mine = records.filter(~F.col("first") & F.col("file").isin(files))
        rows = parsed(mine, schema).filter(col(CORRUPT).isNull()).drop(CORRUPT)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return _typed(out)


RETRAIN_LOG_SCHEMA = (
    "timestamp string, cv_score double, feedback_samples bigint, total_training_samples bigint, "
    "model_type string, action string, promoted boolean, validation_reason string, "
    "improvement map<string,double>"
)


def read_log(spark: SparkSession, path: str, newest: int | None = None, schema: str = RETRAIN_LOG_SCHEMA) -> DataFrame:
    """JSON lines, bad lines skipped, newest first when a number is asked for."""
    log = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return log.orderBy(F.desc("timestamp")).limit(newest) if newest else log


def gate_min_shape(df: DataFrame, min_rows: int = MIN_ROWS, min_columns: int = MIN_COLUMNS) -> DataFrame:
    """(accepted, rows_seen, columns, reason); at most ``min_rows`` rows are counted."""
    width = len(df.columns)
    seen = df.select(F.lit(1).alias("one")).limit(min_rows).agg(F.count("one").alias("rows_seen"))
    ok = (F.col("rows_seen") >= min_rows) & F.lit(width >= min_columns)
    return seen.select(
        ok.alias("accepted"), "rows_seen", F.lit(width).alias("columns"),
        F.when(F.col("rows_seen") < min_rows, f"rows<{min_rows}").when(~ok, f"columns<{min_columns}").alias("reason"),
    )


def meta_table(df: DataFrame, source: str, source_type: str) -> DataFrame:
    """(position, column, logical_type, source, source_type, num_rows, num_columns)."""
    n = df.count()
    return small_frame(
        df.sparkSession,
        [
            (i, f.name, logical_type(f.dataType), source, source_type, n, len(df.columns))
            for i, f in enumerate(df.schema.fields)
        ],
        "position int, column string, logical_type string, source string, source_type string, "
        "num_rows bigint, num_columns int",
    )
