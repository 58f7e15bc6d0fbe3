"""Sources and sinks: whole tables are written to shared scratch and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import LINE_NUMBERS, View, each, query, table, with_t
from sievemark.session import scratch_path
from sievemark.sources import readers, sinks

_ORDERS = View("orders", ("o_orderkey", "CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_custkey END AS o_custkey", "o_orderstatus",
                          "CASE WHEN o_totalprice < 50000 THEN 'N/A' ELSE CAST(o_totalprice AS STRING) END AS price", "CAST(o_orderdate AS STRING) AS day"))
_SUMS = """count(*) AS rows, count(o_custkey) AS customers, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(price) AS prices, round(sum(price), 2) AS total"""
_READ = with_t(_ORDERS, """, r AS (SELECT o_orderkey, o_custkey, o_orderstatus, TRY_CAST(price AS DOUBLE) AS price FROM t) SELECT """ + _SUMS + " FROM r").replace(") ,", "),", 1)


def _sums(df):
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count("o_custkey").alias("customers"), F.sum(F.col("o_orderkey").cast("bigint")).alias("keys"),
                  F.count("price").alias("prices"), F.round(F.sum("price"), 2).alias("total"))


def _csv(spark, d):
    path = scratch_path(spark, "csv")
    sinks.sink_csv(_ORDERS.df(spark, d), path)
    return path


@query("src_csv", _READ)
def src_csv(spark, d):
    return _sums(readers.read_csv(spark, _csv(spark, d)))


@query("src_csv_types", """SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'double'), ('o_orderstatus', 'string'), ('price', 'double'), ('day', 'timestamp')) AS v("column", dtype)""")
def src_csv_types(spark, d):
    """Types found in a file of every order; whole numbers with gaps stay floating."""
    from sievemark.session import small_frame

    df = readers.read_csv(spark, _csv(spark, d))
    return small_frame(spark, [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")


_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, price double, day string"


def _broken_lines(spark, d, extra):
    """Orders as CSV lines; orders over 450,000 get the given ending."""
    path = scratch_path(spark, "lines")
    t = _ORDERS.df(spark, d)
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.coalesce(F.col("o_custkey").cast("string"), F.lit("")), "o_orderstatus",
                       F.when(F.col("price") == "N/A", "").otherwise(F.col("price")), "day")
    lines = table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(t.select("o_orderkey", line.alias("value")), "o_orderkey")
    lines.select(F.when(F.col("o_totalprice") > 450000, F.concat("value", F.lit(extra))).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


@query("src_csv_tolerant", """SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice) FILTER (WHERE o_totalprice >= 50000), 2) AS total FROM orders WHERE o_totalprice <= 450000""")
def src_csv_tolerant(spark, d):
    path = _broken_lines(spark, d, ",one,two")
    return readers.read_csv_tolerant(spark, path, _SCHEMA, header=False).agg(
        F.count("o_orderkey").alias("rows"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("price"), 2).alias("total"))


_TEXTS = "SELECT doc_id, md5(text) AS m, lang, source FROM documents"


def _texts(spark, d):
    """Whole texts with their line breaks as CSV; some records get a surplus field, some a broken number."""
    path = scratch_path(spark, "texts")
    sinks.sink_csv(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), path)
    broken = table(spark, d, "documents").filter("doc_id % 7 = 0").select(
        F.concat(F.lit('"x\ny",'), F.col("doc_id").cast("string"), F.lit(',"a ""b""",de,more')).alias("value"))
    broken.write.mode("append").text(path)
    return path


@query("src_csv_tolerant_multiline", _TEXTS)
def src_csv_tolerant_multiline(spark, d):
    """Records with line breaks inside quotes, malformed ones among them dropped."""
    rows = readers.read_csv_tolerant(spark, _texts(spark, d), "doc_id bigint, text string, lang string, source string")
    return rows.select("doc_id", F.md5("text").alias("m"), "lang", "source")


@query("src_text", """SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice) FILTER (WHERE o_totalprice >= 50000), 2) AS total FROM orders""")
def src_text(spark, d):
    lines = spark.read.text(_broken_lines(spark, d, ""))
    return readers.read_csv_text(spark, lines, _SCHEMA).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("price"), 2).alias("total"))


def _ragged(spark, d):
    """Part lines without a header: some have a surplus field, some lack the last one."""
    path = scratch_path(spark, "ragged")
    full = table(spark, d, "part").select("p_size", F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", F.col("p_size").cast("string")).alias("v"),
                                          F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name").alias("short"))
    full.select(F.when(F.col("p_size") > 40, F.concat("v", F.lit(",surplus"))).when(F.col("p_size") < 5, F.col("short")).otherwise(F.col("v")).alias("value")).write.text(path)
    return readers.read_csv_ragged(spark, path, "p_partkey bigint, p_name string, p_size int", header=False)


@query("src_csv_ragged", """SELECT p_partkey, p_name, CASE WHEN p_size < 5 THEN NULL ELSE p_size END AS p_size, p_size > 40 OR p_size < 5 AS ragged FROM part""")
def src_csv_ragged(spark, d):
    return _ragged(spark, d).select("p_partkey", "p_name", "p_size", F.col(readers.CORRUPT).isNotNull().alias("ragged"))


@query("sink_errors", """SELECT 'part' AS source, count(*) AS n FROM part WHERE p_size > 40 OR p_size < 5""")
def sink_errors(spark, d):
    path = scratch_path(spark, "errors")
    sinks.sink_errors(readers.quarantine(_ragged(spark, d), "part"), path)
    return spark.read.csv(path, header=True).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("src_csv_multiline", "SELECT doc_id, md5(text) AS m, lang, source FROM documents")
def src_csv_multiline(spark, d):
    """Whole texts with their line breaks, written and read back."""
    path = scratch_path(spark, "texts")
    sinks.sink_csv(table(spark, d, "documents"), path)
    return readers.read_csv(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("m"), "lang", "source")


def _nested(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("place")).alias("who"), "c_acctbal")


_FLAT = 'SELECT c_custkey, c_name AS "who.name", c_nationkey AS "who.place.nation", c_mktsegment AS "who.place.segment", c_acctbal FROM customer'


@query("src_json", _FLAT)
def src_json(spark, d):
    path = scratch_path(spark, "json")
    sinks.sink_json(_nested(spark, d), path)
    return readers.read_json(spark, path, multi_line=False)


@query("src_json_list", "SELECT conv_id, turn, role, md5(text) AS m FROM conversations")
def src_json_list(spark, d):
    """Records with two lists each, under the one whose key stands first; files differ in which keys they have."""
    path = scratch_path(spark, "lists")
    turns = F.array(F.struct("turn", "role", "text", "conv_id"))
    talks = table(spark, d, "conversations")
    talks.select(F.to_json(F.struct(F.lit("x").alias("name"), turns.alias("turns"), F.array(F.lit(1), F.lit(2)).alias("marks"))).alias("value")).write.text(path)
    return readers.read_json(spark, path, multi_line=False, records=False).select("conv_id", "turn", "role", F.md5("text").alias("m"))


@query("src_json_wrapped", _FLAT)
def src_json_wrapped(spark, d):
    """A wrapper record around every customer, so no record gathers the table."""
    path = scratch_path(spark, "wrapped")
    record = F.struct("c_custkey", "who", "c_acctbal")
    sinks.sink_json(_nested(spark, d).select(F.lit(1).alias("total"), F.array(record).alias("results")), path)
    return readers.read_json_wrapped(spark, path, multi_line=False)


def _by_status(spark, d):
    folder = scratch_path(spark, "folder")
    for status in ("F", "O", "P"):
        sinks.sink_csv(table(spark, d, "orders").filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice", "o_orderstatus"), f"{folder}/{status}/files")
    return folder


@query("src_recursive", "SELECT o_orderstatus AS folder, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def src_recursive(spark, d):
    df = readers.read_folder(spark, _by_status(spark, d), "o_orderkey bigint, o_totalprice double, o_orderstatus string")
    folder = F.element_at(F.split("_file", "/"), -3)
    return df.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src_union_files", "SELECT o_orderstatus, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def src_union_files(spark, d):
    folder = _by_status(spark, d)
    return readers.union_files(spark, [f"{folder}/{s}/files" for s in ("F", "O", "P")]).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _log(spark, d):
    """Every order as a log record; early ones lack the later fields, some lines are no JSON."""
    path = scratch_path(spark, "log")
    orders = table(spark, d, "orders")
    record = orders.select(
        F.concat(F.lit("t"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("timestamp"), (F.col("o_totalprice") / 500000).alias("cv_score"),
        F.col("o_custkey").alias("feedback_samples"), F.lit("forest").alias("model_type"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("promoted"),
        F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("f1_delta"), F.col("o_totalprice") / 1000000)).alias("improvement"))
    sinks.sink_append_log(record, path)
    orders.filter("o_totalprice > 490000").select(F.lit("not json {").alias("value")).write.mode("append").text(path)
    return path


@query("src_jsonl", """SELECT 't' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS timestamp, round(o_totalprice / 500000, 8) AS cv_score,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS promoted, CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice / 1000000, 8) END AS f1_delta FROM orders ORDER BY o_orderkey DESC LIMIT 100""")
def src_jsonl(spark, d):
    return readers.read_log(spark, _log(spark, d), 100).select("timestamp", F.round("cv_score", 8).alias("cv_score"), "promoted", F.round(F.col("improvement")["f1_delta"], 8).alias("f1_delta"))


@query("sink_append_log", "SELECT count(*) AS records, count(*) FILTER (WHERE o_orderstatus = 'F') AS promoted FROM orders")
def sink_append_log(spark, d):
    log = readers.read_log(spark, _log(spark, d))
    return log.agg(F.count("timestamp").alias("records"), F.count_if("promoted").alias("promoted"), F.max("cv_score").alias("_c"), F.max("model_type").alias("_m"),
                   F.max("feedback_samples").alias("_f")).select("records", "promoted")


@query("gate_min_shape", """SELECT 'nation' AS name, true AS accepted, 3 AS rows_seen, 3 AS columns, NULL AS reason FROM (SELECT count(*) FROM nation HAVING count(*) >= 3) AS a
UNION ALL SELECT 'region', false, count(*), 2, 'rows<50' FROM region
UNION ALL SELECT 'orders', true, 50, 6, NULL FROM (SELECT count(*) FROM orders HAVING count(*) >= 50) AS c""")
def gate_min_shape(spark, d):
    named = lambda name, **k: readers.gate_min_shape(table(spark, d, name), **k).withColumn("name", F.lit(name))
    return named("nation").unionByName(named("region", min_rows=readers.MIN_ROWS_ACQUIRED)).unionByName(named("orders", min_rows=readers.MIN_ROWS_ACQUIRED))


_KIND = {"l_orderkey": "integer", "l_partkey": "integer", "l_suppkey": "integer", "l_linenumber": "integer", "l_returnflag": "categorical", "l_linestatus": "categorical", "l_shipdate": "datetime"}
_NAMES = [*LINE_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]


@query("meta_table", " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{_KIND.get(c, "float")}' AS logical_type, 'lineitem' AS source, 'table' AS source_type, count(*) AS num_rows, 11 AS num_columns FROM lineitem"""
    for i, c in enumerate(_NAMES)))
def meta_table(spark, d):
    return readers.meta_table(table(spark, d, "lineitem"), "lineitem", "table")


@query("sink_table", "SELECT count(*) AS rows, round(sum(l_extendedprice), 0) AS total FROM lineitem")
def sink_table(spark, d):
    written = sinks.sink_table(table(spark, d, "lineitem"), scratch_path(spark, "table"))
    return written.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_extendedprice"), 0).alias("total"))


@query("sink_json", "SELECT conv_id, turn, role, md5(text) AS m FROM conversations")
def sink_json(spark, d):
    path, talks = scratch_path(spark, "records"), table(spark, d, "conversations")
    sinks.sink_json(talks, path)
    return spark.read.schema(talks.schema).json(path).select("conv_id", "turn", "role", F.md5("text").alias("m"))


@query("sink_splits", "SELECT o_orderstatus AS split, count(*) AS rows FROM orders GROUP BY 1")
def sink_splits(spark, d):
    path = scratch_path(spark, "splits")
    sinks.sink_splits(table(spark, d, "orders").withColumnRenamed("o_orderstatus", "split"), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("csv_export", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_export(spark, d):
    path, customers = scratch_path(spark, "export"), table(spark, d, "customer")
    sinks.csv_export(customers, path)
    return spark.read.schema(customers.schema).csv(path, header=True)
