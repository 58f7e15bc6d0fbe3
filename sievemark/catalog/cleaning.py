"""Type inference, duplicates, fills, outlier removal, whole-table cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import (
    COPIED, GAPPY, GAPPY_NUMBERS, GAPPY_TEXT, NARROW, NUMBER_RE, TEXTY, View, each, query, sql_number, table, with_t,
)
from sievemark.catalog.statistics import _outside, with_fences
from sievemark.functions.casts import number_prefix
from sievemark.functions.hashing import data_fingerprint, file_hashes
from sievemark.operators import checks, dedup, impute, infer, order
from sievemark.plans.clean import CleaningProfile, clean_simple, clean_table

_TEXT_NAMES = TEXTY.names()
_KINDS = """SELECT '{c}' AS "column", CASE
  WHEN count({c}) > 0 AND count(TRY_CAST({c} AS TIMESTAMP)) = count({c}) AND count(""" + sql_number("{c}") + """) < count({c}) THEN 'datetime'
  WHEN count(""" + sql_number("{c}") + """) / CAST(count(*) AS DOUBLE) > 0.7 THEN 'float' ELSE 'categorical' END AS logical_type FROM t"""


@query("infer_types", with_t(TEXTY, each(_TEXT_NAMES, _KINDS)))
def infer_types(spark, d):
    return infer.inferred_type_table(TEXTY.df(spark, d))


_NUM = {c: sql_number(c) for c in _TEXT_NAMES}


@query("infer_types_cast", with_t(TEXTY, f"""SELECT {_NUM['qty_text']} AS qty_text, two_thirds, {_NUM['most']} AS most, with_gaps,
  CAST(shipped AS TIMESTAMP) AS shipped FROM t"""))
def infer_types_cast(spark, d):
    typed = infer.infer_types(TEXTY.df(spark, d))
    return typed.select("qty_text", "two_thirds", "most", "with_gaps", F.col("shipped").cast("timestamp_ntz").alias("shipped"))


@query("apply_hints", with_t(TEXTY, f"""SELECT {_NUM['two_thirds']} AS two_thirds, price_note, CAST(shipped AS TIMESTAMP) AS shipped,
  CASE lower(open_text) WHEN 'true' THEN true WHEN 'false' THEN false END AS open_text FROM t"""))
def apply_hints(spark, d):
    hints = {"two_thirds": "float", "price_note": "integer", "shipped": "datetime", "open_text": "boolean", "missing": "float"}
    typed = infer.apply_hints(TEXTY.df(spark, d), hints)
    return typed.select("two_thirds", "price_note", F.col("shipped").cast("timestamp_ntz").alias("shipped"), "open_text")


@query("coerce_numeric", with_t(TEXTY, f"""SELECT {_NUM['two_thirds']} AS two_thirds, {_NUM['with_gaps']} AS with_gaps,
  {_NUM['price_note']} AS price_note, remark, l_returnflag FROM t"""))
def coerce_numeric(spark, d):
    return infer.coerce_numeric(TEXTY.df(spark, d)).select("two_thirds", "with_gaps", "price_note", "remark", "l_returnflag")


_PREFIX = View("part", ("p_partkey", "CASE WHEN p_size > 30 THEN p_type ELSE CAST(p_size AS STRING) || ' cm' END AS size_text",
                        "CAST(p_retailprice AS STRING) || ' each' AS price_text", "CASE WHEN p_size < 5 THEN '  ' ELSE p_name END AS name_text"))
_FLOAT_PREFIX = "TRY_CAST(NULLIF(regexp_extract(trim({c}), '^" + NUMBER_RE + "', 0), '') AS DOUBLE)"


@query("parse_float_prefix", with_t(_PREFIX, each(["size_text", "price_text", "name_text"], f"""SELECT '{{c}}' AS "column",
  count(NULLIF(trim({{c}}), '')) AS filled, count({_FLOAT_PREFIX}) AS numbers,
  count({_FLOAT_PREFIX}) / CAST(count(NULLIF(trim({{c}}), '')) AS DOUBLE) > 0.8 AS is_numeric FROM t""")))
def parse_float_prefix(spark, d):
    return infer.prefix_numeric(_PREFIX.df(spark, d), ["size_text", "price_text", "name_text"])


@query("parse_float_values", with_t(_PREFIX, "SELECT p_partkey, " + _FLOAT_PREFIX.replace("{c}", "price_text") + " AS price FROM t"))
def parse_float_values(spark, d):
    return _PREFIX.df(spark, d).select("p_partkey", number_prefix(F.col("price_text")).alias("price"))


_MIXED = View("orders", (
    "o_orderkey", "CASE WHEN o_totalprice > 400000 THEN 'high' ELSE CAST(o_custkey AS STRING) END AS partly",
    "CAST(o_custkey AS STRING) AS all_numbers", "o_orderpriority", "CASE WHEN o_orderkey > 2000 THEN '7' ELSE 'x' END AS late_numbers"))
_MIXED_NAMES = ["partly", "all_numbers", "o_orderpriority", "late_numbers"]


@query("mixed_type_flag", with_t(_MIXED, each(_MIXED_NAMES, f"""SELECT '{{c}}' AS "column", count(*) AS present,
  count({sql_number('{c}')}) AS parsed, count({sql_number('{c}')}) > 0 AND count({sql_number('{c}')}) < count(*) AS mixed
FROM (SELECT {{c}} FROM t WHERE {{c}} IS NOT NULL) AS z""")))
def mixed_type_flag(spark, d):
    return infer.mixed_type_columns(_MIXED.df(spark, d), _MIXED_NAMES)


@query("type_consistency_score", with_t(TEXTY, f"""SELECT least((count(*) FILTER (WHERE qty_text IS NULL OR {_NUM['qty_text']} IS NOT NULL)
 + count(*) FILTER (WHERE most IS NULL OR {_NUM['most']} IS NOT NULL) + count(*) FILTER (WHERE shipped IS NULL OR TRY_CAST(shipped AS TIMESTAMP) IS NOT NULL))
 / (3.0 * count(*)), 0.99) AS consistency FROM t"""))
def type_consistency_score(spark, d):
    raw = TEXTY.df(spark, d)
    return infer.type_consistency(raw, infer.infer_types(raw))


@query("dedup_rows", with_t(NARROW, "SELECT DISTINCT * FROM t"))
def dedup_rows(spark, d):
    return dedup.dedup_rows(NARROW.df(spark, d))


_DUP_SQL = """SELECT n AS rows, k AS distinct_rows, n - k AS duplicates, round((n - k) / CAST(n AS DOUBLE), 6) AS duplicate_ratio
FROM (SELECT (SELECT count(*) FROM t) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u) AS k) AS z"""


@query("dup_count", with_t(COPIED, _DUP_SQL))
def dup_count(spark, d):
    return dedup.duplicate_counts(COPIED.df(spark, d)).withColumn("duplicate_ratio", F.round("duplicate_ratio", 6))


@query("dedup_hash", with_t("SELECT text, lang FROM documents", _DUP_SQL))
def dedup_hash(spark, d):
    docs = table(spark, d, "documents").select("text", "lang")
    return dedup.duplicate_counts_hashed(docs).withColumn("duplicate_ratio", F.round("duplicate_ratio", 6))


@query("dedup_url", """SELECT host, page_id, url FROM (SELECT regexp_extract(url, '://([^/]*)', 1) AS host, page_id, url,
  row_number() OVER (PARTITION BY regexp_extract(url, '://([^/]*)', 1) ORDER BY page_id) AS k FROM pages) AS z WHERE k = 1""")
def dedup_url(spark, d):
    pages = table(spark, d, "pages").select(F.parse_url("url", F.lit("HOST")).alias("host"), "page_id", "url")
    return dedup.keep_first(pages, ["host"], ["page_id"])


@query("join_dup_mask", """SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (
  SELECT 1 FROM documents e WHERE e.text = d.text AND e.doc_id < d.doc_id)""")
def join_dup_mask(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    firsts = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    later = docs.select("doc_id").join(firsts, "doc_id", "left_anti")
    return dedup.drop_masked(docs, later, "doc_id").select("doc_id", "lang")


_EVENT_GAPS = View("events", ("event_id", "ts", "user_id", "event_type",
                              "CASE WHEN value < 60 THEN NULL ELSE value END AS value",
                              "CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props"))


@query("fill_ffill", with_t(_EVENT_GAPS, """SELECT event_id, last_value(value IGNORE NULLS) OVER w AS value, last_value(props IGNORE NULLS) OVER w AS props
FROM t WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def fill_ffill(spark, d):
    return order.forward_fill(_EVENT_GAPS.df(spark, d), ["value", "props"], ["ts", "event_id"]).select("event_id", "value", "props")


@query("fill_ffill_by_user", with_t(_EVENT_GAPS, """SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER w AS value
FROM t WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def fill_ffill_by_user(spark, d):
    return order.forward_fill(_EVENT_GAPS.df(spark, d), ["value"], ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "value")


_KEEP = "l_orderkey, l_linenumber"


def _filled(fn: str) -> str:
    one = lambda c: f"round(coalesce({c}, (SELECT {fn.replace('{c}', c)} FROM t)), 6) AS {c}"
    return with_t(GAPPY, f"SELECT {_KEEP}, {', '.join(map(one, ['l_quantity', 'l_extendedprice', 'l_tax']))}, l_returnflag FROM t")


def _rounded(df):
    return df.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("l_quantity", "l_extendedprice", "l_tax")], "l_returnflag")


@query("fill_mean", _filled("avg({c})"))
def fill_mean(spark, d):
    return _rounded(impute.fill_missing(GAPPY.df(spark, d), "mean"))


@query("fill_median", _filled("quantile_cont({c}, 0.5)"))
def fill_median(spark, d):
    return _rounded(impute.fill_missing(GAPPY.df(spark, d), "median"))


_SMART_LOG = each(["l_quantity", "l_extendedprice", "l_tax"], """SELECT '{c}' AS "column",
  CASE WHEN count({c}) >= 8 AND abs(skewness({c})) < 0.5 THEN 'mean' ELSE 'median' END AS strategy,
  round(CASE WHEN count({c}) >= 8 AND abs(skewness({c})) < 0.5 THEN avg({c}) ELSE quantile_cont({c}, 0.5) END, 4) AS number,
  CAST(NULL AS VARCHAR) AS word, count(*) - count({c}) AS filled FROM t""") + """
UNION ALL SELECT 'l_returnflag', 'mode', NULL, (SELECT l_returnflag FROM t WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  count(*) - count(l_returnflag) FROM t"""


@query("choose_fill", with_t(GAPPY, f'SELECT "column", strategy FROM ({_SMART_LOG}) AS z'))
def choose_fill(spark, d):
    frame = GAPPY.df(spark, d)
    return impute.fill_log(frame, impute.fill_plan(frame)).select("column", "strategy")


@query("fill_smart_log", with_t(GAPPY, f'SELECT "column", strategy, number, word, filled FROM ({_SMART_LOG}) AS z'))
def fill_smart_log(spark, d):
    frame = GAPPY.df(spark, d)
    text = F.col("strategy") == "mode"
    return impute.fill_log(frame, impute.fill_plan(frame)).select(
        "column", "strategy", F.when(~text, F.col("fill_value").try_cast("double")).alias("number"),
        F.when(text, F.col("fill_value")).alias("word"), "filled")


@query("fill_smart", with_t(GAPPY, f"""SELECT {_KEEP}, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM t)), 6) AS l_quantity,
 round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM t)), 6) AS l_extendedprice, round(coalesce(l_tax, (SELECT avg(l_tax) FROM t)), 6) AS l_tax,
 coalesce(l_returnflag, (SELECT l_returnflag FROM t WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_returnflag FROM t"""))
def fill_smart(spark, d):
    return _rounded(impute.fill_missing(GAPPY.df(spark, d)))


@query("fill_global_params", with_t(GAPPY, "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM t)), 6) AS {c}" for c in ("l_quantity", "l_extendedprice", "l_tax")) + " FROM t"))
def fill_global_params(spark, d):
    """One set of parameters from all rows, then applied to all of them."""
    frame = GAPPY.df(spark, d)
    filled = impute.apply_fills(frame, impute.global_fills(frame))
    return filled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("l_quantity", "l_extendedprice", "l_tax")])


_DOCS = View("documents", ("doc_id", "source", "CASE WHEN lang = 'fr' THEN NULL ELSE n_chars END AS n_chars",
                           "CASE WHEN n_chars > 5000 THEN NULL ELSE length(text) / 2.0 END AS half_chars"))


@query("fill_train_median", with_t(_DOCS, """SELECT doc_id, coalesce(CAST(n_chars AS DOUBLE), (SELECT quantile_cont(n_chars, 0.5) FROM t WHERE source < 'src3')) AS n_chars,
  coalesce(CAST(half_chars AS DOUBLE), (SELECT CAST(quantile_cont(half_chars, 0.5) AS DOUBLE) FROM t WHERE source < 'src3')) AS half_chars FROM t"""))
def fill_train_median(spark, d):
    docs = _DOCS.df(spark, d)
    medians = impute.train_medians(docs.filter("source < 'src3'"), ["n_chars", "half_chars"])
    return impute.fill_constants(docs, medians).drop("source")


@query("fill_feature_mean", with_t(_DOCS, """SELECT doc_id, round(coalesce(n_chars, (SELECT avg(n_chars) FROM t)), 6) AS n_chars FROM t"""))
def fill_feature_mean(spark, d):
    return impute.fill_feature_means(_DOCS.df(spark, d), ["n_chars"]).select("doc_id", F.round("n_chars", 6).alias("n_chars"))


_EVENT_NUMBERS = ["event_id", "user_id", "value"]


@query("iqr_remove", with_fences("SELECT * FROM events", _EVENT_NUMBERS,
    f"SELECT event_id, user_id, value FROM t WHERE NOT ({' OR '.join(map(_outside, _EVENT_NUMBERS))})"))
def iqr_remove(spark, d):
    return impute.remove_outliers(table(spark, d, "events")).select("event_id", "user_id", "value")


_SEQ = ("WITH t AS (SELECT event_id, user_id, value, CASE WHEN value < 100 THEN value + user_id END AS mixed FROM events), "
        "a AS (SELECT * FROM t, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM t) AS q "
        "WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), "
        "b AS (SELECT a.* FROM a, (SELECT quantile_cont(mixed, 0.25) AS m1, quantile_cont(mixed, 0.75) AS m3 FROM a) AS q "
        "WHERE mixed BETWEEN m1 - 1.5 * (m3 - m1) AND m3 + 1.5 * (m3 - m1)) SELECT event_id, user_id, value, mixed FROM b")


@query("iqr_remove_sequential", _SEQ)
def iqr_remove_sequential(spark, d):
    events = table(spark, d, "events").selectExpr("event_id", "user_id", "value", "CASE WHEN value < 100 THEN value + user_id END AS mixed")
    return impute.remove_outliers(events, ["value", "mixed"], sequential=True, keep_nulls=False)


_MESSY = View("lineitem", (
    "l_orderkey AS `Order Key`", "CAST(l_linenumber AS STRING) AS `Line-No`",
    "CASE WHEN l_returnflag = 'A' THEN 'unknown' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS `Total Quantity`",
    "CASE WHEN l_tax > 0.06 THEN NULL ELSE l_extendedprice END AS `Price`",
    "CASE WHEN l_linestatus = 'O' AND l_tax = 0.0 THEN NULL ELSE l_returnflag END AS `Flag`",
    "CAST(NULL AS STRING) AS `Empty`"), twice="l_returnflag = 'R'")
_MESSY_SQL = ("SELECT DISTINCT l_orderkey AS order_key, CAST(l_linenumber AS DOUBLE) AS line_no, "
              "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS total_quantity, "
              "CASE WHEN l_tax > 0.06 THEN NULL ELSE l_extendedprice END AS price, "
              "CASE WHEN l_linestatus = 'O' AND l_tax = 0.0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem")


@query("clean_table", with_t(_MESSY_SQL, """SELECT order_key, line_no, round(coalesce(total_quantity, (SELECT avg(total_quantity) FROM t)), 6) AS total_quantity,
  round(coalesce(price, (SELECT avg(price) FROM t)), 6) AS price,
  coalesce(flag, (SELECT flag FROM t WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS flag FROM t"""))
def clean_table_q(spark, d):
    cleaned = clean_table(_MESSY.df(spark, d)).table
    return cleaned.withColumns({c: F.round(c, 6) for c in ("total_quantity", "price")})


@query("clean_metrics", with_t(_MESSY_SQL, """SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rows_input,
  6 AS columns_input, 6 AS columns_standardized, 0 AS empty_rows_removed, 1 AS empty_columns_removed,
  (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') - count(*) AS duplicates_removed,
  3 * count(*) - count(total_quantity) - count(price) - count(flag) AS missing_values_filled, 0 AS outliers_removed,
  count(*) AS rows_output, 5 AS columns_output FROM t"""))
def clean_metrics(spark, d):
    return clean_table(_MESSY.df(spark, d)).metrics


@query("clean_table_ffill", with_t("SELECT DISTINCT event_id, ts, CASE WHEN value < 60 THEN NULL ELSE value END AS value FROM events",
    """SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM t"""))
def clean_table_ffill(spark, d):
    events = _EVENT_GAPS.df(spark, d).select("event_id", "ts", "value")
    profile = CleaningProfile(fill_missing_strategy="ffill")
    return clean_table(events, profile, ["ts", "event_id"]).table.select("event_id", "value")


@query("clean_simple", with_t(NARROW, "SELECT DISTINCT * FROM t"))
def clean_simple_q(spark, d):
    return clean_simple(NARROW.df(spark, d))


@query("before_after", with_t(COPIED, f"""SELECT metric, CAST(before AS BIGINT) AS before, CAST(after AS BIGINT) AS after, CAST(after - before AS BIGINT) AS change FROM (
  SELECT 'rows' AS metric, (SELECT count(*) FROM t) AS before, (SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u) AS after
  UNION ALL SELECT 'columns', 8, 8 UNION ALL SELECT 'duplicates', (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u), 0
  UNION ALL SELECT 'missing', (SELECT {' + '.join(f'count(*) - count({c})' for c in GAPPY_NUMBERS + GAPPY_TEXT)} FROM t),
    (SELECT {' + '.join(f'count(*) - count({c})' for c in GAPPY_NUMBERS + GAPPY_TEXT)} FROM (SELECT DISTINCT * FROM t) AS u)) AS z"""))
def before_after(spark, d):
    raw = COPIED.df(spark, d)
    return checks.before_after(raw, dedup.dedup_rows(raw))


@query("join_before_after", with_t(NARROW, """SELECT metric, CAST(before AS BIGINT) AS before, CAST(after AS BIGINT) AS after, CAST(after - before AS BIGINT) AS change FROM (
  SELECT 'rows' AS metric, (SELECT count(*) FROM t) AS before, (SELECT count(*) FROM t WHERE flag IS NOT NULL OR status IS NOT NULL OR quantity IS NOT NULL) AS after
  UNION ALL SELECT 'columns', 4, 3
  UNION ALL SELECT 'duplicates', (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u),
    (SELECT count(*) FROM t WHERE flag IS NOT NULL OR status IS NOT NULL OR quantity IS NOT NULL)
    - (SELECT count(*) FROM (SELECT DISTINCT flag, status, quantity FROM t WHERE flag IS NOT NULL OR status IS NOT NULL OR quantity IS NOT NULL) AS u)
  UNION ALL SELECT 'missing', (SELECT 4 * count(*) - count(flag) - count(status) - count(quantity) FROM t),
    (SELECT 3 * count(*) - count(flag) - count(status) - count(quantity) FROM t WHERE flag IS NOT NULL OR status IS NOT NULL OR quantity IS NOT NULL)) AS z"""))
def join_before_after(spark, d):
    from sievemark.operators.rows import drop_empty_columns, drop_empty_rows

    raw = NARROW.df(spark, d)
    return checks.before_after(raw, drop_empty_columns(drop_empty_rows(raw)))


@query("data_fingerprint", "SELECT true AS same, true AS differs, count(*) AS num_rows FROM orders")
def data_fingerprint_q(spark, d):
    """The same rows in another order agree; one changed column does not."""
    orders = table(spark, d, "orders")
    marks = data_fingerprint(orders).withColumn("which", F.lit("a")).unionByName(
        data_fingerprint(orders.repartition(5, "o_custkey")).withColumn("which", F.lit("b"))).unionByName(
        data_fingerprint(orders.withColumn("o_custkey", F.col("o_custkey") + 1)).withColumn("which", F.lit("c")))
    pick = lambda w: F.max(F.when(F.col("which") == w, F.col("data_hash")))
    return marks.agg((pick("a") == pick("b")).alias("same"), (pick("a") != pick("c")).alias("differs"), F.max("num_rows").alias("num_rows"))


@query("file_hash")
def file_hash(spark, d):
    """md5 of the files' own bytes, which SQL over their rows cannot see."""
    return file_hashes(spark, d).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "md5")
