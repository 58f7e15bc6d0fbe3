"""Filters, projections, text clean-up, sorting, set operations and key joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import GAPPY, NARROW, NUMBER_RE, View, each, query, table, with_t
from sievemark.functions import columns, text
from sievemark.functions.casts import inf_to_null
from sievemark.functions.columns import col
from sievemark.operators import rows

_LOUD = View("customer", ("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))


@query("snake_case", """SELECT c_custkey AS cust_key, c_name AS full_name, c_acctbal AS acct_bal, c_mktsegment AS acct_bal_2 FROM customer""")
def snake_case(spark, d):
    loud = _LOUD.df(spark, d).toDF(" Cust-Key ", "Full  Name!", "Acct.Bal", "acct_bal ")
    return columns.rename_snake(loud)


@query("rename_simple", """SELECT c_custkey AS cust_key, c_name AS "full__name!", c_acctbal AS acct_bal, c_mktsegment AS segment FROM customer""")
def rename_simple(spark, d):
    return columns.rename_simple(_LOUD.df(spark, d).toDF(" Cust-Key ", "Full  Name!", "acct bal", "SEGMENT"))


@query("drop_empty_rows", with_t(NARROW, "SELECT * FROM t WHERE flag IS NOT NULL OR status IS NOT NULL OR quantity IS NOT NULL"))
def drop_empty_rows(spark, d):
    return rows.drop_empty_rows(NARROW.df(spark, d))


@query("drop_empty_cols", with_t(NARROW, "SELECT flag, status, quantity FROM t"))
def drop_empty_cols(spark, d):
    return rows.drop_empty_columns(NARROW.df(spark, d))


@query("pred_all_null_row", with_t(NARROW, """SELECT count(*) AS rows, count(*) FILTER (WHERE flag IS NULL AND status IS NULL AND quantity IS NULL) AS empty_rows,
  round(count(*) FILTER (WHERE flag IS NULL AND status IS NULL AND quantity IS NULL) / CAST(count(*) AS DOUBLE), 6) AS empty_row_ratio FROM t"""))
def pred_all_null_row(spark, d):
    return rows.empty_row_stats(NARROW.df(spark, d)).withColumn("empty_row_ratio", F.round("empty_row_ratio", 6))


_INF = View("lineitem", ("l_orderkey", "l_linenumber", "CASE WHEN l_tax = 0.0 THEN CAST('inf' AS DOUBLE) WHEN l_tax = 0.08 THEN CAST('-inf' AS DOUBLE) ELSE l_quantity END AS x"))


@query("inf_to_null", """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0.0 OR l_tax = 0.08 THEN NULL ELSE l_quantity END AS x FROM lineitem""")
def inf_to_null_q(spark, d):
    return inf_to_null(_INF.df(spark, d))


@query("strip_html", """SELECT page_id, md5(trim(regexp_replace(html, '<[^>]+>', '', 'g'))) AS text_md5,
  length(trim(regexp_replace(html, '<[^>]+>', '', 'g'))) AS chars FROM pages""")
def strip_html(spark, d):
    clean = text.strip_html(table(spark, d, "pages").select("page_id", "html"))
    return clean.select("page_id", F.md5("html").alias("text_md5"), F.char_length("html").alias("chars"))


@query("add_provenance", """SELECT doc_id, lang, 'docs_1' AS _source, 'text' AS _domain, 'files' AS _adapter,
  'https://example.com/docs' AS _origin_url FROM documents""")
def add_provenance(spark, d):
    tagged = text.add_provenance(table(spark, d, "documents").select("doc_id", "lang"), "docs_1", "text", "files", "https://example.com/docs")
    return tagged.drop("_fetched_at")


@query("project_visible", "SELECT o_orderkey, o_totalprice FROM orders")
def project_visible(spark, d):
    return columns.project_visible(table(spark, d, "orders"), ["o_totalprice", "o_orderkey", "missing"])


@query("filter_equals", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
def filter_equals(spark, d):
    return rows.filter_equals(table(spark, d, "orders"), {"o_orderstatus": "F", "o_orderpriority": "5-LOW", "missing": 1})


@query("filter_search", """SELECT * FROM customer WHERE lower(CAST(c_custkey AS VARCHAR)) LIKE '%auto%' OR lower(c_name) LIKE '%auto%'
OR lower(c_mktsegment) LIKE '%auto%'""")
def filter_search(spark, d):
    return rows.filter_search(table(spark, d, "customer"), "AUTO", ["c_custkey", "c_name", "c_mktsegment"])


_PAIR = View("lineitem", ("l_orderkey", "l_linenumber", "CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity END AS x",
                          "CASE WHEN l_returnflag = 'A' THEN 'n/a' ELSE CAST(l_linenumber AS STRING) END AS y"))


@query("filter_pairwise", with_t(_PAIR, "SELECT l_orderkey, l_linenumber, x, TRY_CAST(y AS DOUBLE) AS y FROM t WHERE x IS NOT NULL AND y <> 'n/a'"))
def filter_pairwise(spark, d):
    return rows.filter_pairwise(_PAIR.df(spark, d), "x", "y")


_COUNTED = View("lineitem", ("l_quantity - 3 AS num_items", "l_linenumber - 2 AS total_lines", "l_tax AS price"))


@query("pred_negative", with_t(_COUNTED, each(["num_items", "total_lines"], """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS violations FROM t""")))
def pred_negative(spark, d):
    return rows.negative_counts(_COUNTED.df(spark, d))


_RATED = View("lineitem", ("l_quantity * 3 AS fill_pct", "l_discount - 0.02 AS tax_rate", "l_tax AS price"))


@query("pred_pct_range", with_t(_RATED, each(["fill_pct", "tax_rate"], """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0 OR {c} > 100) AS violations FROM t""")))
def pred_pct_range(spark, d):
    return rows.percent_out_of_range(_RATED.df(spark, d))


@query("sanitize_detail", r"""SELECT conv_id, turn, md5(trim(replace(translate(text, '\|[]', '/•()'), '''', ''))) AS m FROM conversations""")
def sanitize_detail(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(text.safe_detail(F.col("text"))).alias("m"))


@query("sanitize_markdown", r"""SELECT conv_id, turn, md5(CASE WHEN regexp_matches(replace(text, '|', '•'), '^[#\-*>]')
  THEN ' ' || replace(text, '|', '•') ELSE replace(text, '|', '•') END) AS m FROM conversations""")
def sanitize_markdown(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(text.safe_markdown(F.col("text"))).alias("m"))


@query("strip_control", r"""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)),
  '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[\x{202D}\x{202E}\x{200B}\x{200C}\x{200D}]', '', 'g')) AS m FROM documents""")
def strip_control(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.strip_control(F.col("text"))).alias("m"))


@query("sort_column", """SELECT * FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_tax DESC NULLS LAST, l_orderkey, l_linenumber, l_discount, l_extendedprice) AS place, l_tax FROM ("""
       + GAPPY.sql() + """) AS g) AS z""")
def sort_column(spark, d):
    ordered = rows.sort_column(GAPPY.df(spark, d), "l_tax", False, ["l_orderkey", "l_linenumber", "l_discount", "l_extendedprice"])
    from sievemark.operators.order import with_row_id

    return with_row_id(ordered, [F.col("l_tax").desc_nulls_last(), "l_orderkey", "l_linenumber", "l_discount", "l_extendedprice"], "place").select(
        "l_orderkey", "place", "l_tax")


_NATURAL = View("part", ("p_partkey", "CASE WHEN p_size > 40 THEN 'none' WHEN p_size > 38 THEN NULL ELSE CAST(p_size AS STRING) END AS size_text"))


@query("page", with_t(_NATURAL, f"""SELECT p_partkey, size_text FROM t ORDER BY CASE WHEN regexp_full_match(size_text, '{NUMBER_RE}')
  THEN TRY_CAST(size_text AS DOUBLE) END NULLS LAST, size_text NULLS LAST, p_partkey LIMIT 25 OFFSET 50"""))
def page(spark, d):
    frame = _NATURAL.df(spark, d)
    return rows.page(frame, [*rows.sort_keys(frame, "size_text"), col("p_partkey")], 3)


@query("preview", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders ORDER BY orders.o_orderkey LIMIT 5""")
def preview(spark, d):
    return rows.preview(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey"), ["o_orderkey"])


@query("preview_table", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source FROM documents ORDER BY documents.doc_id LIMIT 10""")
def preview_table(spark, d):
    return rows.preview(table(spark, d, "documents").select("doc_id", "lang", "source"), ["doc_id"], 10)


@query("sort_time", """SELECT event_id, ts FROM events ORDER BY ts, event_id""")
def sort_time(spark, d):
    return table(spark, d, "events").select("event_id", "ts").orderBy("ts", "event_id")


@query("latest_n", """SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def latest_n(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "event_type").orderBy(F.desc("ts"), F.desc("event_id")).limit(20)


@query("union_all", """SELECT c_nationkey AS nation, c_acctbal AS balance, 'customer' AS kind FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, 'supplier' FROM supplier""")
def union_all(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"))
    suppliers = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return customers.unionByName(suppliers)


@query("scalar_functions", r"""SELECT doc_id, array_to_string(list_slice(regexp_extract_all(lower(text), '[a-z]+'), 1, 3), ' ') AS first_words,
  upper(substr(lang, 1, 1)) || substr(lang, 2) AS lang_title, starts_with(text, 'The') AS starts_the, ends_with(trim(text), '.') AS ends_dot,
  contains(text, 'and') AS has_and FROM documents""")
def scalar_functions(spark, d):
    t = F.col("text")
    words = F.regexp_extract_all(F.lower(t), F.lit("([a-z]+)"), 1)
    return table(spark, d, "documents").select(
        "doc_id", F.array_join(F.slice(words, 1, 3), " ").alias("first_words"), F.initcap("lang").alias("lang_title"),
        t.startswith("The").alias("starts_the"), F.trim(t).endswith(".").alias("ends_dot"), t.contains("and").alias("has_and"))


@query("json_functions", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_functions(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
