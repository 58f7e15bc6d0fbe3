"""Frequencies, distinct counts, grouped means, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import GAPPY, GAPPY_TEXT, View, each, query, stacked, table, with_t
from sievemark.operators import categorical, grouped, rows

_GAPPY_ALL = GAPPY.names()
_FREQ = """SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM t GROUP BY 2"""


@query("value_counts", with_t(GAPPY, f"""SELECT "column", rank, value, n AS count,
  round_even(n * 100.0 / (SELECT count(*) FROM t), 2) AS pct FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST) AS rank FROM {stacked(GAPPY_TEXT, _FREQ)}) AS r
WHERE rank <= 10"""))
def value_counts(spark, d):
    return categorical.value_counts(GAPPY.df(spark, d), GAPPY_TEXT)


@query("topk_counts", """SELECT CAST(o_orderdate AS VARCHAR) AS value, count(*) AS count FROM orders
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def topk_counts(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("string").alias("day"))
    return categorical.top_values(orders, "day", 15)


@query("nunique", with_t(GAPPY, each(_GAPPY_ALL, """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
  count({c}) < count(*) AS has_null, count(*) AS n_rows FROM t""")))
def nunique(spark, d):
    return categorical.distinct_counts(GAPPY.df(spark, d))


@query("cardinality_ratio", with_t(GAPPY, each(_GAPPY_ALL, """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
  round_even(count(DISTINCT {c}) * 10000.0 / count(*), 0) / 10000 AS cardinality_ratio FROM t""")))
def cardinality_ratio(spark, d):
    return categorical.cardinality_ratios(GAPPY.df(spark, d), _GAPPY_ALL)


@query("unique_ratio", with_t(GAPPY, each(_GAPPY_ALL, """SELECT '{c}' AS "column",
  round((count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS unique_ratio FROM t""")))
def unique_ratio(spark, d):
    return categorical.unique_ratios(GAPPY.df(spark, d)).withColumn("unique_ratio", F.round("unique_ratio", 6))


@query("class_imbalance", with_t(GAPPY, f"""SELECT "column", count(*) AS classes,
  CASE WHEN count(*) >= 2 THEN round_even(max(n) / CAST(greatest(min(n), 1) AS DOUBLE), 2) ELSE 0.0 END AS imbalance_ratio
FROM {stacked(GAPPY_TEXT, _FREQ)} GROUP BY 1"""))
def class_imbalance(spark, d):
    return categorical.class_imbalance(GAPPY.df(spark, d), GAPPY_TEXT)


_CATEGORY = View("orders", ("o_orderstatus", "o_orderpriority", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS day"))


@query("categorical_profile", with_t(_CATEGORY, f"""
SELECT f."column", count(f.value) AS unique_count,
  (SELECT string_agg(value || '=' || n, ';' ORDER BY n DESC, value) FROM (SELECT value, n FROM {stacked(_CATEGORY.names(), _FREQ)}
   WHERE "column" = f."column" ORDER BY n DESC, value LIMIT 10) AS z) AS top_values,
  round_even(max(n) / CAST(min(n) AS DOUBLE), 2) AS class_imbalance_ratio,
  round_even(sum(length(value) * n) / CAST(sum(n) AS DOUBLE), 1) AS avg_text_length, min(length(value)) AS min_text_length,
  max(length(value)) AS max_text_length, round_even(count(f.value) / CAST(sum(n) AS DOUBLE), 4) AS cardinality_ratio
FROM {stacked(_CATEGORY.names(), _FREQ).replace('AS stacked', 'AS f')} GROUP BY 1"""))
def categorical_profile(spark, d):
    top = F.array_join(F.transform("top_values", lambda t: F.concat_ws("=", t["value"], t["count"].cast("string"))), ";")
    return categorical.categorical_profile(_CATEGORY.df(spark, d)).withColumn("top_values", top).drop("top_share")


@query("string_length_stats", with_t("SELECT text, lang, source FROM documents", each(["text", "lang", "source"], """
SELECT '{c}' AS "column", round_even(avg(length({c})), 1) AS avg_text_length, min(length({c})) AS min_text_length,
  max(length({c})) AS max_text_length FROM t""")))
def string_length_stats(spark, d):
    return categorical.text_lengths(table(spark, d, "documents"), ["text", "lang", "source"]).drop("text_length_variance")


@query("string_length_var", with_t("SELECT text, lang, source FROM documents", f"""
SELECT round(avg(v), 3) AS avg_string_length_variance, round(max(v), 3) AS max_string_length_variance FROM
{stacked(["text", "lang", "source"], "SELECT var_samp(length({c})) AS v FROM t")}"""))
def string_length_var(spark, d):
    return categorical.text_lengths(table(spark, d, "documents"), ["text", "lang", "source"]).agg(
        F.round(F.avg("text_length_variance"), 3).alias("avg_string_length_variance"),
        F.round(F.max("text_length_variance"), 3).alias("max_string_length_variance"))


_RULED = View("lineitem", (
    "CASE WHEN l_quantity > 20 THEN 'large' WHEN l_quantity > 1 THEN 'small' ELSE 'one' END AS size",
    "CASE WHEN l_discount = 0.0 THEN NULL ELSE l_returnflag END AS flag", "l_linestatus",
))


@query("dominant_category", with_t(_RULED, f"""SELECT *, top_pct > 50 AS dominant, imbalance > 10 AS imbalanced FROM (
  SELECT "column", arg_min(value, -n * 1000 + ascii(value)) FILTER (WHERE value IS NOT NULL) AS top_value,
    round_even(max(n) FILTER (WHERE value IS NOT NULL) * 100.0 / sum(n), 1) AS top_pct,
    round_even(max(n) FILTER (WHERE value IS NOT NULL) / CAST(min(n) FILTER (WHERE value IS NOT NULL) AS DOUBLE), 2) AS imbalance
  FROM {stacked(_RULED.names(), _FREQ)} GROUP BY 1) AS z WHERE top_pct > 50 OR imbalance > 10"""))
def dominant_category(spark, d):
    return categorical.dominant_categories(_RULED.df(spark, d), _RULED.names())


_CONSTANT = View("lineitem", ("l_orderkey", "CAST(3 AS INT) AS same", "CAST(NULL AS STRING) AS nothing",
                              "CASE WHEN l_tax > 0.05 THEN 'x' END AS half", "l_linestatus"))


@query("constant_columns", with_t(_CONSTANT, f"""SELECT "column", n AS n_distinct FROM
{stacked(_CONSTANT.names(), "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM t")} WHERE n <= 1"""))
def constant_columns(spark, d):
    return categorical.constant_columns(_CONSTANT.df(spark, d))


@query("constant_columns_null_counted", with_t(_CONSTANT, f"""SELECT "column", n AS n_distinct FROM
{stacked(_CONSTANT.names(), "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n, count({c}) < count(*) AS g FROM t")}
WHERE n + CASE WHEN g THEN 1 ELSE 0 END <= 1"""))
def constant_columns_null_counted(spark, d):
    return categorical.constant_columns(_CONSTANT.df(spark, d), count_null=True)


_GROUP_SQL = """SELECT {cat} AS category, count(*) AS frequency, round(avg({num}), 4) AS mean,
  round(stddev_samp({num}), 4) AS std, count({num}) AS count FROM {src} WHERE {cat} IS NOT NULL GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT {k}"""


@query("group_mean_top", _GROUP_SQL.format(cat="p_brand", num="p_retailprice", src="part", k=10))
def group_mean_top(spark, d):
    return grouped.group_mean_top(table(spark, d, "part"), "p_brand", "p_retailprice").withColumns(
        {"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("join_reindex", """SELECT t.category, t.frequency, g.big FROM (
  SELECT p_brand AS category, count(*) AS frequency FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) AS t
LEFT JOIN (SELECT p_brand AS category, count(*) AS big FROM part WHERE p_retailprice > 1050 GROUP BY 1 HAVING count(*) > 5) AS g USING (category)""")
def join_reindex(spark, d):
    part = table(spark, d, "part")
    big = part.filter("p_retailprice > 1050").groupBy(F.col("p_brand").alias("category")).agg(
        F.count(F.lit(1)).alias("big")).filter("big > 5")
    return grouped.reindex_by_frequency(part, "p_brand", big, 10)


@query("join_top_categories", """SELECT p_brand, p_partkey, p_retailprice FROM part WHERE p_brand IN (
  SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)""")
def join_top_categories(spark, d):
    return grouped.keep_top_categories(table(spark, d, "part"), "p_brand", 10).select("p_brand", "p_partkey", "p_retailprice")


@query("filter_isin_top", """SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8) GROUP BY 1""")
def filter_isin_top(spark, d):
    return grouped.keep_top_categories(table(spark, d, "orders"), "o_custkey", 8).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_NLARGEST = """SELECT o_custkey AS x, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1 ORDER BY avg(o_totalprice) DESC, 1 LIMIT 20"""


@query("group_mean_nlargest", _NLARGEST)
def group_mean_nlargest(spark, d):
    return grouped.group_mean_nlargest(table(spark, d, "orders"), "o_custkey", "o_totalprice").withColumn("mean", F.round("mean", 4))


@query("topk_nlargest", """SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def topk_nlargest(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query("counts_top20", """SELECT CAST(p_size AS VARCHAR) AS value, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def counts_top20(spark, d):
    from sievemark.operators.charts import counts_top20 as run

    return run(table(spark, d, "part"), "p_size")


_OTHER = """WITH c AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS k FROM c)
SELECT CASE WHEN k <= 8 THEN value ELSE 'Other' END AS value, CAST(sum(n) AS BIGINT) AS count,
  round(sum(n) / CAST((SELECT count(*) FROM part) AS DOUBLE), 6) AS share FROM r GROUP BY 1"""


@query("other_bucket", _OTHER)
def other_bucket(spark, d):
    return grouped.other_bucket(table(spark, d, "part"), "p_brand").withColumn("share", F.round("share", 6))


@query("pie_share", _OTHER.replace("p_brand", "o_orderpriority").replace("part", "orders"))
def pie_share(spark, d):
    from sievemark.operators.charts import pie_share as run

    return run(table(spark, d, "orders"), "o_orderpriority").withColumn("share", F.round("share", 6))


@query("bar_topn", """SELECT p_brand AS value, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def bar_topn(spark, d):
    from sievemark.operators.charts import bar_topn as run

    return run(table(spark, d, "part"), "p_brand")


@query("grouped_bar", _GROUP_SQL.format(cat="o_orderpriority", num="o_totalprice", src="orders", k=10))
def grouped_bar(spark, d):
    from sievemark.operators.charts import grouped_bar as run

    return run(table(spark, d, "orders"), "o_orderpriority", "o_totalprice").withColumns(
        {"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("class_distribution", """SELECT d.source AS split, l.quality AS label, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY d.source), 4) AS pct
FROM documents d JOIN labels l USING (doc_id) GROUP BY 1, 2""")
def class_distribution(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    return grouped.class_distribution(joined, "source", "quality").withColumn("pct", F.round("pct", 4))


@query("model_compare", """WITH s AS (
  SELECT event_type AS metric, 'model_' || (user_id % 2) AS model, value FROM events),
m AS (SELECT metric, model, avg(value) AS mean, stddev_samp(value) AS std FROM s GROUP BY 1, 2)
SELECT metric, model, round(mean, 5) AS mean, round(std, 5) AS std,
  first_value(model) OVER (PARTITION BY metric ORDER BY mean DESC, model) AS winner FROM m""")
def model_compare(spark, d):
    scores = table(spark, d, "events").select(
        F.col("event_type").alias("metric"), F.concat(F.lit("model_"), (F.col("user_id") % 2).cast("string")).alias("model"), "value")
    return grouped.model_compare(scores, "model", "metric", "value").withColumns(
        {"mean": F.round("mean", 5), "std": F.round("std", 5)})


@query("approx_nunique")
def approx_nunique(spark, d):
    return categorical.approx_distinct_counts(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])


@query("column_modes", with_t(GAPPY, each(["l_linenumber", "l_returnflag", "l_discount"], """SELECT '{c}' AS "column",
  (SELECT CAST({c} AS VARCHAR) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
  (SELECT count(*) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS count FROM (SELECT 1) AS one""")))
def column_modes(spark, d):
    return categorical.column_modes(GAPPY.df(spark, d), ["l_linenumber", "l_returnflag", "l_discount"])


@query("select_numeric", """SELECT * FROM (VALUES ('l_orderkey', 'numeric'), ('l_partkey', 'numeric'), ('l_suppkey', 'numeric'),
 ('l_linenumber', 'numeric'), ('l_quantity', 'numeric'), ('l_extendedprice', 'numeric'), ('l_discount', 'numeric'), ('l_tax', 'numeric'),
 ('l_returnflag', 'categorical'), ('l_linestatus', 'categorical'), ('l_shipdate', 'datetime')) AS v("column", role)""")
def select_numeric(spark, d):
    return rows.numeric_first(table(spark, d, "lineitem"))
