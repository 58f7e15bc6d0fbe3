"""Chart data and chart selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import View, query, table, with_t
from sievemark.catalog.statistics import _outside, with_fences
from sievemark.operators import charts, correlation
from sievemark.operators.categorical import distinct_counts
from sievemark.operators.profile import column_profile
from sievemark.session import materialize

_HIST = """WITH q AS (SELECT count({c}) AS n, min({c}) AS lo, max({c}) AS hi, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}),
b AS (SELECT *, {bins} AS k FROM q)
SELECT CAST(least(floor(({c} - lo) / ((hi - lo) / k)), k - 1) AS INT) AS bin, count(*) AS count,
  count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers FROM {t}, b WHERE {c} IS NOT NULL GROUP BY 1"""
_AUTO = "ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * (q3 - q1) / pow(n, 1.0 / 3)))"


@query("hist_bins", _HIST.format(c="value", t="events", bins=_AUTO))
def hist_bins(spark, d):
    return charts.hist_bins(table(spark, d, "events"), "value").select("bin", "count", "outliers")


@query("hist_bins_20", _HIST.format(c="o_totalprice", t="orders", bins="20"))
def hist_bins_20(spark, d):
    return charts.hist_bins(table(spark, d, "orders"), "o_totalprice", 20).select("bin", "count", "outliers")


_SERIES = View("events", ("event_id", "ts", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value"))


@query("line_rowindex", with_t(_SERIES, """, z AS (SELECT value, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, 1 AS run FROM t WHERE value IS NOT NULL)
SELECT i // run AS point, min(i) AS first_index, round(avg(value), 6) AS mean, count(*) AS count FROM z GROUP BY 1""").replace(") ,", "),", 1))
def line_rowindex(spark, d):
    return charts.line_rowindex(_SERIES.df(spark, d), "value", ["ts", "event_id"]).withColumn("mean", F.round("mean", 6))


@query("timeseries", "SELECT o_orderdate AS time, o_totalprice AS value FROM orders")
def timeseries(spark, d):
    return charts.timeseries(table(spark, d, "orders"), "o_orderdate", "o_totalprice")


@query("timeseries_monthly", "SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS time, round(avg(o_totalprice), 4) AS value FROM orders GROUP BY 1")
def timeseries_monthly(spark, d):
    return charts.timeseries(table(spark, d, "orders"), "o_orderdate", "o_totalprice", "month").select(
        F.col("time").cast("timestamp_ntz").alias("time"), F.round("value", 4).alias("value"))


_EVENT_NUMBERS = ["user_id", "value"]
_BOX = """SELECT '{c}' AS "column", round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
  CAST(min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_low, CAST(max({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_high,
  count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS beyond FROM events,
  (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM events) AS q GROUP BY q1, m, q3"""
_BOX_SQL = " UNION ALL ".join(_BOX.format(c=c) for c in _EVENT_NUMBERS)


def _box(df):
    return df.drop("extreme_ratio").withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("box_stats", _BOX_SQL)
def box_stats(spark, d):
    return _box(charts.box_stats(table(spark, d, "events"), _EVENT_NUMBERS))


_FLAGGED = f"({' OR '.join(_outside(c) for c in ('event_id', 'user_id', 'value'))}) AS _is_outlier"


@query("scatter_points", with_fences("SELECT * FROM events", ["event_id", "user_id", "value"],
    f"SELECT CAST(user_id AS DOUBLE) AS x, CAST(value AS DOUBLE) AS y, {_FLAGGED} FROM t"))
def scatter_points(spark, d):
    return charts.scatter_points(table(spark, d, "events"), "user_id", "value")


@query("scatter_summary", with_fences("SELECT * FROM events", ["event_id", "user_id", "value"], f"SELECT {_FLAGGED}, count(*) AS n FROM t GROUP BY 1"))
def scatter_summary(spark, d):
    return charts.scatter_summary(table(spark, d, "events"), "user_id", "value")


@query("scatter_sample")
def scatter_sample(spark, d):
    """A drawing sample chosen by a hash SQL does not have."""
    return charts.scatter_points(table(spark, d, "events"), "user_id", "value", 500)


_PICK = View("orders", ("o_orderkey", "o_custkey", "o_totalprice", "o_totalprice * 2 + o_custkey AS linked", "o_orderstatus", "o_orderpriority",
                        "CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS year_text", "o_orderdate"))


def _tables(spark, d):
    frame = _PICK.df(spark, d)
    return frame, *map(materialize, (column_profile(frame, ["o_orderkey"]), correlation.correlation_pairs(frame), distinct_counts(frame)))


_SELECTED = with_t(_PICK, """SELECT * FROM (VALUES
 ('hist_o_orderkey', 'histogram', 'o_orderkey'), ('hist_o_custkey', 'histogram', 'o_custkey'), ('hist_o_totalprice', 'histogram', 'o_totalprice'),
 ('hist_linked', 'histogram', 'linked'), ('line_o_orderkey', 'line', 'o_orderkey'), ('scatter_o_totalprice_linked', 'scatter', 'o_totalprice,linked'),
 ('correlation_heatmap', 'heatmap', 'o_orderkey,o_custkey,o_totalprice,linked'), ('boxplot_numeric', 'box', 'o_orderkey,o_custkey,o_totalprice,linked'),
 ('ts_o_orderdate_o_orderkey', 'line', 'o_orderdate,o_orderkey'), ('ts_o_orderdate_o_custkey', 'line', 'o_orderdate,o_custkey'),
 ('ts_o_orderdate_o_totalprice', 'line', 'o_orderdate,o_totalprice'), ('ts_o_orderdate_linked', 'line', 'o_orderdate,linked')) AS v(chart_id, chart_type, columns_used)
UNION ALL SELECT CASE WHEN n <= 8 THEN 'pie_' ELSE 'bar_' END || c, CASE WHEN n <= 8 THEN 'pie' ELSE 'bar' END, c FROM (
  SELECT 'o_orderstatus' AS c, count(DISTINCT o_orderstatus) AS n FROM t UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM t
  UNION ALL SELECT 'year_text', count(DISTINCT year_text) FROM t) AS z WHERE n BETWEEN 1 AND 30
UNION ALL SELECT 'grouped_' || c || '_o_orderkey', 'bar', c || ',o_orderkey' FROM (
  SELECT 'o_orderstatus' AS c, count(DISTINCT o_orderstatus) AS n FROM t UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM t
  UNION ALL SELECT 'year_text', count(DISTINCT year_text) FROM t) AS z WHERE n BETWEEN 2 AND 15""")


@query("chart_select", _SELECTED)
def chart_select(spark, d):
    return charts.chart_select(*_tables(spark, d)).drop("title")


@query("join_chart_stats", with_t(_PICK, "SELECT 'hist_' || c AS chart_id, round(m, 4) AS mean, missing AS missing_count FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS c, avg({c}) AS m, count(*) - count({c}) AS missing FROM t" for c in ("o_orderkey", "o_custkey", "o_totalprice", "linked")) + ") AS z"))
def join_chart_stats(spark, d):
    frame, profile, pairs, distinct = _tables(spark, d)
    picked = charts.chart_select(frame, profile, pairs, distinct).filter("chart_type = 'histogram'")
    return charts.attach_stats(picked, profile).select("chart_id", F.round("mean", 4).alias("mean"), "missing_count")


@query("custom_chart_data", _BOX_SQL)
def custom_chart_data(spark, d):
    return _box(charts.custom_chart_data(table(spark, d, "events"), "box", _EVENT_NUMBERS))


@query("custom_chart_bar", "SELECT event_type AS x, round(avg(value), 5) AS mean FROM events GROUP BY 1 ORDER BY avg(value) DESC, 1 LIMIT 20")
def custom_chart_bar(spark, d):
    return charts.custom_chart_data(table(spark, d, "events"), "bar", ["event_type", "value"]).withColumn("mean", F.round("mean", 5))


@query("custom_chart_fallback", "SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def custom_chart_fallback(spark, d):
    return charts.custom_chart_data(table(spark, d, "events"), "histogram", ["event_type"])


@query("execute_spec", "SELECT o_orderpriority AS x, round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY avg(o_totalprice) DESC, 1 LIMIT 20")
def execute_spec(spark, d):
    spec = charts.PlotSpec("bar", "o_orderpriority", "o_totalprice", {"o_orderstatus": "F"})
    return charts.execute_spec(table(spark, d, "orders"), spec).withColumn("mean", F.round("mean", 4))
