"""Column statistics, quantiles, correlation, trend and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import ORACLES
from sievemark.catalog.base import (
    GAPPY, GAPPY_NUMBERS, GAPPY_TEXT, LINE_NUMBERS, View, each, query, stacked, table, with_t,
)
from sievemark.operators import correlation, outliers, profile, quantiles
from sievemark.operators.reshape import as_pairs

_PROFILE_NUMBER = """
SELECT '{c}' AS "column", any_value(typeof({c})) AS t, round_even(round(avg({c}), 10), 6) AS mean,
  round_even(quantile_cont({c}, 0.5), 6) AS median, round_even(round(stddev_samp({c}), 10), 6) AS std,
  round_even(CAST(min({c}) AS DOUBLE), 6) AS min, round_even(CAST(max({c}) AS DOUBLE), 6) AS max,
  round_even(quantile_cont({c}, 0.25), 6) AS q1, round_even(quantile_cont({c}, 0.75), 6) AS q3,
  count(*) - count({c}) AS missing_count, round_even((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct,
  (SELECT count(*) FROM t, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM t) AS f
   WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outlier_count FROM t"""
_PROFILE_TEXT = """
SELECT '{c}' AS "column", any_value(typeof({c})) AS t, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  count(*) - count({c}), round_even((count(*) - count({c})) * 100.0 / count(*), 2), 0 FROM t"""
_DTYPE = """CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS dtype"""


def _profile_sql(source, numbers, texts, trend="CAST(NULL AS VARCHAR)") -> str:
    parts = each(numbers, _PROFILE_NUMBER) + " UNION ALL " + each(texts, _PROFILE_TEXT)
    return with_t(source, f"""SELECT "column", {_DTYPE}, mean, median, std, min, max, q1, q3,
      CAST(missing_count AS BIGINT) AS missing_count, CAST(missing_pct AS DOUBLE) AS missing_pct,
      CAST(outlier_count AS BIGINT) AS outlier_count, {trend} AS trend FROM ({parts}) AS p""")


@query("col_profile", _profile_sql(
    "SELECT * FROM lineitem", LINE_NUMBERS, ["l_returnflag", "l_linestatus", "l_shipdate"]))
def col_profile(spark, d):
    return profile.column_profile(table(spark, d, "lineitem"))


@query("col_profile_gaps", _profile_sql(GAPPY, GAPPY_NUMBERS, GAPPY_TEXT))
def col_profile_gaps(spark, d):
    return profile.column_profile(GAPPY.df(spark, d))


@query("col_profile_trend", _profile_sql(
    "SELECT * FROM orders", ["o_orderkey", "o_custkey", "o_totalprice"],
    ["o_orderstatus", "o_orderdate", "o_orderpriority"],
    "CASE \"column\" WHEN 'o_orderkey' THEN 'increasing' WHEN 'o_custkey' THEN 'flat' WHEN 'o_totalprice' THEN 'flat' END"))
def col_profile_trend(spark, d):
    return profile.column_profile(table(spark, d, "orders"), ["o_orderkey"])


@query("quantile_linear", with_t(GAPPY, each(GAPPY_NUMBERS, each(
    ["0.05", "0.25", "0.5", "0.75", "0.95"],
    """SELECT '{col}' AS "column", CAST({c} AS DOUBLE) AS prob, round(quantile_cont({col}, {c}), 6) AS value FROM t"""
).replace("{col}", "{c}"))))
def quantile_linear(spark, d):
    return quantiles.quantile_table(GAPPY.df(spark, d), GAPPY_NUMBERS, [0.05, 0.25, 0.5, 0.75, 0.95]).select(
        "column", "prob", F.round("value", 6).alias("value"))


@query("desc_stats", with_t(GAPPY, each(GAPPY_NUMBERS, """
SELECT '{c}' AS "column", round(stddev_samp({c}), 5) AS standard_deviation, round(var_samp({c}), 1) AS variance,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, CAST(max({c}) - min({c}) AS DOUBLE) AS range,
  quantile_cont({c}, 0.5) AS median,
  (SELECT CAST({c} AS DOUBLE) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM t""")))
def desc_stats(spark, d):
    return profile.descriptive_stats(GAPPY.df(spark, d)).select(
        "column", F.round("standard_deviation", 5).alias("standard_deviation"), F.round("variance", 1).alias("variance"),
        "min", "max", "range", "median", "mode")


@query("view_stats", with_t(GAPPY, each(GAPPY_NUMBERS, """
SELECT '{c}' AS "column", count({c}) AS count, round(round(avg({c}), 10), 6) AS mean, quantile_cont({c}, 0.5) AS median,
  (SELECT CAST({c} AS DOUBLE) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
  CAST(max({c}) - min({c}) AS DOUBLE) AS range, round(var_pop({c}), 1) AS variance, round(stddev_pop({c}), 5) AS std,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM t""")))
def view_stats(spark, d):
    return profile.viewer_stats(GAPPY.df(spark, d), GAPPY_NUMBERS).select(
        "column", "count", F.round(F.round("mean", 10), 6).alias("mean"), "median", "mode", "range",
        F.round("variance", 1).alias("variance"), F.round("std", 5).alias("std"), "min", "max")


@query("missing_counts", with_t(GAPPY, each(GAPPY_NUMBERS + GAPPY_TEXT, """
SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing,
  round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS ratio FROM t""")))
def missing_counts(spark, d):
    return profile.missing_counts(GAPPY.df(spark, d)).withColumn("ratio", F.round("ratio", 6))


@query("null_ratio_summary", with_t(GAPPY, f"""
SELECT round(avg(r), 6) AS null_ratio_mean, round(max(r), 6) AS null_ratio_max,
  round(stddev_pop(r), 6) AS null_ratio_std, count(*) FILTER (WHERE r > 0.5) AS num_high_null_columns FROM
{stacked(GAPPY_NUMBERS + GAPPY_TEXT, "SELECT (count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS r FROM t")}"""))
def null_ratio_summary(spark, d):
    return profile.null_ratio_summary(GAPPY.df(spark, d)).select(
        *[F.round(c, 6).alias(c) for c in ("null_ratio_mean", "null_ratio_max", "null_ratio_std")],
        "num_high_null_columns")


_SKEW_VIEW = View("lineitem", (*GAPPY.exprs, "CAST(7 AS DOUBLE) AS constant"))
_SKEW_NUMBERS = [*GAPPY_NUMBERS, "constant"]


@query("skew_adj", with_t(_SKEW_VIEW, each(_SKEW_NUMBERS, """
SELECT '{c}' AS "column", CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE round(skewness({c}), 6) END AS skew_adj FROM t""")))
def skew_adj(spark, d):
    return profile.shape_stats(_SKEW_VIEW.df(spark, d)).select("column", F.round("skew_adj", 6).alias("skew_adj"))


@query("kurt_adj", with_t(_SKEW_VIEW, each(_SKEW_NUMBERS, """
SELECT '{c}' AS "column", CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE round(kurtosis({c}), 6) END AS kurt_adj FROM t""")))
def kurt_adj(spark, d):
    return profile.shape_stats(_SKEW_VIEW.df(spark, d)).select("column", F.round("kurt_adj", 6).alias("kurt_adj"))


@query("skew_kurt_pop", with_t(GAPPY, each(GAPPY_NUMBERS, """
SELECT '{c}' AS "column", round(avg(d * d * d) / power(avg(d * d), 1.5), 6) AS skew_pop,
  round(avg(d * d * d * d) / power(avg(d * d), 2) - 3, 6) AS kurt_pop
FROM (SELECT {c} - (SELECT avg({c}) FROM t) AS d FROM t) AS z""")))
def skew_kurt_pop(spark, d):
    return profile.shape_stats(GAPPY.df(spark, d)).select(
        "column", F.round("skew_pop", 6).alias("skew_pop"), F.round("kurt_pop", 6).alias("kurt_pop"))


@query("coef_variation", with_t(GAPPY, f"""SELECT round(avg(cv), 6) AS coef_variation FROM
{stacked(GAPPY_NUMBERS, "SELECT CASE WHEN abs(avg({c})) > 1e-10 THEN least(abs(stddev_samp({c}) / avg({c})), 100) END AS cv FROM t")}"""))
def coef_variation(spark, d):
    return profile.shape_stats(GAPPY.df(spark, d)).agg(F.round(F.avg("coef_variation"), 6).alias("coef_variation"))


@query("mean_variance", with_t(GAPPY, f"""SELECT round(avg(v), 0) AS mean_variance FROM
{stacked(GAPPY_NUMBERS, "SELECT var_samp({c}) AS v FROM t")}"""))
def mean_variance(spark, d):
    return profile.shape_stats(GAPPY.df(spark, d)).agg(F.round(F.avg("variance"), 0).alias("mean_variance"))


_DOC_NUMBERS = View("documents", ("doc_id", "n_chars", "char_length(text) AS text_chars"))


@query("pearson_skew2", with_t(_DOC_NUMBERS, f"""SELECT "column", round((mean - median) / std, 4) AS skew,
  CASE WHEN mean > median THEN 'right' ELSE 'left' END AS side FROM
{stacked(["doc_id", "n_chars", "text_chars"], '''SELECT '{c}' AS "column", round_even(round(avg({c}), 10), 6) AS mean,
  round_even(quantile_cont({c}, 0.5), 6) AS median, round_even(round(stddev_samp({c}), 10), 6) AS std FROM t''')}
WHERE std > 0 AND abs((mean - median) / std) > 0.3"""))
def pearson_skew2(spark, d):
    return profile.pearson_skew(profile.column_profile(_DOC_NUMBERS.df(spark, d)), 0.3).withColumn("skew", F.round("skew", 4))


@query("describe", with_t(GAPPY, each(GAPPY_NUMBERS, """
SELECT '{c}' AS "column", count({c}) AS count, round(round(avg({c}), 10), 6) AS mean, round(stddev_samp({c}), 5) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM t""")))
def describe(spark, d):
    return profile.describe(GAPPY.df(spark, d)).withColumns({**{c: F.round(c, 6) for c in ("p25", "p50", "p75")}, "mean": F.round(F.round("mean", 10), 6), "std": F.round("std", 5)})


def _pairs(names):
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]


def _corr_sql(source, names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM t" for a, b in _pairs(names))


_CORR_NAMES = [*GAPPY_NUMBERS, "constant", "double_price"]
_CORR_VIEW = View("lineitem", (*GAPPY.exprs, "CAST(7 AS DOUBLE) AS constant", "l_extendedprice * 2 - l_quantity * 500 AS double_price"))
_RATED = """SELECT col_a, col_b, round_even(round(r, 10), 6) AS pearson_r,
  CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
  CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS direction"""


@query("corr_matrix", with_t(_CORR_VIEW, f"{_RATED} FROM ({_corr_sql('t', _CORR_NAMES)}) AS p WHERE r IS NOT NULL AND NOT isnan(r)"))
def corr_matrix(spark, d):
    return correlation.correlation_pairs(_CORR_VIEW.df(spark, d), _CORR_NAMES)


def _with_nan(df):
    """The same table with NaN where numbers are missing."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.fillna(float("nan"), doubles)


@query("corr_matrix_nan", ORACLES["corr_matrix"])
def corr_matrix_nan(spark, d):
    return correlation.correlation_pairs(_with_nan(_CORR_VIEW.df(spark, d)), _CORR_NAMES)


@query("col_profile_nan", ORACLES["col_profile_gaps"])
def col_profile_nan(spark, d):
    return profile.column_profile(_with_nan(GAPPY.df(spark, d)))


@query("corr_matrix_full", with_t("SELECT * FROM lineitem", f"{_RATED} FROM ({_corr_sql('t', LINE_NUMBERS)}) AS p"))
def corr_matrix_full(spark, d):
    return correlation.correlation_pairs(table(spark, d, "lineitem"))


@query("topk_corr", with_t(_CORR_VIEW, f"""{_RATED} FROM ({_corr_sql('t', _CORR_NAMES)}) AS p
WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, col_a, col_b LIMIT 4"""))
def topk_corr(spark, d):
    return correlation.correlation_pairs(_CORR_VIEW.df(spark, d), _CORR_NAMES, k=4)


@query("join_corr_bidir", with_t(_CORR_VIEW, f"""SELECT 'l_tax' AS x, 'l_quantity' AS y, round_even(round(corr(l_quantity, l_tax), 10), 6) AS pearson_r FROM t
UNION ALL SELECT 'l_extendedprice', 'double_price', round_even(round(corr(l_extendedprice, double_price), 10), 6) FROM t
UNION ALL SELECT 'double_price', 'l_extendedprice', round_even(round(corr(l_extendedprice, double_price), 10), 6) FROM t
UNION ALL SELECT 'l_tax', 'constant', NULL FROM (SELECT 1) AS one"""))
def join_corr_bidir(spark, d):
    pairs = correlation.correlation_pairs(_CORR_VIEW.df(spark, d), _CORR_NAMES)
    wanted = spark.sql("""SELECT * FROM VALUES ('l_tax', 'l_quantity'), ('l_extendedprice', 'double_price'),
      ('double_price', 'l_extendedprice'), ('l_tax', 'constant') AS w(x, y)""")
    return correlation.lookup_pair(pairs, wanted).select("x", "y", "pearson_r")


@query("heatmap_cells", with_t("SELECT * FROM lineitem",
    f"SELECT col_b AS row, col_a AS col, round(r, 6) AS r FROM ({_corr_sql('t', LINE_NUMBERS)}) AS p"))
def heatmap_cells(spark, d):
    return correlation.heatmap_cells(table(spark, d, "lineitem")).withColumn("r", F.round("r", 6))


@query("linear_fit", """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, count(*) AS n,
  min(l_quantity) AS x_min, max(l_quantity) AS x_max FROM lineitem""")
def linear_fit(spark, d):
    return correlation.linear_fit(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").withColumns(
        {"slope": F.round("slope", 4), "intercept": F.round("intercept", 3)})


_EVENT_GAPS = View("events", (
    "event_id", "ts", "user_id", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value",
    "CASE WHEN value > 60 THEN CAST(event_id AS DOUBLE) + value ELSE NULL END AS rising",
    "CASE WHEN value > 250 THEN value END AS rare",
))
_EVENT_NAMES = ["user_id", "value", "rising", "rare"]
_RHO = """SELECT '{c}' AS "column", count(*) AS n, CAST(corr(p, k) AS DOUBLE) AS rho FROM (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS p,
    rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS k FROM t WHERE {c} IS NOT NULL) AS z"""


@query("corr_spearman_trend", with_t(_EVENT_GAPS, f"""SELECT "column", n, round(rho, 6) AS rho,
  CASE WHEN n < 5 THEN NULL WHEN rho > 0.3 THEN 'increasing' WHEN rho < -0.3 THEN 'decreasing' ELSE 'flat' END AS trend
FROM {stacked(_EVENT_NAMES, _RHO)} WHERE n > 0"""))
def corr_spearman_trend(spark, d):
    return correlation.trend_labels(_EVENT_GAPS.df(spark, d), ["ts", "event_id"], _EVENT_NAMES).withColumn("rho", F.round("rho", 6))


@query("trend_halves", with_t(_EVENT_GAPS, f"""SELECT "column", n, round(a, 6) AS first_mean, round(b, 6) AS second_mean,
  CASE WHEN n < 5 THEN NULL WHEN abs(b - a) < 0.05 * (abs(a) + 1e-9) THEN 'flat' WHEN b > a THEN 'increasing' ELSE 'decreasing' END AS trend
FROM {stacked(_EVENT_NAMES, '''SELECT '{c}' AS "column", count(*) AS n, avg({c}) FILTER (WHERE p <= n_all // 2) AS a,
  avg({c}) FILTER (WHERE p > n_all // 2) AS b FROM (SELECT {c}, row_number() OVER (ORDER BY ts, event_id) AS p,
  count(*) OVER () AS n_all FROM t WHERE {c} IS NOT NULL) AS z''')} WHERE n > 0"""))
def trend_halves(spark, d):
    return correlation.trend_halves(_EVENT_GAPS.df(spark, d), ["ts", "event_id"], _EVENT_NAMES).withColumns(
        {c: F.round(c, 6) for c in ("first_mean", "second_mean")})


_EVENT_NUMBERS = ["event_id", "user_id", "value"]
_FENCES = """SELECT '{c}' AS "column", q1, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM t) AS q"""


def _outside(c: str) -> str:
    return (f"COALESCE({c} < (SELECT lower_fence FROM f WHERE \"column\" = '{c}') OR "
            f"{c} > (SELECT upper_fence FROM f WHERE \"column\" = '{c}'), false)")


def with_fences(source: str, names, body: str) -> str:
    return f"WITH t AS ({source}), f AS ({each(names, _FENCES)}) {body}"


@query("iqr_fences", with_fences("SELECT * FROM events", _EVENT_NUMBERS,
    'SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence FROM f'))
def iqr_fences(spark, d):
    return outliers.iqr_fences(table(spark, d, "events")).select(
        "column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")])


@query("iqr_anomalies", with_fences("SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events", _EVENT_NUMBERS, """
SELECT f."column", pos AS row_index, v AS value, round_even(lower_fence, 6) AS lower_fence, round_even(upper_fence, 6) AS upper_fence,
  count(*) OVER (PARTITION BY f."column") AS outlier_count FROM (""" + each(
    _EVENT_NUMBERS, "SELECT '{c}' AS \"column\", pos, CAST({c} AS DOUBLE) AS v FROM t") + """) AS u JOIN f ON u."column" = f."column" WHERE v < lower_fence OR v > upper_fence"""))
def iqr_anomalies(spark, d):
    events = table(spark, d, "events")
    return outliers.anomaly_rows(events, ["ts", "event_id"]).join(F.broadcast(outliers.iqr_anomalies(events)), "column")


@query("flag_outliers", with_fences("SELECT * FROM events", _EVENT_NUMBERS,
    f"SELECT event_id, value, ({' OR '.join(map(_outside, _EVENT_NUMBERS))}) AS _is_outlier FROM t"))
def flag_outliers(spark, d):
    return outliers.flag_outliers(table(spark, d, "events")).select("event_id", "value", "_is_outlier")


@query("flag_outliers_capped", with_fences("SELECT * FROM events", _EVENT_NUMBERS, f"""
SELECT event_id, value, event_id IN (SELECT event_id FROM t WHERE {_outside('value')} ORDER BY ts, event_id LIMIT 100) AS _is_outlier FROM t"""))
def flag_outliers_capped(spark, d):
    return outliers.flag_outliers(table(spark, d, "events"), cap=100, order_by=["ts", "event_id"]).select(
        "event_id", "value", "_is_outlier")


@query("outlier_ratio_pooled", with_fences("SELECT * FROM events", _EVENT_NUMBERS, f"""
SELECT count(*) * 3 AS values, CAST({' + '.join(f"count(*) FILTER (WHERE {_outside(c)})" for c in _EVENT_NUMBERS)} AS BIGINT) AS outliers,
  round(({' + '.join(f"count(*) FILTER (WHERE {_outside(c)})" for c in _EVENT_NUMBERS)}) / (count(*) * 3.0), 6) AS ratio FROM t"""))
def outlier_ratio_pooled(spark, d):
    return outliers.pooled_outlier_ratio(table(spark, d, "events")).withColumn("ratio", F.round("ratio", 6))


@query("zscore_ratio", with_t("SELECT * FROM events", each(_EVENT_NUMBERS, """
SELECT '{c}' AS "column", round(count(*) FILTER (WHERE abs({c} - m) > 3 * s) / CAST(count(*) AS DOUBLE), 6) AS ratio
FROM t, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM t) AS z""")))
def zscore_ratio(spark, d):
    return outliers.zscore_ratio(table(spark, d, "events"), _EVENT_NUMBERS).withColumn("ratio", F.round("ratio", 6))


@query("join_fences", with_fences("SELECT * FROM events", _EVENT_NUMBERS, """
SELECT event_id, 'value' AS "column", value, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence
FROM t, f WHERE f."column" = 'value' AND (value < lower_fence OR value > upper_fence)"""))
def join_fences(spark, d):
    events = table(spark, d, "events")
    fences = outliers.iqr_fences(events).select("column", "lower_fence", "upper_fence")
    return outliers.cells_outside_fences(events, "event_id", fences, ["user_id", "value"]).withColumns(
        {c: F.round(c, 6) for c in ("lower_fence", "upper_fence")})


@query("join_semi_outlier", with_fences("SELECT * FROM events", _EVENT_NUMBERS,
    f"SELECT event_id, event_type, ({_outside('value')}) AS _is_outlier FROM t"))
def join_semi_outlier(spark, d):
    events = table(spark, d, "events")
    fences = outliers.iqr_fences(events).select("column", "lower_fence", "upper_fence")
    ids = outliers.cells_outside_fences(events, "event_id", fences, ["value"]).select("event_id")
    return outliers.mark_by_ids(events.select("event_id", "event_type"), ids, "event_id")


@query("join_split_outlier", with_fences("SELECT * FROM events", _EVENT_NUMBERS, f"""
SELECT CASE WHEN {_outside('value')} THEN 'outlier' ELSE 'normal' END AS part, count(*) AS n, round(sum(value), 3) AS total FROM t GROUP BY 1"""))
def join_split_outlier(spark, d):
    events = table(spark, d, "events")
    fences = outliers.iqr_fences(events).select("column", "lower_fence", "upper_fence")
    ids = outliers.cells_outside_fences(events, "event_id", fences, ["value"]).select("event_id")
    normal, odd = outliers.split_by_ids(events, ids, "event_id")
    both = normal.withColumn("part", F.lit("normal")).unionByName(odd.withColumn("part", F.lit("outlier")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query("extreme_ratio_box", with_fences("SELECT * FROM events", _EVENT_NUMBERS, each(_EVENT_NUMBERS,
    "SELECT '{c}' AS \"column\", round(count(*) FILTER (WHERE {c} < lower_fence OR {c} > upper_fence) / CAST(count(*) AS DOUBLE), 6) AS extreme_ratio FROM t, f WHERE f.\"column\" = '{c}'")))
def extreme_ratio_box(spark, d):
    from sievemark.operators.charts import box_stats

    return box_stats(table(spark, d, "events"), _EVENT_NUMBERS).select("column", F.round("extreme_ratio", 6).alias("extreme_ratio"))


@query("drop_internal", """SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def drop_internal(spark, d):
    return outliers.drop_internal(outliers.flag_outliers(table(spark, d, "events")))
