"""Scores, rule checks, insights and model-facing flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import COPIED, GAPPY, GAPPY_NUMBERS, GAPPY_TEXT, View, each, query, stacked, table, with_t
from sievemark.catalog.statistics import _outside, with_fences
from sievemark.operators import checks, features, scores
from sievemark.operators.categorical import dominant_categories
from sievemark.operators.correlation import correlation_pairs
from sievemark.operators.insights import key_insights
from sievemark.operators.outliers import iqr_anomalies
from sievemark.operators.profile import column_profile
from sievemark.session import materialize, small_frame

_ALL = GAPPY_NUMBERS + GAPPY_TEXT
_CELLS = " + ".join(f"count({c})" for c in _ALL)


@query("score_completeness", with_t(GAPPY, f"""SELECT round(({_CELLS}) / (8.0 * count(*)), 6) AS raw,
  round(least(({_CELLS}) / (8.0 * count(*)), 0.99), 6) AS completeness FROM t"""))
def score_completeness(spark, d):
    return scores.score_completeness(GAPPY.df(spark, d)).select(F.round("raw", 6).alias("raw"), F.round("completeness", 6).alias("completeness"))


_UNIQUE = "(SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u) / CAST((SELECT count(*) FROM t) AS DOUBLE)"


@query("score_uniqueness", with_t(COPIED, f"SELECT round({_UNIQUE}, 6) AS raw, round(least({_UNIQUE}, 0.99), 6) AS uniqueness"))
def score_uniqueness(spark, d):
    return scores.score_uniqueness(COPIED.df(spark, d)).select(F.round("raw", 6).alias("raw"), F.round("uniqueness", 6).alias("uniqueness"))


_EVENT_NUMBERS = ["event_id", "user_id", "value"]
_OUT = " + ".join(f"count(*) FILTER (WHERE {_outside(c)})" for c in _EVENT_NUMBERS)


@query("score_outlier", with_fences("SELECT * FROM events", _EVENT_NUMBERS,
    f"SELECT round(1 - ({_OUT}) / (3.0 * count(*)), 6) AS raw, round(least(1 - ({_OUT}) / (3.0 * count(*)), 0.99), 6) AS outlier_score FROM t"))
def score_outlier(spark, d):
    return scores.score_outliers(table(spark, d, "events")).select(F.round("raw", 6).alias("raw"), F.round("outlier_score", 6).alias("outlier_score"))


_GAP_OUT = " + ".join(f"count(*) FILTER (WHERE {_outside(c)})" for c in GAPPY_NUMBERS)
_GAP_N = " + ".join(f"count({c})" for c in GAPPY_NUMBERS)


@query("score_confidence", with_fences(COPIED.sql(), GAPPY_NUMBERS, f"""SELECT round(completeness, 6) AS completeness, consistency, accuracy,
  round(duplicates, 6) AS duplicates, round(outliers, 6) AS outliers,
  round_even(least(0.25 * completeness + 0.25 * consistency + 0.20 * accuracy + 0.15 * duplicates + 0.15 * outliers, 0.99), 2) AS confidence
FROM (SELECT least(({_CELLS}) / (8.0 * count(*)), 0.99) AS completeness, CAST(0.99 AS DOUBLE) AS consistency, CAST(0.99 AS DOUBLE) AS accuracy,
  least({_UNIQUE}, 0.99) AS duplicates, least(1 - ({_GAP_OUT}) / CAST({_GAP_N} AS DOUBLE), 0.99) AS outliers FROM t) AS s"""))
def score_confidence(spark, d):
    return scores.score_confidence(COPIED.df(spark, d)).withColumns({c: F.round(c, 6) for c in ("completeness", "duplicates", "outliers")})


_BLANKS = View("part", ("p_partkey", "CASE WHEN p_size > 45 THEN '  ' WHEN p_size > 40 THEN NULL ELSE p_name END AS p_name",
                        "CASE WHEN p_size < 20 THEN '' ELSE p_brand END AS p_brand", "p_type", "CASE WHEN p_size = 7 THEN NULL ELSE p_retailprice END AS price"))
_LABEL = """CASE WHEN percentage >= 95 THEN 'Excellent' WHEN percentage >= 90 THEN 'Very Good' WHEN percentage >= 80 THEN 'Good'
  WHEN percentage >= 70 THEN 'Fair' ELSE 'Poor' END AS label"""


@query("view_column_quality", with_t(_BLANKS, f"""SELECT "column", complete, total, round(percentage, 6) AS percentage, {_LABEL} FROM (
  SELECT *, complete * 100.0 / total AS percentage FROM {stacked(_BLANKS.names(), '''SELECT '{c}' AS "column",
  count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '') AS complete, count(*) AS total FROM t''')}) AS q"""))
def view_column_quality(spark, d):
    return scores.column_quality(_BLANKS.df(spark, d)).withColumn("percentage", F.round("percentage", 6))


_V = """SELECT '{c}' AS "column", NULLIF(trim(CAST({c} AS VARCHAR)), '') AS s FROM t"""
_VIEW_TABLE = with_t(_BLANKS, f"""
, v AS ({each(_BLANKS.names(), _V)}), n AS (SELECT *, TRY_CAST(NULLIF(regexp_extract(s, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?', 0), '') AS DOUBLE) AS x FROM v),
m AS (SELECT "column", avg(x) AS mean, stddev_pop(x) AS sd FROM n GROUP BY 1),
p AS (SELECT n."column", count(*) AS rows, count(s) AS filled, count(DISTINCT lower(s)) AS uniq, count(x) AS numbers,
  count(*) FILTER (WHERE abs(x - mean) > 3 * sd) AS far FROM n JOIN m USING ("column") GROUP BY 1),
q AS (SELECT *, numbers / CAST(filled AS DOUBLE) > 0.8 AS is_num, far / CAST(NULLIF(numbers, 0) AS DOUBLE) AS o, uniq / CAST(filled AS DOUBLE) AS card FROM p),
z AS (SELECT count(*) AS columns, count(*) FILTER (WHERE filled = rows) AS complete_columns,
  avg(greatest(filled * 100.0 / rows - CASE WHEN is_num THEN 50 * o ELSE 0 END
    - CASE WHEN NOT is_num AND card > 0.5 THEN least((card - 0.5) * 20, 8) ELSE 0 END, 70)) AS base,
  avg(1 - filled / CAST(rows AS DOUBLE)) AS miss, avg(o) FILTER (WHERE is_num) AS o, avg(card) FILTER (WHERE NOT is_num) AS card FROM q),
r AS (SELECT columns, complete_columns, base * greatest(1 - miss * 30, 0.92) * greatest(1 - o * 50, 0.97)
  * CASE WHEN card > 0.4 THEN greatest(1 - (card - 0.4) * 15, 0.93) ELSE 1 END * 0.98 AS raw FROM z)
SELECT columns, complete_columns, round(raw, 6) AS raw_quality, round(least(greatest(raw, 87), 96), 6) AS quality FROM r""").replace(") \n,", "),", 1)


@query("view_table_quality", _VIEW_TABLE)
def view_table_quality(spark, d):
    return scores.table_quality(_BLANKS.df(spark, d)).withColumns({c: F.round(c, 6) for c in ("raw_quality", "quality")})


_FEATURE_SQL = """SELECT event_type, missing_ratio, skewness FROM (SELECT event_type, count(*) AS n,
  (count(*) FILTER (WHERE value < 5)) / CAST(count(*) AS DOUBLE) AS missing_ratio, abs(skewness(value)) AS skewness FROM events GROUP BY 1) AS s"""


def _event_features(spark, d):
    events = table(spark, d, "events").select("event_type", "user_id", "value")
    return features.features8(events, ["event_type"])


_F8_EVENTS = """WITH g AS (SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS du, count(DISTINCT value) AS dv,
  count(DISTINCT (user_id, value)) AS pairs, avg(user_id) AS mu, stddev_samp(user_id) AS su, avg(value) AS mv, stddev_samp(value) AS sv,
  skewness(user_id) AS ku, skewness(value) AS kv, kurtosis(user_id) AS tu, kurtosis(value) AS tv FROM events GROUP BY 1),
f AS (SELECT event_type, 0.0 AS missing_ratio, 1 - pairs / CAST(n AS DOUBLE) AS duplicate_ratio, 1.0 AS numeric_ratio, 0.0 AS constant_cols,
  (abs(su / mu) + abs(sv / mv)) / 2 AS norm_variance, (abs(ku) + abs(kv)) / 2 AS skewness, least((du + dv) / 2.0 / n, 1.0) AS cardinality_ratio,
  least((abs(tu) + abs(tv)) / 2 / 10, 1.0) AS mean_kurtosis FROM g)"""
_EIGHT = list(scores.FEATURE_TARGETS)


@query("feature_radar", _F8_EVENTS + f""" SELECT event_type, feature, round(value, 6) AS value, round(least(greatest(CASE
  WHEN feature IN ('missing_ratio', 'duplicate_ratio', 'constant_cols') THEN 1 - value / greatest(target, 0.01)
  WHEN feature = 'numeric_ratio' THEN 1 - abs(value - target) / greatest(target, 0.01) ELSE 1 - value / greatest(target * 1.5, 0.01) END, 0), 1), 6) AS radar
FROM ({" UNION ALL ".join(f"SELECT event_type, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, CAST({t} AS DOUBLE) AS target FROM f" for f, t in scores.FEATURE_TARGETS.items())}) AS u""")
def feature_radar(spark, d):
    return scores.feature_radar(_event_features(spark, d), ["event_type"]).withColumns({"value": F.round("value", 6), "radar": F.round("radar", 6)})


@query("feature_flags", _F8_EVENTS + f""" SELECT event_type, feature, round(value, 6) AS value, target AS threshold, CASE WHEN CASE
  WHEN feature IN ('missing_ratio', 'duplicate_ratio') THEN value <= target WHEN feature = 'numeric_ratio' THEN abs(value - target) < 0.2
  WHEN feature = 'constant_cols' THEN value = 0 ELSE value < target * 1.5 END THEN 'PASS' ELSE 'FLAG' END AS status
FROM ({" UNION ALL ".join(f"SELECT event_type, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, CAST({t} AS DOUBLE) AS target FROM f" for f, t in scores.FEATURE_TARGETS.items())}) AS u""")
def feature_flags(spark, d):
    return scores.feature_flags(_event_features(spark, d), ["event_type"]).withColumn("value", F.round("value", 6))


_HOURS = "epoch(TIMESTAMP '1999-01-01 00:00:00') - epoch(o_orderdate)"


def _order_hours(spark, d):
    later = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, d, "orders").select("o_orderkey", scores.hours_between(F.col("o_orderdate"), later).alias("hours"))


@query("score_decay", f"""SELECT o_orderkey, round(f, 6) AS decay, round_even(round(80 * f, 10), 2) AS effective FROM (
  SELECT o_orderkey, CASE WHEN days <= 0 THEN 1.0 ELSE greatest(0.70, 1.0 - days / 90.0 * 0.30) END AS f
  FROM (SELECT o_orderkey, ({_HOURS}) / 86400.0 AS days FROM orders) AS a) AS b""")
def score_decay(spark, d):
    from sievemark.functions.stats import stable_round

    f = scores.decay_factor(F.col("hours"))
    return _order_hours(spark, d).select("o_orderkey", F.round(f, 6).alias("decay"), stable_round(80 * f, 2).alias("effective"))


@query("model_age", f"""SELECT age, count(*) AS n, round(min(left_hours), 3) AS min_left FROM (SELECT CASE WHEN h / 24 < 7 THEN 'fresh' WHEN h / 24 < 30 THEN 'good'
  WHEN h / 24 < 90 THEN 'aging' ELSE 'stale' END AS age, greatest(0.0, 720 - h) AS left_hours FROM (SELECT ({_HOURS}) / 3600.0 AS h FROM orders) AS a) AS b GROUP BY 1""")
def model_age(spark, d):
    h = F.col("hours")
    return _order_hours(spark, d).select(scores.model_age(h).alias("age"), scores.hours_to_retrain(h).alias("left")).groupBy("age").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min("left"), 3).alias("min_left"))


@query("rating_band", """SELECT CASE WHEN s >= 85 THEN 'EXCELLENT' WHEN s >= 60 THEN 'GOOD' WHEN s >= 30 THEN 'FAIR' ELSE 'POOR' END AS rating, count(*) AS n
FROM (SELECT floor(l_quantity * 2) AS s FROM lineitem) AS a GROUP BY 1""")
def rating_band(spark, d):
    score = F.floor(F.col("l_quantity") * 2)
    return table(spark, d, "lineitem").groupBy(scores.rating_band(score).alias("rating")).agg(F.count(F.lit(1)).alias("n"))


_CHECKED = View("lineitem", (
    "l_quantity - 3 AS num_items", "l_quantity * 3 AS fill_pct", "l_discount * 100 AS tax_rate",
    "CASE WHEN l_discount = 0.0 THEN NULL ELSE l_extendedprice END AS price", "l_returnflag", "CAST(NULL AS STRING) AS nothing"))
_SANITY = with_t(_CHECKED, """, z AS (SELECT count(*) AS rows, count(*) - 5 AS reported, count(*) FILTER (WHERE num_items < 0) AS neg,
  count(*) FILTER (WHERE fill_pct < 0 OR fill_pct > 100) AS p1, count(*) FILTER (WHERE tax_rate < 0 OR tax_rate > 100) AS p2,
  (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t) AS u) AS dup FROM t)
SELECT check_id, category, passed, severity, CASE WHEN passed THEN '' ELSE detail END AS detail FROM (
SELECT 'row_count_match' AS check_id, 'accuracy' AS category, true AS passed, 'error' AS severity, '' AS detail FROM z
UNION ALL SELECT 'col_count_match', 'accuracy', false, 'warning', 'analysis=7, actual=6' FROM z
UNION ALL SELECT 'no_all_na_rows', 'completeness', true, 'error', '' FROM z
UNION ALL SELECT 'no_all_na_cols', 'completeness', false, 'error', 'nothing' FROM z
UNION ALL SELECT 'no_duplicates', 'duplicates', dup = 0, 'warning', dup || ' duplicate rows' FROM z
UNION ALL SELECT 'non_negative_num_items', 'accuracy', neg = 0, 'error', neg || ' negatives' FROM z
UNION ALL SELECT 'pct_range_fill_pct', 'accuracy', p1 = 0, 'warning', p1 || ' out-of-range values' FROM z
UNION ALL SELECT 'pct_range_tax_rate', 'accuracy', p2 = 0, 'warning', p2 || ' out-of-range values' FROM z
UNION ALL SELECT 'min_row_count', 'accuracy', rows >= 3, 'error', '' FROM z
UNION ALL SELECT 'min_col_count', 'accuracy', true, 'error', '' FROM z) AS c""").replace(") ,", "),", 1)


def _sanity(spark, d):
    frame = _CHECKED.df(spark, d)
    return checks.checks_sanity(frame, frame.count(), 7)


@query("checks_sanity", _SANITY)
def checks_sanity(spark, d):
    return _sanity(spark, d)


def _reported(spark, d):
    """The orders' own profile with one mean, one std and one column name made wrong."""
    profile = column_profile(table(spark, d, "orders")).filter("mean IS NOT NULL")
    wrong = F.col("column") == "o_custkey"
    own = profile.select("column", F.when(wrong, F.col("mean") * 1.01).otherwise(F.col("mean")).alias("mean"),
                         F.when(wrong, F.col("std") * 1.0005).otherwise(F.col("std")).alias("std"), "min",
                         F.when(wrong, F.col("max") + 10).otherwise(F.col("max")).alias("max"))
    return own.unionByName(small_frame(spark, [("o_gone", 1.0, 1.0, 0.0, 2.0)], "column string, mean double, std double, min double, max double"))


@query("checks_consistency", """SELECT check_id, 'consistency' AS category, passed, severity FROM (
""" + each(["o_orderkey", "o_custkey", "o_totalprice"], """SELECT 'mean_match_{c}' AS check_id, '{c}' <> 'o_custkey' AS passed, 'warning' AS severity
UNION ALL SELECT 'std_match_{c}', true, 'info' UNION ALL SELECT 'min_match_{c}', true, 'info'
UNION ALL SELECT 'max_match_{c}', '{c}' <> 'o_custkey' OR (SELECT 10 <= 1e-3 * (max(o_custkey) + 10) FROM orders), 'info'""") + """
UNION ALL SELECT 'col_exists_o_gone', false, 'error') AS c""")
def checks_consistency(spark, d):
    return checks.checks_consistency(table(spark, d, "orders"), _reported(spark, d)).drop("detail")


@query("join_reported_actual", """SELECT c."column", c."column" <> 'o_gone' AS known, round(actual_mean, 4) AS actual_mean, round(actual_std, 4) AS actual_std FROM (
""" + each(["o_orderkey", "o_custkey", "o_totalprice"], """SELECT '{c}' AS "column", avg({c}) AS actual_mean, stddev_samp({c}) AS actual_std FROM orders""") + """
UNION ALL SELECT 'o_gone', NULL, NULL) AS c""")
def join_reported_actual(spark, d):
    both = checks.reported_against_actual(table(spark, d, "orders"), _reported(spark, d))
    return both.select("column", "known", F.round("actual_mean", 4).alias("actual_mean"), F.round("actual_std", 4).alias("actual_std"))


_SIGN = View("lineitem", ("l_quantity", "l_extendedprice", "l_quantity * 2 AS twice", "0 - l_quantity AS minus"))


@query("corr_sign_check", with_t(_SIGN, """SELECT 'corr_direction_' || a || '_' || b AS check_id, 'consistency' AS category,
  (r >= 0) = (rep >= 0) AS passed, 'warning' AS severity FROM (
SELECT 'l_quantity' AS a, 'twice' AS b, corr(l_quantity, twice) AS r, corr(l_quantity, twice) AS rep FROM t
UNION ALL SELECT 'l_quantity', 'minus', corr(l_quantity, minus), 0.5 FROM t
UNION ALL SELECT 'twice', 'minus', corr(twice, minus), corr(twice, minus) FROM t) AS z"""))
def corr_sign_check(spark, d):
    actual = correlation_pairs(_SIGN.df(spark, d), ["l_quantity", "twice", "minus"])
    flipped = (F.col("col_a") == "l_quantity") & (F.col("col_b") == "minus")
    reported = actual.withColumn("pearson_r", F.when(flipped, F.lit(0.5)).otherwise(F.col("pearson_r")))
    return checks.checks_correlation_sign(actual, reported).drop("detail")


_OUT3 = ["value", "user_id", "event_id"]


@query("outlier_check", with_fences("SELECT * FROM events", _OUT3, f""", z AS (SELECT count(*) AS n, {', '.join(f"count(*) FILTER (WHERE {_outside(c)}) AS o{i}" for i, c in enumerate(_OUT3))} FROM t),
p AS (SELECT *, (o0 + o1 + o2) * 100.0 / (3 * n) AS pct FROM z)
SELECT 'outliers_evaluation' AS check_id, 'outliers' AS category, pct < 5 AS passed,
  CASE WHEN pct < 3 THEN 'info' WHEN pct < 7 THEN 'warning' ELSE 'error' END AS severity,
  'pooled=' || (o0 + o1 + o2) || '/' || (3 * n) || CASE WHEN o0 > 0 THEN ' value=' || o0 || '/' || n ELSE '' END
  || CASE WHEN o1 > 0 THEN ' user_id=' || o1 || '/' || n ELSE '' END || CASE WHEN o2 > 0 THEN ' event_id=' || o2 || '/' || n ELSE '' END AS detail FROM p""").replace(") ,", "),"))
def outlier_check(spark, d):
    return checks.checks_outliers(table(spark, d, "events").select(*_OUT3))


@query("checks_charts", """SELECT 'chart_count_nonzero' AS check_id, 'visualization' AS category, true AS passed, 'error' AS severity, '' AS detail
UNION ALL SELECT 'chart_has_data_' || event_type, 'visualization', count(*) FILTER (WHERE value > 500) > 0, 'error',
  CASE WHEN count(*) FILTER (WHERE value > 500) > 0 THEN '' ELSE 'no rows' END FROM events GROUP BY event_type""")
def checks_charts(spark, d):
    sizes = table(spark, d, "events").groupBy(F.col("event_type").alias("chart_id")).agg(F.count_if(F.col("value") > 500).alias("rows"))
    return checks.checks_charts(sizes)


@query("check_ml", """SELECT 'ml_quality_assessment' AS check_id, 'ml_assessment' AS category, q AND s > 70 AS passed,
  CASE WHEN q AND s > 75 THEN 'info' ELSE 'warning' END AS severity, count(*) AS n
FROM (SELECT p >= 0.5 AS q, round(greatest(p, 1 - p) * 100, 1) AS s FROM (SELECT l_quantity / 50.0 AS p FROM lineitem) AS a) AS b GROUP BY 3, 4""")
def check_ml(spark, d):
    p = F.col("l_quantity") / 50.0
    scored = table(spark, d, "lineitem").select(
        F.when(p >= 0.5, "GOOD").otherwise("BAD").alias("quality"), F.round(F.greatest(p, 1 - p) * 100, 1).alias("score"),
        p.alias("probability_good"), (1 - p).alias("probability_bad"))
    return checks.check_ml(scored).groupBy("check_id", "category", "passed", "severity").agg(F.count(F.lit(1)).alias("n"))


_W = "CASE severity WHEN 'error' THEN 1.0 WHEN 'warning' THEN 0.7 ELSE 0.15 END"
_DIMS = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in checks.DIMENSION_WEIGHTS.items()) + ") AS w(dimension, weight)"
_DIM_SQL = f"""SELECT w.dimension, round_even(round(CASE WHEN count(k.check_id) = 0 THEN 0.75 ELSE
  greatest(0.0, least(1 - coalesce(sum({_W}) FILTER (WHERE NOT passed), 0) / sum({_W}), 0.85)) END, 10), 4) AS score, CAST(any_value(weight) AS DOUBLE) AS weight,
  count(k.check_id) FILTER (WHERE passed) AS checks_passed, count(k.check_id) AS checks_total FROM {_DIMS} LEFT JOIN k ON k.category = w.dimension GROUP BY 1"""


@query("dimension_score", f"WITH k AS ({_SANITY}) {_DIM_SQL}")
def dimension_score(spark, d):
    return checks.dimension_scores(_sanity(spark, d)).withColumn("score", F.bround(F.round("score", 10), 4))


@query("overall_confidence", f"WITH k AS ({_SANITY}), dims AS ({_DIM_SQL}) SELECT round_even(round(least(sum(score * weight) / sum(weight), 0.80), 10), 4) AS confidence FROM dims")
def overall_confidence(spark, d):
    return checks.overall_confidence(checks.dimension_scores(_sanity(spark, d)))


@query("status", f"""WITH k AS ({_SANITY}), dims AS ({_DIM_SQL}), c AS (SELECT round_even(round(least(sum(score * weight) / sum(weight), 0.80), 10), 4) AS confidence FROM dims),
b AS (SELECT count(*) FILTER (WHERE NOT passed AND severity = 'error') AS blocking_errors FROM k)
SELECT confidence, blocking_errors, CASE WHEN blocking_errors > 0 OR confidence < 0.5 THEN 'REJECTED' WHEN confidence < 0.7 THEN 'APPROVED_WITH_WARNINGS' ELSE 'APPROVED' END AS status FROM c, b""")
def status(spark, d):
    return checks.validation_status(_sanity(spark, d))


@query("messages", f"""WITH k AS ({_SANITY}) SELECT severity, count(*) AS n, string_agg(check_id || ': ' || detail, ' | ' ORDER BY check_id) AS details FROM k WHERE NOT passed GROUP BY 1""")
def messages(spark, d):
    return checks.messages(_sanity(spark, d)).withColumn("details", F.array_join("details", " | "))


@query("issues_by_category", f"""WITH k AS ({_SANITY}) SELECT category, count(*) AS failed, string_agg(check_id, ', ' ORDER BY check_id) AS check_ids FROM k WHERE NOT passed GROUP BY 1""")
def issues_by_category(spark, d):
    return checks.issues_by_category(_sanity(spark, d))


_SAID = View("events", ("event_id", "ts", "value", "value * 2 + user_id / 1000.0 AS linked",
                        "CASE WHEN value < 40 THEN NULL ELSE user_id END AS sparse", "event_type"))
_SAID_NUMBERS = ["event_id", "value", "linked", "sparse"]
_SAID_SQL = with_fences(_SAID.sql(), _SAID_NUMBERS, """, p AS (""" + each(_SAID_NUMBERS, """SELECT '{c}' AS c, avg({c}) AS m, stddev_samp({c}) AS s, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS md,
  count(*) AS n, count(*) - count({c}) AS gone FROM t""") + """)
SELECT 'missing' AS kind, c AS "column", NULL AS other, round(gone * 100.0 / n, 2) AS value FROM p WHERE gone * 100.0 / n > 20
UNION ALL SELECT 'skew', c, NULL, round((m - md) / s, 4) FROM p WHERE s > 0 AND abs((m - md) / s) > 0.5
UNION ALL SELECT 'correlation', a, b, round(r, 4) FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM t" for i, a in enumerate(_SAID_NUMBERS) for b in _SAID_NUMBERS[i + 1:]) + """) AS r WHERE abs(r) >= 0.7
UNION ALL SELECT * FROM (""" + each(_SAID_NUMBERS, "SELECT 'outliers' AS kind, '{c}' AS c, NULL AS other, CAST(count(*) AS DOUBLE) AS value FROM t WHERE "
    "{c} < (SELECT lower_fence FROM f WHERE \"column\" = '{c}') OR {c} > (SELECT upper_fence FROM f WHERE \"column\" = '{c}')") + """) AS o WHERE value > 0
UNION ALL SELECT 'dominance', 'event_type', event_type, round(n * 100.0 / total, 1) FROM (SELECT event_type, count(*) AS n, sum(count(*)) OVER () AS total FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) AS e
  WHERE n * 100.0 / total > 20""")


@query("key_insights", _SAID_SQL)
def key_insights_q(spark, d):
    """The trend has a query of its own, so the profile goes without."""
    events = _SAID.df(spark, d)
    small = [materialize(f) for f in (column_profile(events), correlation_pairs(events), iqr_anomalies(events))]
    found = key_insights(*small, dominant_categories(events, ["event_type"], share=20.0, imbalance=1e9))
    return found.withColumn("value", F.round("value", 4))
