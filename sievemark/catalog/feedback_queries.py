"""The feedback table and candidate ranking, on rows derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import View, query, table, with_t
from sievemark.operators import discovery, feedback

# Line items as feedback: the price stands for the score, the discount for the label.
_FEEDBACK = View("events", (
    "event_id AS id", "event_type || '-' || CAST(user_id AS STRING) AS dataset_hash", "CAST(value AS DOUBLE) AS predicted_score",
    "CAST(CASE WHEN user_id < 40 THEN 0 WHEN user_id < 80 THEN 1 WHEN user_id < 120 THEN 2 ELSE 3 END AS INT) AS actual_label",
    "CASE WHEN value < 10 THEN '[]' WHEN value < 20 THEN 'not json' WHEN value < 30 THEN '[1,2,3,4,5,6,7]' ELSE '[1,2,3,4,5,6,7,' || CAST(user_id AS STRING) || '.5]' END AS features",
    "ts AS timestamp"))
_GATE = """(actual_label >= 2 AND predicted_score < 50) OR (actual_label = 0 AND predicted_score > 70)"""
_GATED = with_t(_FEEDBACK, f""", g AS (SELECT *, CAST(({_GATE}) AS INT) AS is_quality_gated FROM t) """).replace(") ,", "),", 1)


def _gated(spark, d):
    return feedback.gate_table(_FEEDBACK.df(spark, d))


@query("feedback_gate", with_t(_FEEDBACK, f"""SELECT id, CAST(({_GATE}) AS INT) AS is_quality_gated, CASE WHEN actual_label = 1 THEN 'neutral'
  WHEN actual_label >= 2 AND predicted_score < 50 THEN 'underestimated' WHEN actual_label = 0 AND predicted_score > 70 THEN 'overestimated' ELSE 'aligned' END AS reason FROM t"""))
def feedback_gate(spark, d):
    return _gated(spark, d).select("id", "is_quality_gated", "reason")


@query("feedback_cap", _GATED + """SELECT id, dataset_hash FROM (SELECT id, dataset_hash, row_number() OVER (PARTITION BY dataset_hash ORDER BY timestamp, id) AS k FROM g WHERE is_quality_gated = 1) AS z WHERE k <= 3""")
def feedback_cap(spark, d):
    return feedback.feedback_cap(_gated(spark, d)).select("id", "dataset_hash")


@query("group_feedback", _GATED + "SELECT dataset_hash, count(*) AS count FROM g WHERE is_quality_gated = 1 GROUP BY 1")
def group_feedback(spark, d):
    return feedback.feedback_per_dataset(_gated(spark, d))


@query("join_hash_count", _GATED + """SELECT id, coalesce(c, 0) AS existing FROM g LEFT JOIN (SELECT dataset_hash, count(*) AS c FROM g WHERE is_quality_gated = 1 GROUP BY 1) AS k USING (dataset_hash)""")
def join_hash_count(spark, d):
    rows = _gated(spark, d)
    return feedback.with_dataset_count(rows.select("id", "dataset_hash"), rows).select("id", "existing")


@query("feedback_append", _GATED + "SELECT count(*) AS rows, count(DISTINCT id) AS ids FROM g WHERE is_quality_gated = 1")
def feedback_append(spark, d):
    from sievemark.session import scratch_path

    path, rows = scratch_path(spark, "feedback"), _gated(spark, d).filter("is_quality_gated = 1")
    feedback.feedback_append(rows.filter("actual_label = 0"), path)
    feedback.feedback_append(rows.filter("actual_label > 0"), path)
    return spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


@query("feedback_train", with_t(_FEEDBACK, """SELECT id, CAST(split_part(rtrim(features, ']'), ',', 8) AS DOUBLE) AS last_feature, CAST(actual_label >= 2 AS INT) AS label FROM t WHERE predicted_score >= 30 ORDER BY id DESC LIMIT 500"""))
def feedback_train(spark, d):
    return feedback.feedback_train(_FEEDBACK.df(spark, d), 500).select("id", F.element_at("feature_values", 8).alias("last_feature"), "label")


@query("feedback_trim", with_t(_FEEDBACK, "SELECT id, dataset_hash FROM t ORDER BY id DESC LIMIT 500"))
def feedback_trim(spark, d):
    return feedback.feedback_trim(_FEEDBACK.df(spark, d)).select("id", "dataset_hash")


@query("feedback_count", with_t(_FEEDBACK, "SELECT count(*) AS count, min(id) AS first_id, max(id) AS last_id FROM t"))
def feedback_count(spark, d):
    return _FEEDBACK.df(spark, d).agg(F.count(F.lit(1)).alias("count"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("feedback_health", with_t(_FEEDBACK, """SELECT n AS total_feedbacks, v AS valid_with_features, n - v AS invalid_features, round_even(round(v * 100.0 / n, 10), 1) AS health_percentage,
  CASE WHEN v * 100.0 / n > 90 THEN 'healthy' WHEN v * 100.0 / n > 70 THEN 'degraded' ELSE 'poor' END AS status FROM (SELECT count(*) AS n, count(*) FILTER (WHERE predicted_score >= 30) AS v FROM t) AS z"""))
def feedback_health(spark, d):
    return feedback.feedback_health(_FEEDBACK.df(spark, d))


@query("retrain_due", with_t(_FEEDBACK, """SELECT id, feedback_count, feedback_count % 20 = 0 AS retrain, 20 - feedback_count % 20 AS next_retrain_in FROM (SELECT id, row_number() OVER (ORDER BY id) AS feedback_count FROM t) AS z"""))
def retrain_due(spark, d):
    return feedback.retrain_points(_FEEDBACK.df(spark, d).select("id"))


_LOG = View("orders", ("CAST(o_orderkey + 1000000 AS STRING) AS timestamp", "o_totalprice / 500000 AS cv_score"))


@query("history_stats", with_t(_LOG, """, o AS (SELECT *, row_number() OVER (ORDER BY timestamp DESC) AS k, count(*) OVER () AS n FROM t)
SELECT any_value(n) AS runs, round(max(cv_score) FILTER (WHERE k = 1), 8) AS latest_score, max(timestamp) AS latest_at,
  round((max(cv_score) FILTER (WHERE k = 1) - max(cv_score) FILTER (WHERE k = n)) / max(cv_score) FILTER (WHERE k = n) * 100, 6) AS improvement_pct,
  round(max(cv_score) FILTER (WHERE k = 2), 8) AS previous_score,
  round((max(cv_score) FILTER (WHERE k = 1) - max(cv_score) FILTER (WHERE k = 2)) / max(cv_score) FILTER (WHERE k = 2) * 100, 6) AS step_pct FROM o""").replace(") ,", "),", 1))
def history_stats(spark, d):
    return feedback.history_stats(_LOG.df(spark, d)).withColumns({
        **{c: F.round(c, 8) for c in ("latest_score", "previous_score")}, **{c: F.round(c, 6) for c in ("improvement_pct", "step_pct")}})


_NORM = r"regexp_extract(rtrim(lower(url), '/'), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1) || regexp_extract(rtrim(lower(url), '/'), '^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)', 2)"


@query("url_slug", rf"""SELECT page_id, trim(substr(regexp_replace(lower(title), '[^\p{{L}}\p{{N}}_]', '_', 'g'), 1, 40), '_') || '_' || substr(md5({_NORM}), 1, 8) AS slug
FROM (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) AS p""")
def url_slug(spark, d):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, d, "pages").select("page_id", discovery.url_slug(F.col("url"), title).alias("slug"))


# Pages as candidates: the page number decides format and size, the text is the description.
_CAND = View("pages", (
    "page_id AS seq", "regexp_replace(url, '[?#].*$', '') || CASE WHEN length(html) > 9000 THEN '.csv' WHEN length(html) > 7000 THEN '.zip' WHEN length(html) > 6000 THEN '.txt' ELSE '' END AS url",
    "CASE WHEN url LIKE '%/fr/%' THEN 'fr' WHEN url LIKE '%/en%' THEN 'en' ELSE 'other' END AS domain",
    "CASE WHEN length(html) > 9000 THEN 'CSV' WHEN length(html) > 7000 THEN 'zip' WHEN length(html) > 5000 THEN 'json' WHEN length(html) > 4000 THEN 'html_table' ELSE 'unknown' END AS file_format",
    "CAST(floor(CAST(length(html) AS BIGINT) * length(html) / 200.0) AS BIGINT) - 30000 AS estimated_rows", "html AS description"))
_POINTS = """(CASE lower(file_format) WHEN 'csv' THEN 40 WHEN 'zip' THEN 20 WHEN 'json' THEN 20 WHEN 'html_table' THEN 10 ELSE 0 END
 + CASE WHEN estimated_rows > 100000 THEN 30 WHEN estimated_rows > 10000 THEN 20 WHEN estimated_rows > 1000 THEN 10 WHEN estimated_rows > 0 THEN 5 ELSE 0 END
 + CASE WHEN ends_with(lower(url), '.csv') OR ends_with(lower(url), '.csv.gz') OR ends_with(lower(url), '.zip') THEN 15 ELSE 0 END
 + CASE WHEN length(description) > 100 THEN 5 ELSE 0 END)"""


@query("candidate_score", with_t(_CAND, f"SELECT seq, CAST({_POINTS} AS DOUBLE) AS score FROM t"))
def candidate_score(spark, d):
    return discovery.scored(_CAND.df(spark, d)).select("seq", "score")


@query("est_rows", "SELECT page_id, CAST(floor(length(html) / 200.0) AS BIGINT) AS estimated_rows FROM pages")
def est_rows(spark, d):
    return table(spark, d, "pages").select("page_id", discovery.est_rows(F.char_length("html")).alias("estimated_rows"))


@query("candidate_rank", with_t(_CAND, f""", every AS (SELECT * FROM t UNION ALL SELECT seq + 1000000, url, domain, file_format, estimated_rows + 100000, description FROM t WHERE length(description) > 6000),
u AS (SELECT *, row_number() OVER (PARTITION BY domain, url ORDER BY seq) AS first FROM every),
r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {_POINTS} DESC, seq) AS rank FROM u WHERE first = 1)
SELECT domain, seq, CAST({_POINTS} AS DOUBLE) AS score, rank FROM r WHERE rank <= 20""").replace(") ,", "),", 1))
def candidate_rank(spark, d):
    first = _CAND.df(spark, d)
    second = first.filter("length(description) > 6000").withColumns({"seq": F.col("seq") + 1000000, "estimated_rows": F.col("estimated_rows") + 100000})
    return discovery.candidate_rank([first, second], 20).select("domain", "seq", "score", "rank")


@query("reject_ext", with_t(_CAND, "SELECT seq, url FROM t WHERE NOT ends_with(lower(rtrim(url, '/')), '.txt')"))
def reject_ext(spark, d):
    return discovery.reject_ext(_CAND.df(spark, d)).select("seq", "url")


@query("session_totals", with_t(_CAND, "SELECT count(*) FILTER (WHERE file_format <> 'unknown') AS saved, CAST(sum(estimated_rows) FILTER (WHERE file_format <> 'unknown') AS BIGINT) AS rows, count(*) FILTER (WHERE file_format = 'unknown') AS errors FROM t"))
def session_totals(spark, d):
    got = _CAND.df(spark, d).select("seq", F.col("estimated_rows").alias("rows"), F.when(F.col("file_format") != "unknown", "ok").otherwise("failed").alias("status"))
    return discovery.session_totals(got)


def _slugged(spark, d):
    return _CAND.df(spark, d).select(F.substring(F.md5("url"), 1, 8).alias("slug"), "seq", "estimated_rows", "file_format")


_SLUG = "SELECT substr(md5(url), 1, 8) AS slug, seq, estimated_rows, file_format FROM t"


@query("join_anti_manifest", with_t(_CAND, f"SELECT slug, seq FROM ({_SLUG}) AS a WHERE slug NOT IN (SELECT slug FROM ({_SLUG}) AS b WHERE file_format = 'CSV')"))
def join_anti_manifest(spark, d):
    rows = _slugged(spark, d)
    return discovery.not_in_manifest(rows, rows.filter("file_format = 'CSV'")).select("slug", "seq")


@query("manifest_upsert", with_t(_CAND, f"""SELECT slug, seq, estimated_rows FROM ({_SLUG}) AS a WHERE file_format = 'unknown' AND slug NOT IN (SELECT slug FROM ({_SLUG}) AS b WHERE estimated_rows > 20000)
UNION ALL SELECT slug, seq, estimated_rows * 2 FROM ({_SLUG}) AS c WHERE estimated_rows > 20000
UNION ALL SELECT slug, seq, estimated_rows FROM ({_SLUG}) AS e WHERE file_format = 'zip' AND slug NOT IN (SELECT slug FROM ({_SLUG}) AS b WHERE estimated_rows > 20000)"""))
def manifest_upsert(spark, d):
    rows = _slugged(spark, d)
    old = rows.filter("file_format IN ('unknown', 'zip')").drop("file_format")
    new = rows.filter("estimated_rows > 20000").withColumn("estimated_rows", F.col("estimated_rows") * 2).drop("file_format")
    return discovery.manifest_upsert(old, new)
