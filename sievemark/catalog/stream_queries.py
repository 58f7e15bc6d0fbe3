"""Structured Streaming forms, run over everything available."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import GAPPY, query, table, with_t
from sievemark.operators.impute import fill_plan
from sievemark.session import scratch_path
from sievemark.streaming import streams


def _stream(spark, d, name):
    return streams.table_stream(spark, d, name, table(spark, d, name).schema)


@query("stream_clean", with_t(GAPPY, """SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM t)), 6) AS l_quantity,
  coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM t)) AS l_tax FROM t"""))
def stream_clean(spark, d):
    plan = fill_plan(GAPPY.df(spark, d), "median")
    arriving = _stream(spark, d, "lineitem").selectExpr(*GAPPY.exprs)
    return streams.drain(streams.stream_clean(arriving, plan), "clean").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


@query("stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) AS z GROUP BY 1, 2")
def stream_dedup(spark, d):
    """The lateness covers the whole table, so a pair is seen once."""
    kept = streams.stream_dedup(_stream(spark, d, "events"), ["user_id", "event_type"], "ts", "3650 days")
    return streams.drain(kept.select("user_id", "event_type"), "dedup").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


_WINDOW = """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS rows, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max
FROM (SELECT *, {start} AS window_start FROM events{spread}) AS z GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""


def _profile(spark, d, slide=None):
    windows = streams.stream_profile(_stream(spark, d, "events"), "ts", "value", "1 hour", slide, by=["event_type"])
    found = streams.drain(windows, "windows")
    return found.select("window_start", "window_end", "event_type", "rows", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query("stream_profile", _WINDOW.format(start="date_trunc('hour', ts)", spread=""))
def stream_profile(spark, d):
    return _profile(spark, d)


@query("stream_profile_sliding", _WINDOW.format(start="time_bucket(INTERVAL 30 MINUTE, ts) - back", spread=", (VALUES (INTERVAL 0 MINUTE), (INTERVAL 30 MINUTE)) AS b(back)"))
def stream_profile_sliding(spark, d):
    return _profile(spark, d, "30 minutes")


_PASSED = "(user_id >= 80 AND value < 50) OR (user_id < 40 AND value > 70)"


def _feedback(spark, d):
    arriving = _stream(spark, d, "events").selectExpr(
        "event_id AS id", "value AS predicted_score", "CAST(CASE WHEN user_id < 40 THEN 0 WHEN user_id < 80 THEN 1 ELSE 2 END AS INT) AS actual_label")
    out, calls = scratch_path(spark, "accepted"), []
    for _ in range(2):  # the second run finds nothing new and asks for nothing again
        streams.stream_feedback(arriving, out, f"{out}-state", every=20, on_due=lambda stored: calls.append(stored.count()))
    return out, calls


@query("stream_feedback", f"""SELECT event_id AS id, CAST(CASE WHEN user_id < 40 THEN 0 WHEN user_id < 80 THEN 1 ELSE 2 END AS INT) AS actual_label, count(*) OVER () // 20 > 0 AS callback_ran FROM events
WHERE {_PASSED}""")
def stream_feedback(spark, d):
    """A retrain is due after every twentieth accepted row."""
    out, calls = _feedback(spark, d)
    return spark.read.parquet(out).select("id", "actual_label", F.lit(bool(calls)).alias("callback_ran"))


@query("stream_feedback_triggers", f"""SELECT n // 20 * 20 AS due, n AS rows, CAST(0 AS BIGINT) AS batch, n AS rows_seen, true AS once
FROM (SELECT count(*) AS n FROM events WHERE {_PASSED}) AS c WHERE n >= 20""")
def stream_feedback_triggers(spark, d):
    """Every retrain asked for, with the rows its call has seen."""
    out, calls = _feedback(spark, d)
    return streams.triggers_of(spark, out).withColumns({
        "rows_seen": F.lit(calls[0] if calls else None).cast("bigint"), "once": F.lit(len(calls) == 1)})
