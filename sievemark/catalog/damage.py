"""Corruption and resampling, checked cell by cell through the portable hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import query, table
from sievemark.catalog.modelling import sql_u
from sievemark.operators import corrupt

_DICE = corrupt.Dice(("o_orderkey",), algorithm="md5")


def _u(tag: str) -> str:
    return sql_u(tag, "o_orderkey")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("inject_nulls", f"""SELECT o_orderkey, {', '.join(f"CASE WHEN {_u('null:' + c)} >= 0.15 THEN {c} END AS {c}" for c in ('o_custkey', 'o_totalprice', 'o_orderpriority'))} FROM orders""")
def inject_nulls(spark, d):
    return corrupt.inject_nulls(_orders(spark, d), _DICE, 0.15)


@query("inject_duplicates", f"""SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE {_u('duplicate')} < 0.2""")
def inject_duplicates(spark, d):
    return corrupt.inject_duplicates(_orders(spark, d), _DICE, 0.2).select("o_orderkey", "o_custkey")


def _times(mean: float) -> str:
    return " + ".join(f"CASE WHEN {_u('draws')} >= {step!r} THEN 1 ELSE 0 END" for step in corrupt.poisson_steps(mean))


def _normal(tag: str, *key: str) -> str:
    return f"sqrt(-2 * ln(1 - {sql_u('n1:' + tag, *key)})) * cos(2 * pi() * {sql_u('n2:' + tag, *key)})"


@query("inject_duplicates_replaced", f"""SELECT o_orderkey, o_custkey, unnest(range(1 + {_times(0.2)})) AS copy FROM orders""")
def inject_duplicates_replaced(spark, d):
    """Every row with the number of each of its copies."""
    rows = corrupt.inject_duplicates_replaced(_orders(spark, d), _DICE, 0.2).groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("k"))
    return rows.select("o_orderkey", "o_custkey", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("copy"))


@query("scramble_type", """SELECT 'numeric' AS before, count(*) AS rows, count(o_custkey) AS present FROM orders""")
def scramble_type(spark, d):
    mixed = corrupt.scramble_types(_orders(spark, d), _DICE, ["o_custkey", "o_totalprice"], share=1.0)
    return mixed.agg(F.lit("numeric").alias("before"), F.count(F.lit(1)).alias("rows"), F.count(F.col("o_custkey").try_cast("bigint")).alias("present"))


def _flip(tag: str) -> float:
    return _DICE.flip(tag)


_SIGN = {c: 1.0 if _flip(f"sign:{c}") > 0.5 else -1.0 for c in ("o_custkey", "o_totalprice")}


@query("inject_outliers_median", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {_u('outlier:' + c)} < 0.05 THEN (SELECT quantile_cont({c}, 0.5) FROM orders) * 10.0 * {s} ELSE CAST({c} AS DOUBLE) END AS {c}" for c, s in _SIGN.items()) + " FROM orders")
def inject_outliers_median(spark, d):
    return corrupt.inject_outliers_median(_orders(spark, d), _DICE, 0.05, 10.0).drop("o_orderpriority")


@query("inject_outliers_max", f"""SELECT o_orderkey, round(CASE WHEN {_u('outlier:o_totalprice')} < 0.1 THEN (2 + 3 * {_u('size:o_totalprice')}) * (SELECT max(o_totalprice) FROM orders) ELSE o_totalprice END, 4) AS o_totalprice FROM orders""")
def inject_outliers_max(spark, d):
    return corrupt.inject_outliers_max(_orders(spark, d), _DICE, 0.1, ["o_totalprice"]).select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


@query("inject_outliers_const", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {_u('outlier:' + c)} < 0.12 THEN CASE WHEN {_u('side:' + c)} < 0.5 THEN 999999.0 ELSE -999999.0 END ELSE CAST({c} AS DOUBLE) END AS {c}" for c in ("o_custkey", "o_totalprice")) + " FROM orders")
def inject_outliers_const(spark, d):
    return corrupt.inject_outliers_const(_orders(spark, d), _DICE).drop("o_orderpriority")


_TOKENS = "[" + ", ".join(f"'{t}'" for t in corrupt.BAD_TOKENS) + "]"


@query("inject_text", f"""SELECT o_orderkey, CASE WHEN {_u('text:o_custkey')} < 0.05 THEN list_extract({_TOKENS}, CAST(floor({_u('token:o_custkey')} * 6) AS INT) + 1) ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey FROM orders""")
def inject_text(spark, d):
    return corrupt.inject_text(_orders(spark, d), _DICE, 0.05, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("inject_noise", f"""SELECT o_orderkey, round(CASE WHEN {_u('noise:o_totalprice')} < 0.2 THEN o_totalprice + sqrt(-2 * ln(1 - {_u('n1:o_totalprice')})) * cos(2 * pi() * {_u('n2:o_totalprice')})
  * (SELECT stddev_samp(o_totalprice) FROM orders) ELSE o_totalprice END, 3) AS o_totalprice FROM orders""")
def inject_noise(spark, d):
    return corrupt.inject_noise(_orders(spark, d), _DICE, 0.2, ["o_totalprice"]).select("o_orderkey", F.round("o_totalprice", 3).alias("o_totalprice"))


@query("inject_suffix", f"""SELECT o_orderkey, CASE WHEN {_u('suffix:o_custkey')} < 0.04 THEN o_custkey || 'X' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
  CASE WHEN {_u('code:o_orderpriority')} < 0.06 THEN 'XXX' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def inject_suffix(spark, d):
    spoiled = corrupt.inject_code(corrupt.inject_suffix(_orders(spark, d), _DICE, "o_custkey"), _DICE, "o_orderpriority")
    return spoiled.select("o_orderkey", "o_custkey", "o_orderpriority")


@query("drop_rows", f"SELECT o_orderkey FROM orders WHERE {_u('drop')} >= 0.1")
def drop_rows(spark, d):
    return corrupt.drop_rows(_orders(spark, d), _DICE, 0.1).select("o_orderkey")


@query("scramble_names", """SELECT count(*) AS rows, true AS same_names_ignoring_case FROM orders""")
def scramble_names(spark, d):
    orders = _orders(spark, d)
    loud = corrupt.scramble_names(orders, _DICE)
    same = [c.lower().replace(" ", "_") for c in loud.columns] == orders.columns
    return loud.agg(F.count(F.lit(1)).alias("rows"), F.lit(same).alias("same_names_ignoring_case"))


@query("corrupt_combined", f"""WITH n AS (SELECT o_orderkey, {', '.join(f"CASE WHEN {_u('null:' + c)} >= 0.15 THEN {c} END AS {c}" for c in ('o_custkey', 'o_totalprice'))} FROM orders)
SELECT * FROM n UNION ALL SELECT * FROM n WHERE {_u('duplicate')} < 0.1""")
def corrupt_combined(spark, d):
    return corrupt.corrupt_combined(_orders(spark, d), _DICE).drop("o_orderpriority")


_CELLS = ("o_custkey", "o_totalprice", "o_orderpriority")
_MIX = corrupt.CorruptionProfile(apply_probability=1.0, type_probability=1.0)


def _between(tag: str, span: tuple[float, float]) -> float:
    return span[0] + _flip(tag) * (span[1] - span[0])


def _mix_sql() -> str:
    """Nulls, copies, numbers as text, outliers, one after the other, as the profile applies all of them."""
    nulls = ", ".join(f"CASE WHEN {_u('null:' + c)} >= {_between('rate:nulls', _MIX.null_rate)!r} THEN {c} END AS {c}" for c in _CELLS)
    text = [c for c in _CELLS[:2] if _flip(f"scramble:{c}") < 0.5]
    rate, size = _between("rate:outliers", _MIX.outlier_rate), _between("size:outliers", _MIX.outlier_multiplier)
    cells = [
        f"CAST({c} AS VARCHAR) AS {c}" if c in text
        else f"CASE WHEN {_u('outlier:' + c)} < {rate!r} THEN (SELECT quantile_cont({c}, 0.5) FROM m) * {size * _SIGN[c]!r} ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in _CELLS[:2]
    ]
    return f"""WITH n AS (SELECT o_orderkey, {nulls} FROM orders),
m AS (SELECT * FROM n UNION ALL SELECT * FROM n WHERE {_u('duplicate')} < {_between('rate:duplicates', _MIX.duplicate_fraction)!r})
SELECT o_orderkey, {', '.join(cells)}, o_orderpriority FROM m"""


@query("corrupt_mix", _mix_sql())
def corrupt_mix(spark, d):
    """All kinds of damage with their own rates, cell by cell."""
    return corrupt.corrupt_mix(_orders(spark, d), _DICE, _MIX)


@query("corrupt_level", f"""WITH n AS (SELECT o_orderkey, {', '.join(f"CASE WHEN {_u('null:' + c)} >= 0.15 THEN {c} END AS {c}" for c in _CELLS)} FROM orders),
m AS (SELECT o_orderkey, o_custkey, o_orderpriority, round(CASE WHEN {_u('noise:o_totalprice')} < 0.1 THEN o_totalprice + {_normal('o_totalprice', 'o_orderkey')}
  * (SELECT stddev_samp(o_totalprice) FROM n) ELSE o_totalprice END, 3) AS o_totalprice FROM n)
SELECT * FROM m UNION ALL SELECT * FROM m WHERE {_u('duplicate')} < 0.1""")
def corrupt_level(spark, d):
    return corrupt.corrupt_level(_orders(spark, d), _DICE, 0.5, ["o_totalprice"]).withColumn("o_totalprice", F.round("o_totalprice", 3))


@query("bootstrap", f"""WITH c AS (SELECT *, unnest(range(1, 1 + {_times(1.0)})) AS copy FROM orders)
SELECT o_orderkey, o_orderpriority, {', '.join(f"round({c} + {_normal('blur:' + c, 'o_orderkey', 'copy')} * 0.05 * (SELECT stddev_samp({c}) FROM orders), 3) AS {c}" for c in _CELLS[:2])} FROM c""")
def bootstrap(spark, d):
    """Every drawn row with its own noise."""
    drawn = corrupt.bootstrap(_orders(spark, d), _DICE)
    return drawn.withColumns({c: F.round(c, 3) for c in _CELLS[:2]})


@query("interpolate", f"""WITH a AS (SELECT *, {_u('left')} AS u, row_number() OVER (ORDER BY {_u('left')}, o_orderkey) AS k FROM orders),
b AS (SELECT *, row_number() OVER (ORDER BY {_u('right')}, o_orderkey) AS k FROM orders)
SELECT a.o_orderkey, round(a.u * a.o_totalprice + (1 - a.u) * b.o_totalprice, 4) AS o_totalprice,
  CASE WHEN a.u < 0.5 THEN a.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority FROM a JOIN b ON a.k = b.k""")
def interpolate(spark, d):
    mixed = corrupt.interpolate(_orders(spark, d).drop("o_custkey"), _DICE)
    return mixed.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"), "o_orderpriority")
