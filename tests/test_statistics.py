import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievemark.operators import categorical, correlation, impute, order, outliers, profile, scores

SAMPLES = [[], [1.0], [1.0, 2.0], [1.0, 2.0, 4.0], [1.0, 1.0, 1.0, 5.0], [2.0] * 7, [1.0, 5.0, 2.0, 8.0, 3.0, 9.0, 4.0, 50.0]]


@pytest.mark.parametrize("values", SAMPLES)
def test_adjusted_moments_match_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    row = profile.shape_stats(df, ["x"]).first()
    for mine, theirs in ((row["skew_adj"], pd.Series(values, dtype=float).skew()), (row["kurt_adj"], pd.Series(values, dtype=float).kurtosis())):
        assert (mine is None and math.isnan(theirs)) or mine == pytest.approx(theirs)


def test_correlation_with_constants_and_gaps(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, None, 5, 9], "b": [2.0, None, 5, 1, 9, 1], "c": [3.0] * 6, "d": [None] * 5 + [1.0]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)], "a double, b double, c double, d double")
    got = {(r["col_a"], r["col_b"]): r["pearson_r"] for r in correlation.correlation_pairs(df).collect()}
    assert got == {("a", "b"): pytest.approx(pdf["a"].corr(pdf["b"]), abs=1e-6)}


def test_correlation_of_many_columns(spark, monkeypatch):
    """200 columns with gaps in some, in one block and in several; columns equal to another, constant, and empty."""
    random = np.random.default_rng(3)
    values = random.normal(size=(400, 200)) * 10.0 ** random.integers(-3, 6, 200) + random.integers(-5, 6, 200) * 1e3
    values[:, 7], values[:, 8] = values[:, 6] * -3 + 1, 0.1
    for c in range(0, 200, 3):
        values[random.random(400) < 0.3, c] = np.nan
    values[:, 9] = np.nan
    pdf = pd.DataFrame(values, columns=[f"c{i:03}" for i in range(200)])
    df = spark.createDataFrame(pdf).repartition(5)
    want = pdf.corr(min_periods=2)
    for block in (1024, 90):
        monkeypatch.setattr(correlation, "_BLOCK", block)
        got = {(r["row"], r["col"]): r["r"] for r in correlation.heatmap_cells(df).collect()}
        assert len(got) == 199 * 100
        for (b, a), r in got.items():
            assert (r is None) == (b in ("c008", "c009") or a in ("c008", "c009")) and (r is None or abs(r - want.loc[a, b]) < 1e-9)


def test_positions_leave_gaps_out(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 10)
    random = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": range(300), "full": random.integers(0, 20, 300) * 1.0, "gaps": np.where(random.random(300) < 0.4, np.nan, random.random(300)), "none": np.nan})
    df = spark.createDataFrame(pdf).repartition(7)
    placed, counts = correlation.column_positions(df, ["id"], ["full", "gaps", "none"])
    assert counts == {"full": 300, "gaps": int(pdf["gaps"].notna().sum())}
    got = placed.toPandas()
    for c in counts:
        mine = got[got["column"] == c].sort_values("pos")
        assert list(mine["pos"]) == list(range(1, counts[c] + 1)) and list(mine["value"]) == list(pdf[c].dropna())
    rho = {r["column"]: r["rho"] for r in correlation.spearman_with_order(df, ["id"], ["full", "gaps", "none"]).collect()}
    for c in counts:
        kept = pdf[c].dropna().reset_index(drop=True)
        assert rho[c] == pytest.approx(kept.rank().corr(pd.Series(range(len(kept))).astype(float)))


@pytest.mark.parametrize("n,step,trend", [(4, 1, None), (5, 1, "increasing"), (43, 1, "increasing"), (44, -1, "decreasing"), (50, 0, "flat")])
def test_trend_labels(spark, n, step, trend):
    df = spark.range(n).select("id", (F.col("id") * step).cast("double").alias("x"))
    for run in (correlation.trend_labels, correlation.trend_halves):
        assert run(df, ["id"], ["x"]).first()["trend"] == trend


def test_weak_trend_needs_significance(spark):
    values = [3, 1, 4, 2, 5, 3, 4, 6, 2, 5]  # rho about 0.53 over ten values: p is above 5 %
    df = spark.createDataFrame(list(enumerate(map(float, values))), "id int, x double")
    row = correlation.trend_labels(df, ["id"], ["x"]).first()
    assert row["rho"] == pytest.approx(pd.Series(values).rank().corr(pd.Series(range(10)).astype(float)))
    assert row["trend"] == "flat"


def test_fence_limits(spark):
    few = spark.createDataFrame([(1.0,), (2.0,), (300.0,)], "x double")
    assert outliers.fence_map(few)["x"] == (None, None)
    assert outliers.flag_outliers(few).filter("_is_outlier").count() == 0
    flat = spark.createDataFrame([(5.0,)] * 8 + [(6.0,)], "x double")
    assert outliers.outlier_counts(flat).first()["outliers"] == 0  # equal quartiles
    assert profile.column_profile(flat).first()["outlier_count"] == 1


def test_profile_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert profile.column_profile(empty).count() >= 0
    only_text = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    row = {r["column"]: r for r in profile.column_profile(only_text).collect()}
    assert row["a"]["missing_pct"] == 50.0 and row["a"]["mean"] is None and row["a"]["outlier_count"] == 0


def test_ties_go_to_the_smaller_value(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "a"), (9, "b"), (None, None)], "n int, t string")
    assert {r["column"]: r["mode"] for r in categorical.column_modes(df, ["n", "t"]).collect()} == {"n": "9", "t": "a"}


def test_fill_choice_limits():
    assert impute.choose_fill(7, 0.1) == "median"
    assert impute.choose_fill(8, 0.1) == "mean"
    assert impute.choose_fill(8, 0.5) == "median"
    assert impute.choose_fill(8, None) == "median"


def test_fill_of_an_empty_text_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "x double, t string")
    plan = {f.column: f for f in impute.fill_plan(df)}
    assert plan["t"].strategy == "unknown_fallback"
    assert {r["t"] for r in impute.apply_fills(df, list(plan.values())).collect()} == {"Unknown"}


def test_list_means(spark):
    one = spark.range(1)


@pytest.mark.parametrize("hours,factor,age", [(0, 1.0, "fresh"), (24 * 45, 0.85, "aging"), (24 * 90, 0.7, "stale"), (24 * 400, 0.7, "stale")])
def test_decay(spark, hours, factor, age):
    h = F.lit(float(hours))
    row = spark.range(1).select(scores.decay_factor(h).alias("f"), scores.model_age(h).alias("a")).first()
    assert row["f"] == pytest.approx(factor) and row["a"] == age
