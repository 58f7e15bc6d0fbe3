import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievemark.operators import quantiles
from sievemark.operators.quantiles import approx_quantiles, exact_quantiles, quantile_table

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def expected(values, p):
    return float(np.quantile(np.array(values, dtype=float), p))


@pytest.mark.parametrize("inside", [5, 50, 5000])
def test_selection_matches_sorting(spark, inside):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.sin("id") * 1000).alias("hot"),  # a third is one value
        F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 20_011).cast("double")).alias("gaps"),
        F.lit(4).alias("same"),
        F.lit(None).cast("double").alias("none"),
    )
    pdf = df.toPandas()
    found = exact_quantiles(df, df.columns, PROBS, inside=inside)
    for c in ("hot", "gaps", "same"):
        for p in PROBS:
            assert found[c, p] == pytest.approx(expected(pdf[c].dropna(), p), rel=1e-12, abs=1e-9), (c, p)
    assert found["none", 0.5] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=12, max_size=60))
def test_small_tables_by_selection(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], inside=4)
    for p in (0.25, 0.5, 0.75):
        assert found["x", p] == pytest.approx(expected(values, p), rel=1e-9, abs=1e-9)


def test_nan_is_missing_on_the_selection_path(spark):
    df = spark.range(6_000).select(
        F.when(F.col("id") % 4 == 0, F.lit(float("nan"))).otherwise(F.sin("id")).alias("x"),
        F.when(F.col("id") < 40, F.col("id") * 1.0).alias("sparse"), F.lit(3.0).alias("same"))
    pdf = df.toPandas()
    found = exact_quantiles(df, df.columns, PROBS, inside=20)
    for c in df.columns:
        for p in PROBS:
            assert found[c, p] == pytest.approx(expected(pdf[c].dropna(), p), rel=1e-12, abs=1e-12), (c, p)


def test_long_form_and_sketch(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    assert quantile_table(df, ["x"], [0.5]).first()["value"] == 500.5
    assert abs(approx_quantiles(df, ["x"], [0.5])["x", 0.5] - 500.5) <= 1
    assert exact_quantiles(df, [], [0.5]) == {}


def test_coarse_sketches_still_give_exact_answers(spark, monkeypatch):
    """Bounds far too wide for one round: sketches of the inside narrow them, wrong proposals are found out by the counts."""
    monkeypatch.setattr(quantiles, "_FINEST", 20)
    monkeypatch.setattr(quantiles, "_COARSEST", 20)
    df = spark.range(30_000).select(
        (F.sin("id") * 1000).alias("x"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 50 * 1.0).alias("ties"))
    pdf = df.toPandas()
    found = exact_quantiles(df, df.columns, PROBS, inside=10)
    for c in df.columns:
        for p in PROBS:
            assert found[c, p] == pytest.approx(expected(pdf[c], p), rel=1e-12, abs=1e-12), (c, p)


def test_one_scan_gives_counts_and_statistics(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("x"), F.lit(None).cast("double").alias("none"))
    v = F.col("value")
    found = quantiles.sketch(df, df.columns, [0.5], {"mean": F.avg(v), "rows": F.count(F.lit(1))})
    assert found.sizes == {"x": 750, "none": 0} and found.also["x"] == {"mean": 500.0, "rows": 1000}
    assert quantiles.quantiles_of(df, found, ["x", "none"]) == {("x", 0.5): 500.0, ("none", 0.5): None}
    assert quantiles.sketch(df.limit(0), ["x"], [0.5], {"mean": F.avg(v)}).also == {"x": {"mean": None}}


def test_wide_tables_take_as_many_scans(spark):
    wide = spark.range(300).select(*[((F.col("id") * (i + 3)) % 101).alias(f"c{i}") for i in range(160)])
    before = spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold")
    found, pdf = exact_quantiles(wide, wide.columns, [0.25, 0.5]), wide.toPandas()
    assert all(found[c, p] == pytest.approx(expected(pdf[c], p)) for c in wide.columns for p in (0.25, 0.5))
    assert spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold") == before
