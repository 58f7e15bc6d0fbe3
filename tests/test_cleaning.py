import pytest
from pyspark.sql import functions as F

from sievemark.functions import casts, columns, hashing
from sievemark.operators import dedup, impute, infer, rows
from sievemark.plans.assess import analyse, validate
from sievemark.plans.clean import CleaningProfile, clean_table


def test_names():
    assert columns.snake_names(["A b", "a-b", " a_b ", "1st", "Été", "??"]) == ["a_b", "a_b_2", "a_b_3", "1st", "t", "column"]
    assert columns.simple_names(["A b", "a-b"]) == ["a_b", "a_b_2"]


@pytest.mark.parametrize("text,number", [("1d", None), ("2f", None), ("0x10", None), (" 12 ", 12.0), ("1e3", 1000.0), ("", None), (".5", 0.5), ("5.", 5.0), ("-3", -3.0), ("1,2", None)])
def test_numbers(spark, text, number):
    assert spark.range(1).select(casts.to_number(F.lit(text))).first()[0] == number


@pytest.mark.parametrize("good,kind", [(69, "categorical"), (70, "categorical"), (71, "float")])
def test_inference_threshold(spark, good, kind):
    df = spark.range(100).select(F.when(F.col("id") < good, F.col("id").cast("string")).otherwise("x").alias("c"))
    assert infer.inferred_type_table(df).first()["logical_type"] == kind


@pytest.mark.parametrize("good,kind", [(20, "string"), (21, "double")])
def test_cleaning_threshold(spark, good, kind):
    df = spark.range(100).select(F.when(F.col("id") < good, "5").otherwise("x").alias("c"), F.when(F.col("id") < 1, "5").otherwise("x").alias("width"))
    assert dict(infer.coerce_numeric(df).dtypes) == {"c": kind, "width": "double"}  # "id" is part of width


def test_hints_keep_text_that_would_be_lost(spark):
    df = spark.createDataFrame([("a", "yes", None)] * 10, "n string, b string, e string")
    assert dict(infer.apply_hints(df, {"n": "integer", "b": "boolean", "e": "float"}).dtypes) == {"n": "string", "b": "boolean", "e": "double"}


def test_missing_values_are_one_notion(spark):
    df = spark.createDataFrame([(float("nan"), "NA"), (float("inf"), "x"), (1.0, "")], "x double, t string")
    assert casts.nan_to_null(df).filter("x IS NULL").count() == 1
    assert casts.inf_to_null(df).filter("x IS NULL").count() == 1
    assert casts.na_tokens_to_null(df).filter("t IS NULL").count() == 2


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, None), (3, 3)], "a int, b int")
    for count in (dedup.duplicate_counts, dedup.duplicate_counts_hashed):
        assert count(df).first().asDict() == {"rows": 5, "distinct_rows": 3, "duplicates": 2, "duplicate_ratio": 0.4}
    assert dedup.duplicate_counts_hashed(df, broadcast_limit=0).first()["duplicates"] == 2
    assert dedup.dedup_rows(df).count() == 3


def test_outlier_removal_modes(spark):
    df = spark.createDataFrame([(float(v), float(v % 3)) for v in range(40)] + [(1000.0, 1.0), (None, 2.0)], "x double, y double")
    assert impute.remove_outliers(df).count() == 41
    assert impute.remove_outliers(df, keep_nulls=False).count() == 40
    assert impute.remove_outliers(df, sequential=True, keep_nulls=False).count() == 40


def test_clean_table(spark):
    df = spark.createDataFrame(
        [("1", 1.0, "a", None), ("2", None, None, None), ("2", None, None, None), (None, None, None, None), ("x", 9.0, "a", None)],
        "`User Age` string, `Pay` double, flag string, gone string",
    )
    got = clean_table(df)
    m = got.metrics.first().asDict()
    assert (m["rows_input"], m["rows_output"], m["columns_output"]) == (5, 3, 3)
    assert (m["empty_rows_removed"], m["empty_columns_removed"], m["duplicates_removed"], m["missing_values_filled"]) == (1, 1, 1, 3)
    assert dict(got.table.dtypes) == {"user_age": "double", "pay": "double", "flag": "string"}
    assert got.table.filter("user_age IS NULL OR pay IS NULL OR flag IS NULL").count() == 0
    assert {r["column"]: r["strategy"] for r in got.fill_log().collect()} == {"user_age": "median", "pay": "median", "flag": "mode"}


def test_clean_profile_switches(spark):
    df = spark.createDataFrame([(float(v), "k") for v in range(20)] + [(5000.0, "k"), (None, "k")], "v double, k string")
    kept = clean_table(df, CleaningProfile(fill_missing_strategy="median", handle_outliers=True, drop_duplicates=False))
    assert kept.metrics.first()["outliers_removed"] == 1
    filled = clean_table(df.withColumn("o", F.monotonically_increasing_id()), CleaningProfile(fill_missing_strategy="ffill"), ["o"])
    assert filled.table.filter("v IS NULL").count() == 0


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "a int, b string")
    mark = lambda f: hashing.data_fingerprint(f).first()["data_hash"]
    assert mark(df) == mark(df.orderBy(F.desc("a")))
    assert mark(df) != mark(df.dropDuplicates())
    assert hashing.config_fingerprint(CleaningProfile()) == hashing.config_fingerprint(CleaningProfile())
    assert hashing.config_fingerprint(CleaningProfile(handle_outliers=True)) != hashing.config_fingerprint(CleaningProfile())


def test_search_ignores_case_and_nulls(spark):
    df = spark.createDataFrame([("Red Car", 1), (None, 12), ("blue", 3)], "t string, n int")
    assert rows.filter_search(df, "CAR").count() == 1
    assert rows.filter_search(df, "1").count() == 2
    assert rows.filter_search(df, " ").count() == 3


def test_assessment(spark):
    df = spark.range(400).select(
        "id", (F.col("id") * 2 + F.sin("id")).alias("rising"), (F.col("id") % 7).cast("double").alias("cycle"),
        F.when(F.col("id") % 4 == 0, "rare").otherwise("common").alias("kind"))
    analysis = analyse(df, ["id"])
    checks, status = validate(df, analysis, 400, 4)
    assert checks.filter("NOT passed").count() == 0
    assert status.first()["status"] == "APPROVED"
    assert any(r["kind"] == "correlation" and r["value"] > 0.7 for r in analysis.insights.collect())
    assert {r["chart_type"] for r in analysis.charts.collect()} >= {"histogram", "line", "scatter", "heatmap", "box", "pie", "bar"}
    broken, verdict = validate(df, analysis, 399, 4)
    assert verdict.first()["status"] == "REJECTED"
