import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievemark.operators import order
from sievemark.operators.features import with_batches


@pytest.fixture()
def rows(spark):
    # One key holds a third of the rows; the order is total through id.
    return spark.range(3_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.when(F.col("id") % 7 == 0, F.sin("id")).alias("v"), (F.col("id") * 7919 % 3001).alias("o"),
    )


@pytest.mark.parametrize("partitions", [1, 5, 200])
def test_row_ids_do_not_depend_on_partitions(rows, partitions):
    got = order.with_row_id(rows, ["k", "o"], partitions=partitions).toPandas().sort_values("_row_id")
    want = rows.toPandas().sort_values(["k", "o"])
    assert list(got["_row_id"]) == list(range(1, 3001))
    assert list(got["id"]) == list(want["id"])


def test_order_is_required(rows):
    with pytest.raises(ValueError):
        order.with_row_id(rows, [])


@pytest.mark.parametrize("bucket", [7, 40, 16_384])
def test_running_totals(rows, monkeypatch, bucket):
    monkeypatch.setattr(order, "BUCKET_ROWS", bucket)
    got = order.running_totals(order.with_row_id(rows, ["o"]), {"run": "k"}).toPandas().sort_values("_row_id")
    assert list(got["run"]) == list(rows.toPandas().sort_values("o")["k"].cumsum())


@pytest.mark.parametrize("bucket", [5, 16_384])
def test_forward_fill(rows, monkeypatch, bucket):
    monkeypatch.setattr(order, "BUCKET_ROWS", bucket)
    pdf = rows.toPandas().sort_values("o")
    got = order.forward_fill(rows, ["v"], ["o"]).toPandas().sort_values("o")
    pd.testing.assert_series_equal(got["v"].reset_index(drop=True), pdf["v"].ffill().reset_index(drop=True))
    keyed = order.forward_fill(rows, ["v"], ["o"], ["k"]).toPandas().sort_values("o")
    want = pdf.groupby("k")["v"].ffill()
    pd.testing.assert_series_equal(keyed["v"].reset_index(drop=True), want.reset_index(drop=True), check_names=False)


@pytest.mark.parametrize("bucket", [7, 16_384])
def test_starts_of_runs(spark, monkeypatch, bucket):
    """One file holds half of the rows, many hold one, some rows have none; batches are those of each file on its own."""
    monkeypatch.setattr(order, "BUCKET_ROWS", bucket)
    file = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("f"), (F.col("id") % 90).cast("string")))
    rows = spark.range(600).select("id", file.alias("file")).withColumn("extra", F.lit("own"))
    got = with_batches(rows.repartition(5), ["id"], "file", 40).toPandas()
    want = rows.toPandas().sort_values("id")
    want["batch_no"] = want.groupby("file", dropna=False).cumcount() // 40 + 1
    both = got.merge(want, on="id", suffixes=("", "_want"))
    assert len(got) == 600 and (both["batch_no"] == both["batch_no_want"]).all()
    few = with_batches(rows, ["id"], "file", 40, least=10).toPandas()
    sizes = want.groupby(["file", "batch_no"], dropna=False)["id"].transform("size")
    assert set(few["id"]) == set(want[sizes >= 10]["id"])
