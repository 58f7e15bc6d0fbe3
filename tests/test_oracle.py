"""Every query with a SQL equivalent gives the same rows as that SQL."""

import os

import pytest

import oracle
from sievemark.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TRAINING = {
    "train_rf", "train_gbt", "train_logreg", "learning_curve", "logreg_sweep", "kfold_metrics", "retrain", "batch_score",
}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    got = oracle.spark_rows(QUERIES[name](spark, FOLDER))
    assert oracle.difference(got, oracle.duck_rows(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - TRAINING))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
