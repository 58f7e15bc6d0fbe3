import pytest
from pyspark.sql import functions as F

from sievemark.operators import corrupt, feedback, metrics, model, splits
from sievemark.operators.features import FEATURES8, FEATURES17, features8, features17, with_batches
from sievemark.plans.retrain import current_model, on_feedback, retrain, score_stored
from sievemark.sources.readers import read_log
from sievemark.streaming import streams


@pytest.fixture(scope="module")
def samples(spark):
    return spark.range(200).select(
        F.col("id").cast("string").alias("sample_id"), (F.col("id") % 2).cast("int").alias("label"),
        (F.sin("id") + (F.col("id") % 2) * 3).alias("a"), F.when(F.col("id") % 9 != 0, F.cos("id")).alias("b"),
    ).persist()


def test_scores_are_probabilities(samples):
    fitted = model.train(samples, ["a", "b"], "forest", numTrees=5, maxDepth=4)
    got = model.score(fitted, samples, ["label"]).toPandas()
    assert ((got["probability_good"] + got["probability_bad"] - 1).abs() < 1e-3).all()
    assert ((got["quality"] == "GOOD") == (got["label"] == 1)).mean() > 0.95
    assert set(model.quality_report(model.score(fitted, samples)).toPandas()["rating"]) <= {"POOR", "FAIR", "GOOD", "EXCELLENT"}
    top = model.feature_importance(fitted, ["a", "b"]).toPandas()
    assert top["feature"][0] == "a" and top["cumulative"].iloc[-1] == pytest.approx(1)


@pytest.mark.parametrize("kind,extra", [("boosted", {"maxIter": 3}), ("logistic", {}), ("single", {})])
def test_other_classifiers(samples, kind, extra):
    found = model.evaluate(model.train(samples, ["a", "b"], kind, **extra), samples)
    assert found["accuracy"] > 0.9 and found["auc_roc"] > 0.9


def test_splits_are_exact_and_stable(samples):
    got = splits.split_ratio(samples, ["sample_id"]).groupBy("split").count().toPandas().set_index("split")["count"]
    assert dict(got) == {"train": 140, "val": 30, "test": 30}
    folds = splits.kfold_stratified(samples.repartition(3), "label", ["sample_id"])
    again = splits.kfold_stratified(samples.repartition(7), "label", ["sample_id"])
    assert folds.exceptAll(again).count() == 0
    assert set(folds.groupBy("fold", "label").count().toPandas()["count"]) == {20}
    assert splits.balance_classes(samples.filter("label = 1 OR a < 0"), "label", ["sample_id"]).groupBy("label").count().select("count").distinct().count() == 1


def test_auc_against_pairs(samples):
    pdf = samples.select("label", "a").toPandas()
    pos, neg = pdf.loc[pdf.label == 1, "a"].to_numpy(), pdf.loc[pdf.label == 0, "a"].to_numpy()
    pairs = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.auc(samples, "label", "a").first()["auc_roc"] == pytest.approx(pairs)


@pytest.mark.parametrize("better,promoted,reason", [((0.1, 0.1, 0.0), True, "improved"), ((0.1, 0.1, -0.05), False, "degraded"), ((0.1, 0.0, 0.0), False, "insufficient")])
def test_promotion(spark, better, promoted, reason):
    current = {"f1": 0.8, "balanced_accuracy": 0.8, "auc_roc": 0.8}
    candidate = {k: v + d for (k, v), d in zip(current.items(), better)}
    row = metrics.promotion(current, candidate, spark).first()
    assert (row["promoted"], row["reason"]) == (promoted, reason)


def test_retrain_loop(spark, samples, tmp_path):
    stored = spark.createDataFrame([(i, [float(i % 2) * 3, 0.0], i % 2) for i in range(10)], "id int, feature_values array<double>, label int")
    done = retrain(samples, stored, samples, ["a", "b"], None, str(tmp_path / "model"), str(tmp_path / "log"), folds=2, kind="single")
    entry = read_log(spark, str(tmp_path / "log")).first()
    assert done.promoted and entry["action"] == "promoted" and entry["total_training_samples"] == 210
    assert score_stored(samples, str(tmp_path / "model"), ["sample_id"]).count() == 200
    assert current_model(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(ValueError):
        retrain(samples.limit(3), stored.limit(0), samples, ["a", "b"], None, str(tmp_path / "m2"), str(tmp_path / "l2"))


def test_stream_retrains_when_a_multiple_is_passed(spark, samples, tmp_path):
    vector = F.to_json(F.array(*[F.lit(0.5)] * 8))
    rows = spark.range(48).select(
        "id", F.concat(F.lit("h"), F.col("id").cast("string")).alias("dataset_hash"), F.lit(20.0).alias("predicted_score"),
        F.when(F.col("id") % 2 == 0, 2).otherwise(1).alias("actual_label"), vector.alias("features"), F.col("id").cast("int").alias("timestamp"))
    for i in range(3):
        rows.filter(f"id >= {16 * i} AND id < {16 * i + 16}").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    names = list("abcdefgh")
    base = samples.select("sample_id", "label", *[(F.col("a") + i).alias(c) for i, c in enumerate(names)])
    seen = []
    act = on_feedback(base, base, names, str(tmp_path / "models"), str(tmp_path / "log"), folds=2, kind="single")

    def due(stored):
        seen.append(stored.count())
        act(stored)

    streams.stream_feedback(stream, str(tmp_path / "store"), str(tmp_path / "state"), every=20, on_due=due)
    assert seen == [24]  # 8, 16 and 24 accepted rows
    assert read_log(spark, str(tmp_path / "log")).first()["feedback_samples"] == 24
    assert current_model(spark, str(tmp_path / "models")) is not None


def test_a_failed_retrain_stays_due(spark, tmp_path):
    """A call that fails in the middle of a batch is made again by the next run, once; a store that grew goes on from there."""
    def stream(names):
        for i in names:
            spark.range(15 * i, 15 * i + 15).select(
                "id", F.concat(F.lit("h"), F.col("id").cast("string")).alias("dataset_hash"), F.lit(20.0).alias("predicted_score"),
                F.lit(2).alias("actual_label"), F.lit("[]").alias("features"), F.col("id").cast("int").alias("timestamp"),
            ).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"in/{i}"))
        schema = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in")).schema
        return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    seen, broken = [], [True]

    def due(stored):
        seen.append(stored.count())
        if broken.pop() if broken else False:
            raise RuntimeError("no more room")

    run = lambda names: streams.stream_feedback(stream(names), str(tmp_path / "store"), str(tmp_path / "state"), every=20, on_due=due)
    with pytest.raises(Exception, match="no more room"):
        run([0, 1])
    assert seen == [30] and streams.triggers_of(spark, str(tmp_path / "store")).count() == 0
    run([])
    run([])
    assert seen == [30, 30]
    run([2])
    got = [(r.due, r.rows) for r in streams.triggers_of(spark, str(tmp_path / "store")).orderBy("due").collect()]
    assert seen == [30, 30, 45] and got == [(20, 30), (40, 45)]


def test_feedback_edges(spark):
    rows = [(i, "h", 90.0, 0, f, i) for i, f in enumerate(["[1,2,3,4,5,6,7,8]", "[]", "{broken", "[1,2,3,4,5,6,7]", None])]
    df = spark.createDataFrame(rows, "id int, dataset_hash string, predicted_score double, actual_label int, features string, timestamp int")
    assert feedback.feedback_train(df).count() == 1
    assert feedback.feedback_health(df).first()["status"] == "poor"
    assert feedback.feedback_health(df.limit(0)).first()["status"] == "no_data"
    assert feedback.feedback_cap(feedback.gate_table(df)).count() == 3


def test_rows_without_a_label_are_kept(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 != 0, (F.col("id") % 3 == 0).cast("int")).alias("label"))
    split = splits.split_stratified(df, "label", ["id"])
    assert split.count() == 1000 and split.filter("split = 'test' AND label IS NULL").count() == 62
    folds = splits.kfold_stratified(df, "label", ["id"], 4).groupBy("label", "fold").count().collect()
    assert sum(r["count"] for r in folds) == 1000 and {r["count"] for r in folds if r["label"] is None} == {62, 63}
    assert model.with_class_weight(df, "label").filter("weight IS NULL").count() == 0
    batches = with_batches(df.withColumn("f", F.when(F.col("id") > 500, "x")), ["id"], "f", 100)
    assert batches.count() == 1000


def test_splitting_moves_no_rows(spark):
    df = spark.range(50_000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    for out in (splits.split_ratio(df, ["id"]), splits.kfold_stratified(df, "label", ["id"]), splits.balance_classes(df, "label", ["id"])):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_corruption_is_seeded(spark):
    df = spark.range(2_000).select("id", (F.col("id") * 1.5).alias("x"), F.col("id").cast("string").alias("t"))
    dice = corrupt.Dice(("id",))
    once, again = corrupt.inject_nulls(df, dice, 0.2), corrupt.inject_nulls(df.repartition(9), dice, 0.2)
    assert once.exceptAll(again).count() == 0
    assert abs(once.filter("x IS NULL").count() / 2_000 - 0.2) < 0.04
    assert once.filter("id IS NULL").count() == 0
    assert abs(corrupt.inject_duplicates(df, dice, 0.1).count() - 2_200) < 60
    assert corrupt.inject_nulls(df, corrupt.Dice(("id",), seed=7), 0.2).exceptAll(once).count() > 0
    mixed = corrupt.interpolate(df, dice)
    assert mixed.count() == 2_000 and mixed.filter("x < 0 OR x > 2998.5").count() == 0
    assert corrupt.bootstrap(df, dice).count() > 1_500
    pairs = corrupt.labelled_pairs(df, dice, features8)
    assert sorted(r["label"] for r in pairs.collect()) == [0, 1]


def test_feature_sets_of_one_table(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (None, "7", 1), (3.0, None, 1), (3.0, None, 1)], "x double, t string, c int")
    eight = features8(df).first().asDict()
    assert list(eight) == FEATURES8
    assert eight["missing_ratio"] == pytest.approx(3 / 12) and eight["duplicate_ratio"] == pytest.approx(0.25)
    assert eight["constant_cols"] == 1 and eight["numeric_ratio"] == pytest.approx(2 / 3)
    seventeen = features17(df).first().asDict()
    assert list(seventeen) == FEATURES17
    assert seventeen["num_mixed_type_columns"] == 1 and seventeen["num_constant_columns"] == 1


def test_twins_roll_their_dice_once_and_compare_as_the_numbers_do(spark):
    """The plan of the pairs reads the damaged copy from files; digits compared as text agree with the numbers, at the ends too."""
    dice = corrupt.Dice(("id", "name"), algorithm="md5")
    df = spark.range(2000).selectExpr("id % 700 AS id", "IF(id % 5 = 0, NULL, CAST(id AS STRING)) AS name", "id * 1.0D AS v")
    plan = corrupt.labelled_pairs(df, dice, features8, lambda df, dice: corrupt.inject_nulls(df, dice, 0.3))._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan
    for rolled in (dice, corrupt.Dice(("id", "name"))):
        exact = df.select(rolled.roll("a")).first()[0]
        for rate in (-0.5, 0.0, 2.0**-52, 0.1, 0.3, exact, exact + 2.0**-52, 0.999, 1.0, 2.0):
            assert df.filter(rolled.spares("a", rate) != (rolled.roll("a") >= rate)).count() == 0
