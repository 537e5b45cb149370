import time

import pytest
from pyspark.sql import functions as F

from wattloom.operators import explain, learning, registry, scoring, splits
from wattloom.plans import standins
from wattloom.session import fresh_path, written


@pytest.fixture(scope="module")
def table(spark, sf):
    """Features with a target that depends on one of them, so that there is a right answer."""
    features = standins.features(spark, sf)
    target = F.col("temp_mean_c") * 2 + F.col("day_of_week")
    known = features.where(F.col("temp_mean_c").isNotNull()).withColumn("total_kwh", target)
    return written(splits.time_split(known), "features")


FEATURES = ["temp_mean_c", "day_of_week", "lag_30_kwh", "precip_mm"]


@pytest.fixture(scope="module")
def forest(table):
    return learning.train_and_test(learning.forest(numTrees=12, maxDepth=6), table, "forest",
                                   features=FEATURES)


def test_selection(table):
    columns = learning.feature_columns(table)
    assert "hvac_ratio" in columns and "hvac_ratio" not in learning.feature_columns(table, strict=True)
    assert not {"Date", "total_kwh", "Year", "Month", "cal_year", "split"} & set(columns)
    empty = table.withColumn("nothing", F.lit(None).cast("double"))
    assert "nothing" not in learning.feature_columns(empty)


def test_forest_learns(forest, table):
    assert forest.metrics["R2"] > 0.5
    test = forest.predict(table.where("split = 'test'"))
    gain = scoring.baseline_improvement(test).first()
    assert gain["improvement_pct"] > 20


def test_interval_is_the_spread_of_the_trees(spark, forest, table):
    path = fresh_path(spark, "model")
    forest.model.write().save(path)
    scored = forest.predict(table)
    with_interval = learning.forest_interval(scored, learning.leaf_values(spark, path))
    trees = forest.prepare(table)
    for i, tree in enumerate(forest.model.trees):
        trees = tree.setPredictionCol(f"p{i}").setLeafCol("").transform(trees)
    votes = F.array(*[f"p{i}" for i in range(12)])
    mean = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v) / 12
    var = F.aggregate(votes, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / 12
    both = with_interval.select("Date", "prediction", "upper").join(
        trees.select("Date", mean.alias("mean"), F.sqrt(var).alias("sd")), "Date")
    worst = both.agg(F.max(F.abs(F.col("prediction") - F.col("mean"))).alias("a"),
                     F.max(F.abs(F.col("upper") - F.col("prediction") - 1.96 * F.col("sd"))).alias("b"),
                     F.count(F.lit(1)).alias("n")).first()
    assert worst["a"] < 1e-9 and worst["b"] < 1e-9 and worst["n"] == table.count()
    # The leaf table is no part of the plan.
    assert len(with_interval._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_interval_of_a_full_forest(spark, table):
    """200 trees: the plan stays as small as that of a few, rows that are equal stay apart."""
    fitted = learning.train_and_test(learning.forest(numTrees=200, maxDepth=4), table, "forest",
                                     features=FEATURES)
    path = fresh_path(spark, "model")
    fitted.model.write().save(path)
    scored = fitted.predict(table.limit(40).union(table.limit(40)))
    out = learning.forest_interval(scored, learning.leaf_values(spark, path))
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    leaves = {}
    for r in learning.leaf_values(spark, path).collect():
        leaves[r.tree, r.leaf] = r.value
    rows = out.collect()
    assert len(rows) == scored.count()
    for r in rows[::7]:
        votes = [leaves[t, int(at)] for t, at in enumerate(r.leaf)]
        mean = sum(votes) / 200
        sd = (sum((v - mean) ** 2 for v in votes) / 200) ** 0.5
        assert r.prediction == pytest.approx(mean) and r.upper - r.lower == pytest.approx(3.92 * sd)


def test_importance_and_permutation(forest, table):
    top = explain.importance(forest, top=2).collect()
    assert top[0]["feature"] == "temp_mean_c" and len(top) == 2
    effects = explain.permutation_effects(forest, table.where("split = 'test'")).collect()
    assert effects[0]["feature"] == "temp_mean_c" and effects[0]["direction"] == "increases"
    assert len(effects) == len(FEATURES)


@pytest.mark.parametrize("options", [{}, {"patience": 3}])
def test_boosted_stops_by_itself(table, options):
    fitted = learning.train_and_test(learning.boosted(maxIter=20, maxDepth=3), table, "boosted",
                                     features=FEATURES, **options)
    assert 1 <= fitted.model.getNumTrees <= 20 and fitted.metrics["R2"] > 0.5


def test_cross_validation(table):
    scores = learning.cross_validate(learning.forest(numTrees=5, maxDepth=4), table, FEATURES, 3)
    summary = learning.cv_summary(scores).first()
    assert summary["folds"] == 3 and summary["mae_std"] >= 0


def test_registry(spark, forest, table):
    base = fresh_path(spark, "registry")
    for version, at in [("v1.0", "2024-01-01 00:00:00"), ("v1.1", "2024-01-02 00:00:00")]:
        path = registry.register(spark, base, forest, version, ("a", "b"), ("c", "d"), now=at)
    assert registry.latest(spark, base).first()["latest_version"] == "v1.1"
    assert registry.feature_schema(spark, base).first()["n_features"] == len(FEATURES)
    again = registry.load(spark, base, "v1.1")
    assert again.features == FEATURES and again.medians == pytest.approx(forest.medians)
    same = learning.batch_score(again, table, "v1.1", path).join(
        learning.batch_score(forest, table, "v1.1", path), "Date")
    assert same.count() == table.count()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (0.0, 0.5), (4.0, 3.0)], "total_kwh double, prediction double")
    row = scoring.evaluate(df, "m").first()
    assert row["MAE"] == pytest.approx(2.5 / 4)
    assert row["RMSE"] == pytest.approx((2.25 / 4) ** 0.5)
    assert row["R2"] == pytest.approx(1 - 2.25 / 8.75)
    assert row["MAPE"] == pytest.approx((1 + 0 + 5 + 0.25) / 4 * 100)


def test_threads_have_local_properties_of_their_own(spark):
    """Jobs at once set and clear properties, such as the id of the running query."""
    def work(k):
        spark.sparkContext.setLocalProperty("wattloom.test", str(k))
        time.sleep(0.5)
        return spark.sparkContext.getLocalProperty("wattloom.test")
    assert learning.at_once(spark, work, range(5)) == [str(k) for k in range(5)]
    assert spark.sparkContext.getLocalProperty("wattloom.test") is None
