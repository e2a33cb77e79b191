import json
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse import rules
from zonepulse.catalog.queries import feature_lake, grid_lake
from zonepulse.models import estimators, forest, metrics
from zonepulse.models.scoring import Models
from zonepulse.operators import split
from zonepulse.operators.quantile import kth_smallest, quantile
from zonepulse.plans import scoring, training
from zonepulse.session import scratch_dir
from zonepulse.sources import broker, serving
from zonepulse.streaming import sinks


@pytest.fixture(scope="module")
def cells(spark, sf_dir):
    return feature_lake(spark, sf_dir)


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    folder = scratch_dir(spark, "test-models")
    result = training.train(grid_lake(spark, sf_dir), folder, classifier_trees=3, regressor_trees=5,
                            forest_trees=20)
    return result, folder


@pytest.mark.parametrize("values", [
    [3.0, 1.0, 2.0], [5.0] * 50, [1e-300, 2e-300, 1e300], [0.0, -0.0, 1.0],
    list(np.random.default_rng(1).normal(size=500)),
    [1.0] * 300 + list(np.random.default_rng(2).exponential(size=200)),
    [1.0, np.nextafter(1.0, 2.0), np.nextafter(np.nextafter(1.0, 2.0), 2.0)],
])
def test_order_statistics_equal_sorting(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(3)
    for k in {0, len(values) // 2, len(values) - 1}:
        assert kth_smallest(df, "x", k, buckets=16) == sorted(values)[k]
    for q in (0.0, 0.5, 0.95, 1.0):
        assert quantile(df, "x", q) == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_quantile_of_nothing_is_an_error(spark):
    empty = spark.createDataFrame([], "x double")
    with pytest.raises(ValueError):
        quantile(empty, "x", 0.5)
    with pytest.raises(ValueError):
        kth_smallest(empty, "x", 0)


def test_split_shares_are_exact_per_class(cells):
    out = split.train_test(cells, stratify="congestion_level")
    for r in out.groupBy("congestion_level").agg(
            F.count("*").alias("n"), F.count_if(~F.col("is_train")).alias("test")).collect():
        assert r.test == -(-r.n // 5)
    plain = split.train_test(cells)
    assert plain.filter("NOT is_train").count() == -(-cells.count() // 5)


def test_split_does_not_depend_on_partitioning(cells):
    def test_keys(df):
        out = split.train_test(df, stratify="congestion_level").filter("NOT is_train")
        return {(r.zone_id, r.hour_bucket) for r in out.collect()}
    assert test_keys(cells.repartition(1)) == test_keys(cells.repartition(7))
    other = split.train_test(cells, stratify="congestion_level", seed=7).filter("NOT is_train")
    assert {(r.zone_id, r.hour_bucket) for r in other.collect()} != test_keys(cells)


def test_one_dominant_class_is_split_over_slices(spark):
    df = spark.range(20000).select(F.col("id").alias("zone_id"), F.lit(1).alias("hour_bucket"),
                                   F.when(F.col("id") < 100, 0).otherwise(1).alias("label"))
    placed = split.hash_positions(df, within="label")
    stats = placed.groupBy("label").agg(F.min("position"), F.max("position"),
                                        F.count_distinct("position")).collect()
    assert {tuple(r) for r in stats} == {(0, 1, 100, 100), (1, 1, 19900, 19900)}


def test_null_class_is_a_class_of_its_own(spark):
    df = spark.createDataFrame([(i, 0, None if i % 2 else 1) for i in range(50)],
                               "zone_id int, hour_bucket int, label int")
    out = split.train_test(df, stratify="label")
    assert {tuple(r) for r in out.groupBy("label").agg(
        F.count("*"), F.count_if("is_train")).collect()} == {(None, 25, 20), (1, 25, 20)}


def test_training_without_a_feature_and_with_balanced_classes(spark, sf_dir):
    grid = grid_lake(spark, sf_dir).drop("total_passengers")
    result = training.train(grid, classifier_trees=1, regressor_trees=1, forest_trees=5, balanced=True)
    assert "total_passengers" not in result.features.columns
    assert result.models.predict(result.features).count() == 596


def test_folds_are_balanced(cells):
    out = split.stratified_folds(cells, "congestion_level", 5)
    sizes = out.groupBy("congestion_level").pivot("fold", list(range(5))).count().collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in sizes)


def test_class_weights_are_balanced(cells):
    weighted = metrics.with_class_weights(cells)
    sums = [r.w for r in weighted.groupBy("congestion_level").agg(F.sum("weight").alias("w")).collect()]
    assert sums == pytest.approx([cells.count() / len(sums)] * len(sums))


def test_scores_equal_mllib_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    rng = np.random.default_rng(3)
    rows = [(int(a), float(b)) for a, b in zip(rng.integers(0, 4, 400), rng.integers(0, 4, 400))]
    df = spark.createDataFrame(rows, "congestion_level int, prediction double")
    ours = metrics.classification_scores(df).first()
    for name, metric in (("accuracy", "accuracy"), ("weighted_f1", "f1")):
        other = MulticlassClassificationEvaluator(labelCol="congestion_level", metricName=metric).evaluate(df)
        assert ours[name] == pytest.approx(other)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(size=(300, 2))],
                               "delay_minutes double, prediction double")
    ours = metrics.regression_scores(df).first()
    for metric in ("rmse", "mae", "r2"):
        other = RegressionEvaluator(labelCol="delay_minutes", metricName=metric).evaluate(df)
        assert ours[metric] == pytest.approx(other)


def test_report_names_classes_and_handles_absent_ones(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 3.0), (2, 2.0)], "congestion_level int, prediction double")
    report = {r["class_name"]: r for r in metrics.classification_report(df).collect()}
    assert set(report) == {"Free Flow", "Heavy", "Gridlock"}
    assert (report["Free Flow"].precision, report["Free Flow"].recall) == (1.0, 0.5)
    assert (report["Gridlock"].precision, report["Gridlock"].support) == (0.0, 0)


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 22)) * rng.uniform(0.5, 5, 22) + rng.normal(size=22)
    y = x @ rng.normal(size=22) + rng.normal(size=60)
    df = spark.createDataFrame(
        [(*map(float, row), float(t)) for row, t in zip(x, y)],
        ", ".join(f"{c} double" for c in (*rules.FEATURES, "delay_minutes")))
    model = estimators.fit(estimators.delay_ridge(df), df)
    got = [r.prediction for r in model.transform(df).select("prediction").collect()]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    w = np.linalg.solve(z.T @ z + 10.0 * np.eye(22), z.T @ (y - y.mean()))
    np.testing.assert_allclose(got, z @ w + y.mean(), rtol=1e-6)


def test_training_reports_and_beats_the_mean(trained, cells):
    result, _ = trained
    rows = {(r.model_name, r.metric_name): r.metric_value for r in result.performance.collect()}
    assert rows["congestion_classifier", "accuracy"] > 0.6
    train, test = training.split(cells)
    base = metrics.regression_scores(estimators.delay_mean(train, test)).first()
    assert rows["delay_regressor", "rmse"] < base.rmse
    assert rows["hotspot_detector", "hotspots"] <= 0.05 * 596 + 1
    assert {r.dataset_size for r in result.performance.collect()} == {596}


def test_saved_models_predict_the_same_and_in_range(spark, trained, cells):
    result, folder = trained
    key = ["zone_id", "timestamp"]
    a = result.models.predict(cells).orderBy(*key).collect()
    b = Models.load(spark, folder).predict(cells).orderBy(*key).collect()
    assert a == b and len(a) == 596
    assert {r.congestion_level for r in a} <= {0, 1, 2, 3}
    assert min(r.predicted_delay_minutes for r in a) >= 0


def test_serving_gets_predictions(spark, trained, sf_dir):
    _, folder = trained
    grid = grid_lake(spark, sf_dir)
    path = scratch_dir(spark, "serving")
    serving.write_zone_metrics(serving.batch_projection(grid), path)
    scoring.score_serving(spark, grid, folder, path)
    served = serving.read_zone_metrics(spark, path)
    assert served.count() == 596
    assert served.filter("predicted_delay_minutes IS NULL").count() == 0
    assert served.filter("is_hotspot").count() > 0


def test_only_pending_periods_are_scored(spark, trained, sf_dir, tmp_path):
    _, folder = trained
    grid = grid_lake(spark, sf_dir).withColumn("timestamp", F.col("hour_bucket"))
    path = str(tmp_path / "serving")
    later = grid.withColumns({c: F.col(c) + F.expr("INTERVAL 60 DAYS") for c in ("hour_bucket", "timestamp")})
    serving.write_zone_metrics(serving.batch_projection(grid.unionByName(later)), path)
    scoring.score_serving(spark, grid.unionByName(later), folder, path)
    scored = serving.read_zone_metrics(spark, path)
    assert scored.filter("predicted_delay_minutes IS NULL").count() == 0 and scored.count() == 1192
    files = {f: (tmp_path / "serving" / f.split("/serving/")[1]).stat().st_mtime_ns for f in scored.inputFiles()}
    scoring.score_serving(spark, grid.unionByName(later), folder, path)              # nothing is pending
    assert set(serving.read_zone_metrics(spark, path).inputFiles()) == set(files)
    stray = later.limit(1).withColumns({"zone_id": F.lit(77), "trip_count": F.lit(5)})
    serving.write_zone_metrics(serving.batch_projection(stray), path)
    scoring.score_serving(spark, grid.unionByName(later).unionByName(stray), folder, path)
    after = serving.read_zone_metrics(spark, path)
    month = stray.select(F.date_trunc("month", "timestamp").cast("date")).first()[0]
    assert {f for f in after.inputFiles() if f not in files} and all(str(month) in f for f in after.inputFiles() if f not in files)
    assert after.filter("predicted_delay_minutes IS NULL").count() == 0


def test_stream_scoring_equals_batch(spark, trained, cells, tmp_path):
    result, _ = trained
    inbox = str(tmp_path / "features")
    cells.repartition(3).write.parquet(inbox)
    stream = broker.file_stream(spark, inbox, cells.schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    scoring.score_stream(stream, result.models, out, str(tmp_path / "cp"), once=True).awaitTermination()
    expected = result.models.predict(cells)
    got = sinks.read_batches(spark, out, expected.schema)
    assert got.select("batch_id").distinct().count() == 3
    assert sorted(got.drop("batch_id").collect()) == sorted(expected.collect())


def test_importance_is_a_top_k(spark, cells):
    model = estimators.fit(estimators.congestion_gbt(2, depth=3), cells)
    top = estimators.feature_importance(spark, model).collect()
    assert len(top) == 10 and top[0].feature in ("avg_speed", "congestion_ratio")
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_cross_validation_is_reasonable(spark, cells):
    mean, std = estimators.cross_validate(
        estimators.congestion_forest(2, 4, weight_col=None), cells, folds=3)
    assert 0.5 < mean <= 1 and 0 <= std < 0.3


# --- isolation forest -------------------------------------------------------------------

def cloud(spark, n=900, outlier=True):
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(n, 2)))]
    if outlier:
        rows[17] = (17, 40.0, -40.0)
    return spark.createDataFrame(rows, "id int, a double, b double")


def fit(df, **options):
    return forest.fit_hotspot_forest(df, ("a", "b"), ("id",), **({"trees": 30} | options))


def test_extreme_row_is_flagged_first(spark):
    df = cloud(spark)
    out = fit(df).transform(df)
    assert out.orderBy(F.desc("anomaly_score")).first().id == 17
    assert out.filter("is_hotspot AND id = 17").count() == 1
    assert abs(out.filter("is_hotspot").count() - 0.05 * 900) <= 1


def test_forest_does_not_depend_on_partitioning(spark):
    df = cloud(spark)
    results = [fit(df.repartition(p)) for p in (1, 6)]
    nodes = [sorted(f.nodes.collect()) for f in results]
    assert nodes[0] == nodes[1] and results[0].threshold == results[1].threshold
    assert fit(df, seed=1).threshold != results[0].threshold


def test_scores_equal_walking_every_tree(spark):
    df = cloud(spark, 200)
    fitted = fit(df, trees=7, max_sample=64)
    nodes = {(r.tree_id, r.node_id): r for r in fitted.nodes.collect()}

    def walk(point):
        total = 0.0
        for tree in range(7):
            node = nodes[tree, 0]
            while node.feature >= 0:
                node = nodes[tree, node.left if point[node.feature] <= node.threshold else node.right]
            total += node.path
        return 2 ** (-total / 7 / forest.average_path(64))
    for r in fitted.transform(df).collect():
        assert r.anomaly_score == pytest.approx(walk((r.a, r.b)))


def test_tree_size_is_bounded(spark):
    nodes = fit(cloud(spark, 3000), trees=10, max_sample=128).nodes
    per_tree = [r.n for r in nodes.groupBy("tree_id").agg(F.count("*").alias("n")).collect()]
    assert len(per_tree) == 10 and max(per_tree) <= 2 * 128 - 1


def test_each_tree_draws_evenly(spark):
    """Rows per tree and trees per row match independent draws (binomial, five deviations)."""
    n, trees, sample = 20000, 100, 256
    df = spark.range(n).select("id", F.rand(1).alias("a"))
    drawn = forest._sampled(df, ["a"], ("id",), n, trees, sample, 42)
    expected = forest.OVERSAMPLE * sample
    per_tree = [r["count"] for r in drawn.groupBy("tree_id").count().collect()]
    assert len(per_tree) == trees
    assert all(abs(c - expected) < 5 * expected ** 0.5 for c in per_tree)
    assert abs(sum(per_tree) - trees * expected) < 5 * (trees * expected) ** 0.5
    rows = drawn.select("a").distinct().count()
    none = n * (1 - expected / n) ** trees
    assert abs(n - rows - none) < 5 * none ** 0.5
    assert abs(drawn.agg(F.avg("a")).first()[0] - 0.5) < 0.01


def test_path_lengths():
    assert [forest.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forest.average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_constant_rows_are_not_hotspots(spark):
    df = spark.createDataFrame([(i, 1.0, 1.0) for i in range(50)], "id int, a double, b double")
    assert fit(df).transform(df).filter("is_hotspot").count() == 0


def test_forest_uses_available_columns_and_nulls_as_zero(spark):
    df = spark.createDataFrame([(i, float(i % 5) if i else None) for i in range(60)], "id int, a double")
    fitted = fit(df)
    assert fitted.columns == ["a"]
    assert fitted.transform(df).filter("anomaly_score IS NULL").count() == 0


def test_forest_save_and_load(spark, tmp_path):
    df = cloud(spark, 300)
    fitted = fit(df)
    fitted.save(str(tmp_path / "f"))
    loaded = forest.HotspotForest.load(spark, str(tmp_path / "f"))
    assert loaded.threshold == fitted.threshold
    assert sorted(loaded.transform(df).collect()) == sorted(fitted.transform(df).collect())


def test_performance_rows(spark):
    when = datetime(2024, 1, 1, tzinfo=timezone.utc)
    path = scratch_dir(spark, "performance")
    for _ in range(2):
        serving.append_model_performance(
            metrics.performance_rows(spark, "m", {"a": 1, "b": 2.5}, 10, when, json.dumps({})), path)
    assert spark.read.parquet(path).count() == 4
