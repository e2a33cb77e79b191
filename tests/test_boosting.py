"""Softmax boosting: splits against brute force, loss, probabilities, folds, many tasks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonepulse.models import boosting
from zonepulse.models.boosting import Settings, softmax

COLUMNS = ["a", "b", "c"]


def data(rows=240, seed=3, classes=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(rows, 3)), 1)
    label = np.clip(np.round(x[:, 0] + 0.4 * x[:, 1] + 1), 0, classes - 1).astype(int)
    return x, label


def frame(spark, x, label, weight=None):
    weight = np.ones(len(x)) if weight is None else weight
    return spark.createDataFrame([(i, *map(float, r), int(y), float(w)) for i, (r, y, w) in enumerate(zip(x, label, weight))],
                                 "id int, a double, b double, c double, y int, w double")


def fit(df, **options):
    settings = Settings(**({"rounds": 3, "depth": 2, "subsample": 1.0} | options.pop("settings", {})))
    return boosting.fit(df, settings, columns=COLUMNS, label="y", key=("id",), **options)


def best_split(x, g, w, cuts, least=1.0):
    """(gain, feature, cut) by trying every cut of every feature."""
    found = (-np.inf, None, None)
    for f in range(x.shape[1]):
        for cut in cuts[f]:
            left = x[:, f] <= cut
            if not 0 < left.sum() < len(left) or min(w[left].sum(), w[~left].sum()) < least:
                continue
            gain = sum((g[s] * w[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (g * w).sum() ** 2 / w.sum()
            if gain > found[0] + 1e-9:
                found = gain, f, cut
    return found


@pytest.mark.parametrize("weighted,least", [(False, 1.0), (True, 12.0)])
def test_first_trees_equal_brute_force(spark, weighted, least):
    x, label = data()
    weight = np.random.default_rng(1).integers(1, 4, len(x)).astype(float) if weighted else np.ones(len(x))
    model = fit(frame(spark, x, label, weight), weight="w", settings={"leaf_rows": least, "step": 0.3})
    share = np.bincount(label, weights=weight) / weight.sum()
    assert np.allclose(softmax(model.start), share)
    scores = np.tile(np.log(share), (len(x), 1))
    for r in range(3):
        chance = softmax(scores)
        assert model.losses[r] == pytest.approx(-(weight * np.log(chance[np.arange(len(x)), label])).sum() / weight.sum())
        for k in range(3):
            g = (label == k) - chance[:, k]
            node = np.zeros(len(x), int)
            for here in (0, 1, 2):
                some = node == here
                gain, f, cut = best_split(x[some], g[some], weight[some], model.cuts, least)
                got = model.trees.feature[r, k, here], model.trees.gain[r, k, here]
                if not gain > 1e-9:
                    assert got[0] == -1
                    continue
                assert (got[0], model.cuts[f][model.trees.bin[r, k, here]]) == (f, cut) and got[1] == pytest.approx(gain)
                node[some] = 2 * here + 1 + (x[some, f] > cut)
            for leaf in np.unique(node):
                s = node == leaf
                step = 0.3 * 2 / 3 * (weight[s] * g[s]).sum() / (weight[s] * np.abs(g[s]) * (1 - np.abs(g[s]))).sum()
                assert model.trees.value[r, k, leaf] == pytest.approx(step)
                scores[s, k] += step
    predicted = model.transform(frame(spark, x, label)).orderBy("id").toPandas()
    assert np.allclose(np.array(predicted["probability"].tolist()), softmax(scores))
    assert (predicted["prediction"] == softmax(scores).argmax(axis=1)).all()


def test_loss_falls_and_probabilities_sum_to_one(spark, monkeypatch):
    x, label = data(400, 5, 4)
    df = frame(spark, x, label).withColumn("c", F.when(F.col("id") % 9 > 0, F.col("c"))).withColumn(
        "y", F.when(F.col("id") % 50 > 0, F.col("y")))           # nulls among features and labels
    model = fit(df, settings={"rounds": 23, "depth": 3, "subsample": 0.8})   # scores are stored twice on the way
    assert all(b < a for a, b in zip(model.losses, model.losses[1:])) and len(model.losses) == 23
    out = model.transform(df).collect()
    assert len(out) == 400 and all(abs(sum(r.probability) - 1) < 1e-12 and len(r.probability) == 4 for r in out)
    assert sum(r.prediction == r.y for r in out if r.y is not None) > 0.9 * sum(r.y is not None for r in out)


def test_sums_of_many_tasks(spark, monkeypatch):
    x, label = data(300, 7)
    df = frame(spark, x, label)
    whole = fit(df.coalesce(1))
    monkeypatch.setattr(boosting, "DIRECT", 0)                     # added by a shuffle
    spread = fit(df.repartition(6, "id"))
    assert (whole.trees.feature == spread.trees.feature).all() and np.allclose(whole.trees.value, spread.trees.value)


def test_models_of_folds_leave_their_fold_out(spark):
    x, label = data(300, 9)
    df = frame(spark, x, label).withColumn("fold", F.col("id") % 3).cache()
    models = boosting.fit_models(df, 3, settings=Settings(rounds=2, depth=2, subsample=0.7), columns=COLUMNS, label="y", key=("id",))
    start, cuts = models[0].start, models[0].cuts
    for i, model in enumerate(models):
        alone = boosting.fit_models(df.withColumn("fold", F.when(F.col("fold") == i, 0).otherwise(1)), 1, settings=Settings(
            rounds=2, depth=2, subsample=0.7), columns=COLUMNS, label="y", key=("id",))
        rest = boosting.fit_models(df.withColumn("fold", F.when(F.col("fold") == i, 0).otherwise(1)), 2, settings=Settings(
            rounds=2, depth=2, subsample=0.7), columns=COLUMNS, label="y", key=("id",))[0]
        assert (rest.trees.feature == model.trees.feature).all() and np.allclose(rest.trees.value, model.trees.value)
        assert np.allclose(alone[0].start, start) and all((a == b).all() for a, b in zip(alone[0].cuts, cuts))


def test_save_load_and_importance(spark, tmp_path):
    x, label = data()
    model = fit(frame(spark, x, label))
    model.save(spark, str(tmp_path / "m"))
    again = boosting.SoftmaxModel.load(spark, str(tmp_path / "m"))
    assert np.array_equal(model.scored(x), again.scored(x)) and again.losses == model.losses
    shares = again.importance()
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a" and min(shares.values()) >= 0


def test_one_class_and_no_rows(spark):
    x, _ = data(20)
    model = fit(frame(spark, x, np.zeros(20, int)))
    assert {r.prediction for r in model.transform(frame(spark, x, np.zeros(20, int))).collect()} == {0.0}
    with pytest.raises(ValueError):
        fit(frame(spark, x, np.zeros(20, int)).limit(0))
    constant = fit(frame(spark, np.ones((20, 3)), np.arange(20) % 2))
    assert (constant.trees.feature == -1).all()


def test_rows_are_dealt_by_their_number(spark, monkeypatch):
    x, label = data(rows=240)
    df, files, sums = frame(spark, x, label).coalesce(1), set(), boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda state, *a: files.add(len(state.inputFiles())) or sums(state, *a))
    whole = fit(df, settings={"rounds": 1})
    assert files == {1}
    files.clear()
    monkeypatch.setattr("zonepulse.session.TASK_ROWS", 50)
    assert fit(df, settings={"rounds": 1}).losses == pytest.approx(whole.losses)
    assert files == {5}


def test_binary_columns_are_read_where_they_lie():
    rows = [np.arange(i, i + 4, dtype=float) for i in range(6)]
    column = pa.array([r.tobytes() for r in rows], pa.binary())
    for some in (column, column.slice(2, 3), column.cast(pa.large_binary())):
        assert boosting._joined(some, np.float64).tobytes() == b"".join(some.to_pylist())
    assert len(boosting._joined(column.slice(0, 0), np.uint8)) == 0
