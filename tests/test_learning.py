"""Tolerance checks of the learning plans on the test tables."""

import math

import pytest
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.operators import metrics as M
from wardlog.operators import respond as R
from wardlog.operators import sampling as SA
from wardlog.operators import sessions as SE
from wardlog.plans import learning as L
from wardlog.plans import scoring
from wardlog.session import materialize
from wardlog.sources import logs

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def parts(spark):
    matrix = materialize(L.training_matrix(SE.session_features(logs.load_events(spark, D)), S.SERVING_FEATURES))
    split = materialize(SA.stratified_split(matrix))
    return split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")


EFFORT = dict(trees=20, depth=8, rounds=3, iterations=50, kernel_size=16)


def test_every_model_beats_the_majority(spark, parts):
    train, test = parts
    majority = 1963 / 4006
    metrics, models = L.bake_off(train, test, S.SERVING_FEATURES, **EFFORT)
    rows = metrics.collect()
    assert [r["model"] for r in rows] == L.MODELS and all(r["error"] is None for r in rows), rows
    assert all(r["accuracy"] > majority + 0.1 for r in rows), rows
    scored = models["gradient_boosting"].transform(test)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    assert {r["auc"] > 0.8 for r in M.roc_auc(L.class_scores(models["svm"].transform(test), models["svm"].classes)).collect()} == {True}


def test_a_failing_model_becomes_a_row(spark, parts):
    one_class = parts[0].where("label = 0")
    rows = L.bake_off(one_class, parts[1], S.SERVING_FEATURES, ["logistic_regression"])[0].collect()
    assert rows[0]["f1"] is None and "class" in rows[0]["error"]
    two = materialize(SA.synthesize_minority(one_class))
    assert L.bake_off(two, parts[1], S.SERVING_FEATURES, ["logistic_regression"])[0].first()["error"] is None


def test_forests_keep_node_ids(spark, parts):
    model = L.fit_classifier("random_forest", parts[0], S.SERVING_FEATURES, trees=3, depth=4)
    assert model.stages[-1].getCacheNodeIds()


def test_importances(spark, parts):
    rows = L.feature_importance(parts[0], S.SERVING_FEATURES, trees=20, depth=8).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


@pytest.mark.parametrize("scope", ["train", "fold"])
def test_cross_validation(spark, parts, scope):
    row = L.cross_validate(parts[0], S.SERVING_FEATURES, ["logistic_regression"], folds=3, scale_scope=scope, iterations=20).first()
    assert row["accuracy"] > 0.8 and row["accuracy_std"] < 0.1


def test_clusters(spark, parts, tmp_path):
    train = parts[0]
    found, sweep = L.train_clusters(train, S.SERVING_FEATURES)
    inertia = [r["inertia"] for r in sweep.orderBy("k").collect()]
    assert len(inertia) == 9 and all(b < a * 1.02 for a, b in zip(inertia, inertia[1:]))
    assert found.centers == sorted(found.centers)
    found.save(str(tmp_path / "clusters"))
    again = L.Clusters.load(str(tmp_path / "clusters"))
    a = {r["id"]: r["cluster"] for r in found.transform(train).collect()}
    assert a == {r["id"]: r["cluster"] for r in again.transform(train).collect()}
    assert set(a.values()) <= set(range(len(found.centers)))
    _, silhouettes = L.train_clusters(train, S.SERVING_FEATURES, method="silhouette")
    assert [r["k"] for r in silhouettes.orderBy("k").collect()] == [2, 3, 4, 5]


def test_silhouette_sweep_on_few_rows(spark):
    df = spark.createDataFrame([(i, float(i % 2), float(i)) for i in range(12)], "id long, a double, b double")
    found, sweep = L.train_clusters(df, ["a", "b"], method="silhouette")
    assert sweep.count() == 0 and len(found.centers) == 2


def test_pairs_are_coupled(spark):
    """Two classes: the chance of the pair. Three: agreeing pairs give back the distribution they come from."""
    from pyspark.ml.linalg import Vectors

    def margin(p):
        return Vectors.dense(0.0, math.log(p / (1 - p)))

    two = spark.createDataFrame([(margin(0.8),)], ["raw_3_7"])
    prediction, chances = L.couple_pairs([3, 7], [[3, 7, 1.0, 0.0]])
    row = two.select(prediction.alias("p"), chances.alias("c")).first()
    assert row["p"] == 7 and row["c"] == pytest.approx([0.2, 0.8])
    want = [0.2, 0.5, 0.3]
    three = spark.createDataFrame([tuple(margin(want[b] / (want[a] + want[b])) for a, b in ((0, 1), (0, 2), (1, 2)))], ["raw_0_1", "raw_0_2", "raw_1_2"])
    prediction, chances = L.couple_pairs([0, 1, 2], [[0, 1, 1.0, 0.0], [0, 2, 1.0, 0.0], [1, 2, 1.0, 0.0]])
    row = three.select(prediction.alias("p"), chances.alias("c")).first()
    assert row["p"] == 1 and row["c"] == pytest.approx(want)


def test_chances_of_the_kernel_machine_on_rows_it_has_not_seen(spark, parts, tmp_path):
    train, test = parts
    model = L.fit_classifier("svm", train, S.SERVING_FEATURES, **EFFORT | {"kernel_size": 64})
    scored = model.transform(test).select("label", "prediction", "probabilities")
    rows = scored.collect()
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 and min(r["probabilities"]) >= 0 for r in rows)
    for c in range(3):  # among all rows, the mean chance of a class is its share
        assert abs(sum(r["probabilities"][c] for r in rows) - sum(r["label"] == c for r in rows)) < 0.05 * len(rows)
    model.save(str(tmp_path / "svm"))
    again = L.Fitted.load(str(tmp_path / "svm")).transform(test).select("label", "prediction", "probabilities").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_kernel_rows_for_training_equal_the_stages(spark, parts):
    preparation = L.fit_preparation(parts[0], S.SERVING_FEATURES)
    ready = L.apply_stages([*preparation, *L._kernel_stages([f"x_{c}" for c in S.SERVING_FEATURES], 16)], parts[1])
    both = [{r["id"]: list(r["kernel"]) for r in df.select("id", "kernel").collect()}
            for df in (ready, L.kernel_rows(ready.select("features", "id"), len(S.SERVING_FEATURES), 16))]
    assert len(both[0]) == parts[1].count() and both[0].keys() == both[1].keys()
    assert all(both[1][i] == pytest.approx(row, abs=1e-9) for i, row in both[0].items())


def test_pca_is_centred(spark, parts):
    stats = L.pca_2d(parts[0], S.SERVING_FEATURES).agg(
        F.avg("pc1"), F.avg("pc2"), F.corr("pc1", "pc2"), F.variance("pc1") > F.variance("pc2")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(0, abs=1e-9)
    assert abs(stats[2]) < 1e-6 and stats[3]


def test_stored_model_scores_alike(spark, parts, tmp_path):
    train, test = parts
    sessions = SE.session_features(logs.load_events(spark, D))
    found, _ = L.train_clusters(train, S.SERVING_FEATURES, k=4)
    for name in ["random_forest", "gradient_boosting"]:
        model = L.fit_classifier(name, train, S.SERVING_FEATURES, **EFFORT)
        model.save(str(tmp_path / name))
        again = L.Fitted.load(str(tmp_path / name))
        mapping = R.response_map(found.transform(train.withColumnRenamed("label", "threat_code")))
        first = scoring.score_with_models(sessions, model, found, mapping).select("session_id", "threat_code", "cluster", "response_level")
        second = scoring.score_with_models(sessions, again, found, mapping).select("session_id", "threat_code", "cluster", "response_level")
        assert first.exceptAll(second).isEmpty() and first.count() == 4006
        assert first.where("response_level <> threat_code").isEmpty()
        failed = scoring.score_with_models(sessions.drop("duration"), model, found, mapping)
        row = failed.select("threat_code", "cluster", "response_level", "strategy", "error").distinct().collect()
        assert [tuple(r) for r in row] == [(0, 0, 0, "low", "missing features: duration")]


def test_models_are_fitted_side_by_side(spark, parts):
    from threading import Barrier

    meeting, model = Barrier(2, timeout=60), L.fit_classifier("logistic_regression", parts[0], S.SERVING_FEATURES, iterations=5)

    def fit(name):
        meeting.wait()
        return model

    metrics, models = L.bake_off(*parts, S.SERVING_FEATURES, ["svm", "xgboost"], preparation=[], fit=fit)
    assert [r["model"] for r in metrics.orderBy("position").collect()] == ["svm", "xgboost"] and list(models) == ["svm", "xgboost"]


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest"])
def test_models_of_two_classes_after_an_observation(spark, parts, name):
    from pyspark.sql import Observation

    spark.range(3).observe(Observation("rows"), F.count(F.lit(1)).alias("n")).collect()
    train, test = (p.where("label < 2") for p in parts)
    model = L.fit_classifier(name, train, S.SERVING_FEATURES, trees=3, depth=4, iterations=20)
    assert M.weighted_metrics(model.transform(test)).first()["accuracy"] > 0.7
