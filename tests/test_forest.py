import numpy as np
import pytest
from pyspark.ml import PipelineModel

from wardlog.operators import forest as FO
from wardlog.plans import learning as L

T = FO._Tasks


def table(spark, x, y):
    columns = [f"x{i}" for i in range(x.shape[1])]
    schema = ", ".join(f"{c} double" for c in columns) + ", label int"
    return spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], schema).repartition(3), columns


def test_cuts_from_counts_and_from_rows_are_the_best():
    rng = np.random.default_rng(1)
    node, code, label, weight = rng.integers(0, 4, 500), rng.integers(0, 9, 500), rng.integers(0, 3, 500), rng.poisson(1, 500) + 1.0
    counts = np.bincount(node * 3 + label, weight, 12).reshape(4, 3)
    found = [search(node, code, label, weight, counts, 9) for search in (T.by_counts, T.by_rows)]
    for k in range(4):
        def purity(rows):
            held = np.bincount(label[rows], weight[rows], 3)
            return (held**2).sum() / held.sum()

        own = node == k
        want = [purity(own & (code <= c)) + purity(own & (code > c)) for c in range(code[own].max())]
        for score, cut in found:
            assert score[k] == pytest.approx(max(want)) and cut[k] == int(np.argmax(want))


@pytest.mark.parametrize("depth", [0, 2, 30])
def test_trees_end_at_their_depth_or_in_pure_leaves(depth):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 64, (400, 5)).astype(np.uint8), rng.integers(0, 3, 400)
    feature, cut, child, values, falls = T.grow(x, y, 3, 64, depth, 3, 7)
    assert len(feature) == len(cut) == len(child) and np.allclose(values.sum(axis=1), 1)
    assert len(child) == 1 if depth == 0 else len(child) <= 7 if depth == 2 else set(values.max(axis=1)) == {1}
    assert T.chances(x, [(feature, cut, child, values, falls)], 3).sum() == pytest.approx(400)


def test_large_trees_of_noise_are_small_arrays(spark, tmp_path):
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 1, (1500, 6)), rng.integers(0, 4, 1500)
    df, columns = table(spark, x, y)
    model = L.fit_classifier("random_forest", df, columns, trees=10, trees_in_tasks=True)
    found = model.stages[-1]
    assert isinstance(found, FO.Forest) and found.totalNumNodes > 10 * 600  # a leaf for most rows of a tree
    held = sum(v.nbytes for feature, cut, child, values, _ in found._parts()[0] for v in (feature, cut, child))
    assert held == 6 * found.totalNumNodes
    rows = model.transform(df).collect()
    assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.95 and all(sum(r["probabilities"]) == pytest.approx(1) for r in rows)
    again = L.fit_classifier("random_forest", df.repartition(5), columns, trees=10, trees_in_tasks=True).stages[-1]
    for one, other in zip(again._parts()[0], found._parts()[0]):
        assert all(np.array_equal(a, b) for a, b in zip(one[:4], other[:4]))
    PipelineModel([found]).write().overwrite().save(str(tmp_path / "m"))
    stored = PipelineModel.load(str(tmp_path / "m")).transform(L.apply_stages(model.stages[:-1], df))
    assert sorted(map(str, stored.select("probabilities").collect())) == sorted(str(r) for r in model.transform(df).select("probabilities").collect())


def test_a_forest_learns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (900, 4))
    y = np.digitize(x[:, 1] + x[:, 2], [-0.7, 0.7])
    df, columns = table(spark, x, y)
    model = L.fit_classifier("random_forest", df.where("x0 < 0.5"), columns, trees=20, trees_in_tasks=True)
    rows = model.transform(df.where("x0 >= 0.5")).collect()
    assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.8
    assert set(np.argsort(model.importances)[-2:]) == {1, 2}


def test_wide_tables_have_sparks_forest(spark, monkeypatch):
    monkeypatch.setattr(L, "FOREST_BYTES", 100)
    df, columns = table(spark, np.random.default_rng(6).normal(0, 1, (60, 2)), np.arange(60) % 2)
    assert hasattr(L.fit_classifier("random_forest", df, columns, trees=2, depth=3, trees_in_tasks=True).stages[-1], "trees")
