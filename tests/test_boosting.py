import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler

from wardlog.operators import boosting as B


def brute(x, y, classes, rounds, depth, rate=0.3, l2=1.0, least_child=1.0):
    """The same booster by recursion over row sets, every different value a possible cut; margins of the rows."""
    margins = np.zeros((len(x), classes))

    def grow(rows, g, h, level, out):
        G, H = g[rows].sum(), h[rows].sum()
        best = (B.LEAST_GAIN, None)
        if level < depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= v
                    gl, hl = g[rows[left]].sum(), h[rows[left]].sum()
                    if hl < least_child or H - hl < least_child:
                        continue
                    gain = (gl**2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G**2 / (H + l2)) / 2
                    if gain > best[0] + 1e-12:
                        best = (gain, rows[left], rows[~left])
        if best[1] is None:
            out[rows] = -rate * G / (H + l2)
        else:
            grow(best[1], g, h, level + 1, out)
            grow(best[2], g, h, level + 1, out)

    for _ in range(rounds):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(margins)
        for c in range(classes):
            grow(np.arange(len(x)), p[:, c] - (y == c), np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16), 0, step[:, c])
        margins += step
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def table(spark, x, y):
    columns = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], [*columns, "label"]).repartition(3)
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(0, 1, (160, 3)), 1)
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(0, 0.3, 160), [0, 0.9])
    return x, y


@pytest.mark.parametrize("refresh,part_rows", [(16, 25_000), (16, 159), (2, 40)])
def test_trees_equal_brute_force(spark, data, monkeypatch, refresh, part_rows):
    x, y = data
    monkeypatch.setattr(B, "REFRESH", refresh)
    monkeypatch.setattr(B, "PART_ROWS", part_rows)
    df = table(spark, x, y)
    trees, gains = B.fit_trees(df, 3, rounds=5, depth=3)
    model = B.BoostedTrees.of(trees, gains, 3)
    found = {(r["x0"], r["x1"], r["x2"]): r["probabilities"] for r in model.transform(df).collect()}
    want = brute(x, y, 3, 5, 3)
    for row, p in zip(x, want):
        assert np.allclose(found[tuple(map(float, row))], p, atol=1e-9)
    assert len(trees) == 15 and model.featureImportances.toArray().sum() == pytest.approx(1)
    assert model.featureImportances.toArray().argmin() == 2


def test_levels_read_blocks_that_hold_all_older_rounds(spark, data, monkeypatch):
    """A table in one partition is spread, and no level walks the trees of older rounds: their margins are in the blocks."""
    monkeypatch.setattr(B, "PART_ROWS", 40)
    seen, cuts = [], B._cuts

    def watched(state, growing, level, width, classes, options):
        found = cuts(state, growing, level, width, classes, options)
        if level == 0:
            blocks = state.collect()
            seen.append((state.rdd.getNumPartitions(), sum(len(r["codes"]) for r in blocks), sum(np.abs(np.frombuffer(r["margins"])).sum() for r in blocks)))
        return found

    monkeypatch.setattr(B, "_cuts", watched)
    x, y = data
    B.fit_trees(table(spark, x, y).coalesce(1), 3, rounds=3, depth=2)
    assert len(seen) == 3 and all(parts > 1 and codes == x.size for parts, codes, _ in seen)
    assert 0 == seen[0][2] < seen[1][2] < seen[2][2]


def test_a_stored_pipeline_scores_alike(spark, data, tmp_path):
    df = table(spark, *data)
    model = B.BoostedTrees.of(*B.fit_trees(df, 3, rounds=3, depth=2), 3)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    first = model.transform(df).select("x0", "x1", "x2", "probabilities").collect()
    assert sorted(first) == sorted(again.transform(df).select("x0", "x1", "x2", "probabilities").collect())
    assert model.transform(df.limit(0)).count() == 0


def test_constant_features_and_many_values(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(3000), rng.random(3000)])
    y = (x[:, 1] > 0.731).astype(int)
    df = table(spark, x, y)
    trees, gains = B.fit_trees(df, 2, rounds=4, depth=6)
    assert gains[0] == 0 and all(len(v) == 64 for *_, v in trees)
    scored = B.BoostedTrees.of(trees, gains, 2).transform(df).collect()
    assert np.mean([(r["probabilities"][1] > 0.5) == r["label"] for r in scored]) > 0.99


def test_one_task_and_many_give_the_same_trees(spark, data, monkeypatch):
    monkeypatch.setattr(B, "PART_ROWS", 40)
    df = table(spark, *data)
    for settings in ({}, {"loss": "logistic", "l2": 0.0, "rate": 0.1, "depth": 3}):
        many, alone = (B.BoostedTrees.of(*B.fit_trees(df, 3, rounds=4, **settings, one_task=n), 3) for n in (None, 1000))
        a, b = ([r["probabilities"] for r in m.transform(df).orderBy("x0", "x1", "x2", "label").collect()] for m in (many, alone))
        assert np.allclose(a, b, atol=1e-9)


def test_logistic_loss_equals_sparks_boosting(spark, data):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    df = table(spark, *data)
    model = B.BoostedTrees.of(*B.fit_trees(df, 3, rounds=6, depth=3, rate=0.1, l2=0.0, loss="logistic"), 3, "logistic")
    order = ["x0", "x1", "x2", "label"]
    mine = np.array([r["margins"] for r in model.transform(df).orderBy(*order).collect()])
    for c in range(3):
        binary = df.withColumn("is", (F.col("label") == c).cast("double"))
        theirs = GBTClassifier(maxIter=6, maxDepth=3, stepSize=0.1, maxBins=256, labelCol="is").fit(binary).transform(binary)
        raw = theirs.orderBy(*order).select(vector_to_array("rawPrediction")[1].alias("m")).collect()
        assert np.corrcoef(mine[:, c], [r["m"] for r in raw])[0, 1] > 0.99
        assert np.mean((mine[:, c] > 0) == np.array([r["m"] > 0 for r in raw])) > 0.97
