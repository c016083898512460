import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wardlog.operators import machines as MA
from wardlog.plans import learning as L

SIZE = 32


@pytest.fixture(scope="module")
def scaled(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (600, 2))
    y = np.digitize(x[:, 0] + x[:, 1] ** 2 + rng.normal(0, 0.4, 600), [0.3, 1.5])
    df = spark.createDataFrame([(*map(float, r), int(c), i % 3) for i, (r, c) in enumerate(zip(x, y))], "a double, b double, label int, fold int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("features", "label", "fold")


def fitted(scaled, iterations=100):
    return MA.fit_machines(scaled, 2, *L._kernel_weights(2, SIZE), [0, 1, 2], 600, iterations, 3)


def test_machines_minimise_the_same_loss(scaled):
    machines, curves = fitted(scaled)
    assert list(machines) == list(curves) == [(0, 1), (0, 2), (1, 2)] and all(slope > 0 for slope, _ in curves.values())
    rows = L.kernel_rows(scaled, 2, SIZE).select("kernel", "label")
    for (a, b), point in machines.items():
        own = rows.where(F.col("label").isin(a, b)).withColumn("is", (F.col("label") == b).cast("double"))
        theirs = LinearSVC(maxIter=100, regParam=1 / 600, standardization=False, featuresCol="kernel", labelCol="is").fit(own)
        x, sign = np.array([r["kernel"] for r in own.select("kernel").collect()]), np.array([2 * r["is"] - 1 for r in own.select("is").collect()])

        def loss(w, intercept):
            return np.maximum(0, 1 - sign * (x @ w + intercept)).mean() + w @ w / 1200

        assert loss(point[:-1], point[-1]) < 1.02 * loss(theirs.coefficients.toArray(), theirs.intercept) + 1e-3


def test_no_kernel_features_are_stored_and_passes_serve_all_machines(scaled, monkeypatch):
    seen, summed = [], MA._summed

    def watched(state, sums):
        seen.append(sum(len(v) for r in state.collect() for v in r))
        return summed(state, sums)

    monkeypatch.setattr(MA, "_summed", watched)
    fitted(scaled, iterations=5)
    assert max(seen) <= 600 * 4 * (2 + 2)  # two features, label and fold of four bytes each; kernel features would be 600 * 4 * SIZE
    assert len(seen) < 12 * 5  # twelve machines of five iterations


def test_a_fold_that_holds_a_class_is_not_left_out(scaled):
    machines, curves = MA.fit_machines(scaled.where("label < 2").withColumn("fold", F.col("label")), 2, *L._kernel_weights(2, SIZE), [0, 1], 400, 20, 3)
    assert list(machines) == [(0, 1)] and np.isfinite(machines[0, 1]).all() and np.isfinite(curves[0, 1]).all()
