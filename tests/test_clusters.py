import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from wardlog.operators import clusters as C


def table(spark, points):
    columns = [f"x{i}" for i in range(points.shape[1])]
    df = spark.createDataFrame(points.tolist(), columns).repartition(5)
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df).select("features").persist()


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(4)
    return np.concatenate([rng.normal(at, 0.3 + 0.1 * i, (120, 3)) for i, at in enumerate([(0, 0, 0), (4, 0, 1), (0, 5, 0), (3, 4, 6)])])


def inertia(points, centers):
    return ((points[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()


def test_all_sizes_are_fitted_in_common_scans(spark, blobs, monkeypatch):
    scans, step = [], C.step
    monkeypatch.setattr(C, "step", lambda vectors, models: scans.append(len(models)) or step(vectors, models))
    ready = table(spark, blobs)
    models = C.fit_all(ready, range(2, 7), starts=3)
    assert scans[0] == scans[-1] == 15 and scans[:-1] == sorted(scans[:-1], reverse=True)
    for k, m in models.items():
        assert len(m.centers) == k and m.counts.sum() == len(blobs)
        assert m.inertia == pytest.approx(inertia(blobs, m.centers), rel=1e-6)
        own = ((blobs[:, None] - m.centers) ** 2).sum(axis=2).argmin(axis=1)
        assert np.allclose([blobs[own == c].mean(axis=0) for c in range(k)], m.centers, atol=1e-3)  # a fixed point
        assert m.transform(ready).groupBy("cluster").count().collect() and sorted(
            r["count"] for r in m.transform(ready).groupBy("cluster").count().collect()) == sorted(m.counts)
    assert models[4].inertia < 0.3 * models[3].inertia
    again = C.fit_all(ready, [4], starts=3)[4]
    assert np.allclose(again.centers, models[4].centers)


def plain_silhouette(points, centers):
    own = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
    far = np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(own):
        same = own == c
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = far[i, same].sum() / (same.sum() - 1)
        b = min(far[i, own == o].mean() for o in set(own) - {c})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def test_silhouettes_equal_brute_force(spark, blobs):
    points = np.concatenate([blobs, blobs[:40], [[50.0, 50.0, 50.0]]])  # repeated rows, and one alone in its cluster
    ready = table(spark, points)
    models = C.fit_all(ready, [2, 3, 5], starts=2)
    found = C.silhouettes(ready, models)
    for k, m in models.items():
        assert found[k][0] == pytest.approx(plain_silhouette(points, m.centers), abs=1e-9) and found[k][1] == 0
    some = C.silhouettes(ready, models, sample_rows=150)
    assert all(0 < some[k][1] < 0.1 and abs(some[k][0] - found[k][0]) < 5 * some[k][1] for k in models)


def test_few_different_rows(spark):
    ready = table(spark, np.array([[1.0, 2.0]] * 9 + [[3.0, 4.0]]))
    models = C.fit_all(ready, [2, 4])
    assert sorted(map(tuple, models[4].centers)) == [(1.0, 2.0), (3.0, 4.0)] and models[4].inertia == 0
    assert C.silhouettes(ready, models)[2][0] == pytest.approx(0.9)
    assert C.silhouettes(ready, {1: C.fit_all(ready, [1])[1]})[1] == (0.0, 0.0)
    with pytest.raises(ValueError, match="no rows"):
        C.fit_all(ready.limit(0), [2])


def test_models_that_meet_on_the_sample_are_scanned_once(spark, blobs):
    """Ten starts of one size on clear blobs end in few places, and rest there after few scans."""
    sample = blobs.copy()
    starts = {(4, s): C.starting_points(sample, 4, s) for s in range(10)}
    settled = C.settle(spark, sample, starts)
    assert list(settled) == list(starts) and len({c.tobytes() for c in settled.values()}) < 5
    found = C.step(C.packed(C._vectors(table(spark, blobs))), settled | {(2, 0): C.starting_points(sample, 2, 0)})
    for name, (rows, sums, costs) in found.items():
        centers = settled.get(name, C.starting_points(sample, 2, 0))
        assert rows.sum() == len(blobs) and costs.sum() == pytest.approx(inertia(blobs, centers), rel=1e-9)
        own = ((blobs[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        assert np.allclose([blobs[own == c].sum(axis=0) for c in range(len(centers))], sums)


def test_a_table_larger_than_the_sample_rests_on_all_rows(spark, blobs, monkeypatch):
    monkeypatch.setattr(C, "START_ROWS", 60)
    scans, step = [], C.step
    monkeypatch.setattr(C, "step", lambda blocks, models: scans.append(len({c.tobytes() for c in models.values()})) or step(blocks, models))
    found = C.fit_all(table(spark, blobs), [4], starts=10)[4]
    own = ((blobs[:, None] - found.centers) ** 2).sum(axis=2).argmin(axis=1)
    assert np.allclose([blobs[own == c].mean(axis=0) for c in range(4)], found.centers, atol=1e-3)
    assert found.inertia == pytest.approx(inertia(blobs, found.centers), rel=1e-9) and scans[0] < 10
