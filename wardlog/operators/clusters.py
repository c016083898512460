"""Several k-means models at once, and silhouettes from plain distances.

All sizes k and all starting points are stepped together: one scan per iteration assigns every row to its nearest centre
in each model that still moves, and adds up counts, sums and costs per model and cluster. Tasks do that for whole Arrow
batches; Spark adds the tasks' sums, so the driver sees one row per model and cluster. Starting points are drawn by
distance (k-means++) from a sample of START_ROWS rows, spread evenly over the table, and come to rest on that sample, a model
a task, before the table is scanned until every model rests on all rows. Models of one size that meet on the sample are one from there.

A silhouette compares a row with all rows. It is taken for a sample of SAMPLE_ROWS rows against the whole table, block by
block, and has a standard error; where the table has no more rows than that, it is exact.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.operators.boosting import parts_of

# Workers get this module with the functions that run there, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

START_ROWS = 5_000
SAMPLE_ROWS = 2_000
ITERATIONS = 300
MOVED = 1e-4  # a model rests when no centre moves farther
BLOCK_ROWS = 2_048


@dataclass
class Centers:
    """A fitted model: its centres, rows per cluster, and the sum of squared distances to the nearest centre."""

    centers: np.ndarray
    counts: np.ndarray
    inertia: float

    def clusterCenters(self) -> list:
        return list(self.centers)

    def transform(self, df: DataFrame, features="features", output="cluster") -> DataFrame:
        at = vector_to_array(F.col(features))

        def distance(center):
            squares = F.zip_with(at, F.array(*[F.lit(float(v)) for v in center]), lambda a, b: (a - b) * (a - b))
            return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)

        distances = F.array(*[distance(c) for c in self.centers])
        return df.withColumn(output, (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def _points(batch) -> np.ndarray:
    values = batch.column(0)
    return values.flatten().to_numpy().reshape(len(values), -1)


def _blocks(batches):
    for batch in batches:
        points = _points(batch)
        for i in range(0, len(points), BLOCK_ROWS):
            yield points[i:i + BLOCK_ROWS]


def _nearest(points, centers) -> np.ndarray:
    return ((centers * centers).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)


def _vectors(ready: DataFrame, features="features") -> DataFrame:
    return ready.select(vector_to_array(F.col(features)).alias("x"))


def _sample(vectors: DataFrame, rows: int) -> np.ndarray:
    """At most so many rows, in the order of a hash of their place."""
    found = vectors.withColumn("at", F.xxhash64(F.monotonically_increasing_id())).orderBy("at").limit(rows).select("x").collect()
    return np.array([r["x"] for r in found], float)


def starting_points(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of the sample: each the best of a few drawn with a chance in proportion to the squared distance to those before."""
    rng = np.random.default_rng([seed, k])
    chosen = [sample[rng.integers(len(sample))]]
    nearest = ((sample - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = nearest.sum()
        tries = rng.integers(len(sample), size=1) if not total > 0 else rng.choice(len(sample), 2 + int(np.log(k)), p=nearest / total)
        after = [np.minimum(nearest, ((sample - sample[t]) ** 2).sum(axis=1)) for t in tries]
        best = int(np.argmin([a.sum() for a in after]))
        chosen.append(sample[tries[best]])
        nearest = after[best]
    return np.array(chosen)


def _lloyd(points, centers):
    """Centres at rest on these rows."""
    for _ in range(ITERATIONS):
        member = np.zeros((len(points), len(centers)))
        member[np.arange(len(points)), _nearest(points, centers)] = 1
        rows = member.sum(axis=0)[:, None]
        new = np.where(rows > 0, member.T @ points / np.maximum(rows, 1), centers)
        if np.allclose(new, centers, rtol=0, atol=1e-12):
            break
        centers = new
    return new


def settle(spark, sample: np.ndarray, models: dict) -> dict:
    """The models at rest on the sample, each in a task; those of one size that meet there get the very same centres."""
    names, width = list(models), sample.shape[1]
    starts = [models[n] for n in names]

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([_lloyd(sample, starts[i]).tobytes()], pa.binary())], names=["id", "centers"])

    found = spark.range(0, len(names), 1, len(names)).mapInArrow(run, "id long, centers binary").collect()  # one row per model
    out = {}
    for r in sorted(found, key=lambda r: r["id"]):
        name, centers = names[r["id"]], np.frombuffer(r["centers"]).reshape(-1, width)
        centers = centers[np.lexsort(np.round(centers, 6).T[::-1])]
        same = (c for n, c in out.items() if n[0] == name[0] and ((c - centers) ** 2).sum(axis=1).max() <= MOVED**2)
        out[name] = next(same, centers)
    return out


def packed(vectors: DataFrame) -> DataFrame:
    """Rows of an array as blocks of doubles in a binary field, spread over the cores."""
    def pack(batches):
        for points in _blocks(batches):
            if len(points):
                yield pa.RecordBatch.from_arrays([pa.array([points.tobytes()], pa.binary())], names=["points"])

    parts = parts_of(vectors.sparkSession, vectors.count())
    return (vectors.repartition(parts) if parts > 1 else vectors).mapInArrow(pack, "points binary")


def step(blocks: DataFrame, models: dict) -> dict:
    """One scan of packed rows: {name: (rows, sums, cost) per cluster} for {name: centres}. Equal centres are measured once.

    A cluster's cost follows from its rows, sums and squares, all taken from a common place among the centres.
    """
    kinds = {}
    for n, c in models.items():
        kinds.setdefault((c.shape, c.tobytes()), []).append(n)
    names, width = list(kinds.values()), next(iter(models.values())).shape[1]
    centers = [models[n[0]] for n in names]
    origin = centers[0][0]

    def run(batches):
        rows = [np.zeros(len(c), np.int64) for c in centers]
        moved, sums, squares = [c - origin for c in centers], [np.zeros(c.shape) for c in centers], [np.zeros(len(c)) for c in centers]
        for batch in batches:
            for block in batch.column(0).to_pylist():
                points = np.frombuffer(block).reshape(-1, width) - origin
                norms, at = (points * points).sum(axis=1), np.arange(len(points))
                for m, c in enumerate(moved):
                    own = _nearest(points, c)
                    rows[m] += np.bincount(own, minlength=len(c))
                    squares[m] += np.bincount(own, norms, len(c))
                    member = np.zeros((len(points), len(c)))
                    member[at, own] = 1
                    sums[m] += member.T @ points
        costs = [np.maximum(q - 2 * (c * s).sum(axis=1) + r * (c * c).sum(axis=1), 0) for q, c, s, r in zip(squares, moved, sums, rows)]
        sums = [s + r[:, None] * origin for s, r in zip(sums, rows)]
        size = [len(c) for c in centers]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(centers)), size), pa.int32()), pa.array(np.concatenate([np.arange(n) for n in size]), pa.int32()),
            pa.array(np.concatenate(rows)), pa.array(np.concatenate(costs)),
            pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(sums).ravel()), width).cast(pa.list_(pa.float64())),
        ], names=["model", "cluster", "rows", "cost", "sums"])

    parts = blocks.mapInArrow(run, "model int, cluster int, rows long, cost double, sums array<double>")
    found = parts.groupBy("model", "cluster").agg(
        F.sum("rows").alias("rows"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    out = {n: (np.zeros(len(c), np.int64), np.zeros(c.shape), np.zeros(len(c))) for n, c in models.items()}
    for r in found.collect():  # one row per model and cluster
        for name in names[r["model"]]:
            rows, sums, costs = out[name]
            rows[r["cluster"]], sums[r["cluster"]], costs[r["cluster"]] = r["rows"], r["sums"], r["cost"]
    return out


def fit_all(ready: DataFrame, ks, starts=3, seed=42, features="features") -> dict:
    """{k: Centers}: of several starting points the fit with the lowest inertia. `ready` is read for the sample, a count and
    the blocks that the scans read: pass a stored table. Clusters that end without a row are left out."""
    if not len(ks):
        return {}
    vectors = _vectors(ready, features)
    sample = _sample(vectors, START_ROWS)
    if not len(sample):
        raise ValueError("no rows to cluster")
    models = settle(ready.sparkSession, sample, {(k, s): starting_points(sample, k, seed + s) for k in ks for s in range(starts)})
    moving, blocks = dict(models), packed(vectors).persist()
    try:
        for _ in range(ITERATIONS):
            if not moving:
                break
            for name, (rows, sums, _) in step(blocks, moving).items():
                old = moving[name]
                new = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], old)
                models[name] = moving[name] = new
                if ((new - old) ** 2).sum(axis=1).max() <= MOVED**2:
                    del moving[name]
        best = {}
        for (k, _), (rows, _, costs), centers in ((n, f, models[n]) for n, f in step(blocks, models).items()):
            if k not in best or costs.sum() < best[k].inertia:
                best[k] = Centers(centers[rows > 0], rows[rows > 0], float(costs.sum()))
        return best
    finally:
        blocks.unpersist()


def silhouettes(ready: DataFrame, models: dict, sample_rows=SAMPLE_ROWS, features="features") -> dict:
    """{name: (mean silhouette, standard error)} of fitted models; 0 for a single cluster and for rows alone in theirs."""
    vectors = _vectors(ready, features)
    sample = _sample(vectors, sample_rows)
    names = [n for n in models if len(models[n].centers) > 1]
    out = {n: (0.0, 0.0) for n in models}
    if not names or not len(sample):
        return out
    centers = [models[n].centers for n in names]
    most = max(map(len, centers))

    def run(batches):
        sums = np.zeros((len(centers), len(sample), most))
        squares = (sample * sample).sum(axis=1)
        for points in _blocks(batches):
            far = np.sqrt(np.maximum(squares[:, None] + (points * points).sum(axis=1) - 2 * sample @ points.T, 0))
            near = np.argwhere(far < 1e-3 * np.sqrt(squares)[:, None] + 1e-6)  # where the difference of squares is not exact
            far[near[:, 0], near[:, 1]] = np.sqrt(((sample[near[:, 0]] - points[near[:, 1]]) ** 2).sum(axis=1))
            for m, c in enumerate(centers):
                member = np.zeros((len(points), most))
                member[np.arange(len(points)), _nearest(points, c)] = 1
                sums[m] += far @ member
        for m in range(len(centers)):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(sample), m), pa.int32()), pa.array(np.arange(len(sample)), pa.int32()),
                pa.FixedSizeListArray.from_arrays(pa.array(sums[m].ravel()), most).cast(pa.list_(pa.float64())),
            ], names=["model", "at", "sums"])

    found = vectors.mapInArrow(run, "model int, at int, sums array<double>").groupBy("model", "at").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(most)]).alias("sums"))
    sums = np.zeros((len(centers), len(sample), most))
    for r in found.collect():  # sample_rows for each model
        sums[r["model"], r["at"]] = r["sums"]
    for m, name in enumerate(names):
        counts, own = models[name].counts.astype(float), _nearest(sample, centers[m])
        each, at = sums[m][:, :len(counts)], np.arange(len(sample))
        inner = each[at, own] / np.maximum(counts[own] - 1, 1)
        means = each / counts
        means[at, own] = np.inf
        outer = means.min(axis=1)
        largest = np.maximum(inner, outer)
        score = np.where((counts[own] > 1) & (largest > 0), (outer - inner) / np.where(largest > 0, largest, 1), 0.0)
        left_out = 1 - len(sample) / max(counts.sum(), len(sample))
        out[name] = float(score.mean()), float(score.std() * np.sqrt(left_out / len(sample)))
    return out
