"""Boosted trees of several classes: one joint softmax by second-order steps, or a logistic loss of each class against the rest.

Every round grows one tree per class: on gradients p - y and Hessians 2 p (1 - p) of the softmax loss, or on residuals of the logistic
loss log(1 + exp(-2 y F)) with Hessians of 1 (Friedman, 1999; the first round takes the labels y of -1 and 1). Features are cut into at most
BINS ranges at quantiles. A level of all the trees of a round is one job: tasks add up gradients and Hessians per class,
node, feature and bin over blocks of rows, Spark brings the sums of a node together and picks the cut with the largest gain

    (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2 - gamma,

and only those cuts come to the driver. A block holds bins, labels and the margins of all rounds before as arrays in binary fields, so
no tree is walked twice: each round's blocks are cached by its first level, and every REFRESH rounds they are stored.
"""

import json
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.session import materialize

BINS = 256
REFRESH = 16
PART_ROWS = 25_000  # rows of a task, at least
LEAST_GAIN = 1e-6


class _Tasks:
    """What runs in tasks; it is handed to workers by value."""

    @staticmethod
    def below(x, feature, limit, steps, alive=None):
        """Heap position of every row after some steps, and whether all nodes on its way were cut."""
        at, rows, open_way = np.zeros(len(x), np.int64), np.arange(len(x)), np.ones(len(x), bool)
        for _ in range(steps):
            if alive is not None:
                open_way &= alive[at]
            at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
        return at, open_way

    @staticmethod
    def add(margins, x, trees, depth):
        for c, feature, limit, value in trees:
            margins[:, c] += value[_Tasks.below(x, feature, limit, depth)[0] - (len(value) - 1)]
        return margins

    @staticmethod
    def gradients(margins, label, loss="softmax", first=False):
        if loss == "logistic":
            sign = np.full(margins.shape, -1.0)
            sign[np.arange(len(label)), label] = 1
            return -sign if first else -4 * sign / (1 + np.exp(np.minimum(2 * sign * margins, 700))), np.ones(margins.shape)
        p = _Tasks.softmax(margins)
        g = p.copy()
        g[np.arange(len(label)), label] -= 1
        return g, np.maximum(2 * p * (1 - p), 1e-16)

    @staticmethod
    def softmax(margins):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    @staticmethod
    def placed(x, tree, level, places):
        """Rows on an open way at a level, and their heap positions; `places` has those of the level before, by class."""
        c, feature, limit, alive = tree
        if level == 0 or c not in places:
            at, way = _Tasks.below(x, feature, limit, level, alive)
            rows = np.flatnonzero(way)
            places[c] = rows, at[rows]
        else:
            rows, at = places[c]
            way = alive[at]
            rows, at = rows[way], at[way]
            places[c] = rows, 2 * at + 1 + (x.ravel()[rows * x.shape[1] + feature[at]] > limit[at])
        return places[c]

    @staticmethod
    def sums(x, g, h, open_trees, level, bins, places=None, columns=None):
        """G and H (first axis 1) per tree, node of the level, feature and bin."""
        first, nodes, width = (1 << level) - 1, 1 << level, x.shape[1]
        held = np.zeros((len(open_trees), 2, nodes, width, bins))
        columns = np.ascontiguousarray(x.T).astype(np.int64) if columns is None else columns
        for i, tree in enumerate(open_trees):
            rows, at = _Tasks.placed(x, tree, level, {} if places is None else places)
            whole, c = len(rows) == len(x), tree[0]
            node, own = (at - first) * bins, ((g[:, c].copy(), h[:, c].copy()) if whole else (g[rows, c], h[rows, c]))
            for f, codes in enumerate(columns):
                key = node + (codes if whole else codes[rows])
                for s, value in enumerate(own):
                    held[i, s, :, f] = np.bincount(key, value, nodes * bins).reshape(nodes, bins)
        return held

    @staticmethod
    def nodes(held, open_trees, level):
        """Class, node and its sums, of the nodes that have rows."""
        for i, (c, *_) in enumerate(open_trees):
            for node in np.flatnonzero(held[i, 1, :, 0].sum(axis=1) > 0):
                yield c, int(node) + (1 << level) - 1, held[i, :, node]

    @staticmethod
    def best_cut(grid, l2, gamma, least_child):
        """Of one node, from its sums G and H per feature and bin: feature (-1 if no cut pays), bin, gain, G and H of the left side and of all."""
        all_g, all_h = grid[:, 0].sum(axis=1)
        left_g, left_h = grid.cumsum(axis=2)
        right_g, right_h = all_g - left_g, all_h - left_h
        with np.errstate(divide="ignore", invalid="ignore"):  # an empty side without l2
            gain = (left_g**2 / (left_h + l2) + right_g**2 / (np.maximum(right_h, 0) + l2) - all_g**2 / (all_h + l2)) / 2 - gamma
        gain[(left_h < least_child) | (right_h < least_child)] = -np.inf
        at = np.unravel_index(gain.argmax(), gain.shape)
        if not gain[at] > LEAST_GAIN:
            return -1, 0, 0.0, 0.0, 0.0, float(all_g), float(all_h)
        return int(at[0]), int(at[1]), float(gain[at]), float(left_g[at]), float(left_h[at]), float(all_g), float(all_h)

    @staticmethod
    def blocks(batches, width, classes):
        """(codes, labels, margins) of each stored block."""
        for batch in batches:
            for codes, label, margins in zip(*(c.to_pylist() for c in batch.columns)):
                yield (np.frombuffer(codes, np.uint8).reshape(-1, width), np.frombuffer(label, np.int32),
                       np.frombuffer(margins).reshape(-1, classes))

    @staticmethod
    def block(codes, label, margins):
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (codes, label, margins)],
                                          names=["codes", "label", "margins"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Growing:
    """A tree of one class in heap order while its levels are cut. Nodes that are no cut send every row to the left."""

    def __init__(self, depth: int, width: int):
        inner = (1 << depth) - 1
        self.depth, self.feature, self.limit = depth, np.zeros(inner, np.int64), np.full(inner, np.iinfo(np.int16).max, np.int64)
        self.alive, self.sums, self.gains = np.zeros(inner, bool), np.zeros((2 * inner + 1, 2)), np.zeros(width)

    def cut(self, node, found):
        if found["feature"] >= 0:
            self.alive[node], self.feature[node], self.limit[node] = True, found["feature"], found["bin"]
            left, whole = np.array([found["left_g"], found["left_h"]]), np.array([found["g"], found["h"]])
            self.sums[2 * node + 1], self.sums[2 * node + 2] = left, whole - left
            self.gains[found["feature"]] += found["gain"]
        if node == 0:
            self.sums[0] = found["g"], found["h"]

    def leaves(self, l2, rate) -> np.ndarray:
        value, inner = np.zeros(len(self.alive) + 1), len(self.alive)
        for node in range(len(self.sums)):
            if (node == 0 or self.alive[(node - 1) // 2]) and (node >= inner or not self.alive[node]):
                at = node
                while at < inner:
                    at = 2 * at + 1
                value[at - inner] = -rate * self.sums[node, 0] / (self.sums[node, 1] + l2)
        return value


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, values.shape[1]).cast(pa.list_(flat.type))


def quantile_edges(vectors: DataFrame, width: int, bins=BINS) -> list[np.ndarray]:
    """Upper ends of all bins but the last, per feature: approximate quantiles, so every different value if there are few."""
    shares = [i / bins for i in range(1, bins + 1)]
    row = vectors.agg(*[F.percentile_approx(F.col("x")[i], shares, 100 * bins).alias(str(i)) for i in range(width)]).first()
    return [np.unique(np.array(row[str(i)]))[:-1] for i in range(width)]


STATE = "codes binary, label binary, margins binary"  # a block of rows in each row
CUT = ["class", "node", "feature", "bin", "gain", "left_g", "left_h", "g", "h"]


def _open(growing: list, level: int) -> list:
    return [(c, t.feature, t.limit, t.alive) for c, t in enumerate(growing) if level == 0 or t.alive.any()]


def _cuts(state: DataFrame, growing: list, level: int, width: int, classes: int, options) -> list:
    """The best cut of every node of a level that has rows, of all classes."""
    open_trees, tasks, bins = _open(growing, level), _Tasks, BINS

    def sums(batches):
        held = 0
        for x, label, margins in tasks.blocks(batches, width, classes):
            held = held + tasks.sums(x, *tasks.gradients(margins, label, *options[3:]), open_trees, level, bins)
        if isinstance(held, np.ndarray):
            for c, node, grid in tasks.nodes(held, open_trees, level):
                flat = grid.reshape(2, -1)
                key = np.flatnonzero(flat[1])
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([node], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  pa.array([key.astype(np.int32).tobytes()], pa.binary()), pa.array([flat[:, key].tobytes()], pa.binary())],
                                                 names=["class", "node", "task", "key", "sums"])

    def best(found: pa.Table) -> pa.Table:
        grid = np.zeros((2, width * bins))
        for row in found.sort_by("task").to_pylist():  # one row per task
            grid[:, np.frombuffer(row["key"], np.int32)] += np.frombuffer(row["sums"]).reshape(2, -1)
        cut = tasks.best_cut(grid.reshape(2, width, bins), *options[:3])
        row = (found["class"][0].as_py(), found["node"][0].as_py(), *cut)
        return pa.table([pa.array([v], pa.int32() if i < 4 else pa.float64()) for i, v in enumerate(row)], names=CUT)

    parts = state.mapInArrow(sums, "class int, node int, task int, key binary, sums binary")
    kinds = ", ".join(f"{n} {'int' if i < 4 else 'double'}" for i, n in enumerate(CUT))
    return [r.asDict() for r in parts.groupBy("class", "node").applyInArrow(best, kinds).collect()]  # one row per class and node


def _round(classes: int, depth: int, width: int, l2: float, rate: float, cuts_of) -> tuple[list, np.ndarray]:
    """One tree per class, cut level by level; cuts_of(trees, level) finds the cuts."""
    growing = [Growing(depth, width) for _ in range(classes)]
    for level in range(depth):
        cuts = cuts_of(growing, level)
        for r in cuts:
            growing[r["class"]].cut(r["node"], r)
        if not any(r["feature"] >= 0 for r in cuts):
            break
    return [(c, t.feature, t.limit, t.leaves(l2, rate)) for c, t in enumerate(growing)], sum(t.gains for t in growing)


def _in_one_task(state: DataFrame, classes: int, width: int, rounds: int, depth: int, rate: float, options) -> list:
    """All rounds on rows that fit one task, whose sums are the whole sums: the same cuts without a job per level."""
    tasks, bins = _Tasks, BINS

    def grow(batches):
        x, label = (np.concatenate(p) for p in list(zip(*tasks.blocks(batches, width, classes)))[:2])
        margins, out, columns = np.zeros((len(x), classes)), [], np.ascontiguousarray(x.T).astype(np.int64)
        for turn in range(rounds):
            step, (g, h), places = _turn(options, rate, turn)[0], tasks.gradients(margins, label, *_turn(options, rate, turn)[1][3:]), {}

            def cuts_of(growing, level):
                open_trees = _open(growing, level)
                for c, node, grid in tasks.nodes(tasks.sums(x, g, h, open_trees, level, bins, places, columns), open_trees, level):
                    yield dict(zip(CUT, (c, node, *tasks.best_cut(grid, *options[:3]))))

            grown, gains = _round(classes, depth, width, options[0], step, lambda *at: list(cuts_of(*at)))
            tasks.add(margins, x, grown, depth)
            out.append((grown, gains))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], names=["rounds"])

    return pickle.loads(state.mapInArrow(grow, "rounds binary").first()["rounds"])


def _turn(options, rate: float, turn: int) -> tuple:
    """Step and options of a round. Of the logistic loss, the first takes the labels in full."""
    first = turn == 0 and options[3] == "logistic"
    return 1.0 if first else rate, (*options[:4], first)


def parts_of(spark, n: int) -> int:
    """Tasks of a level: two per core, none under PART_ROWS rows or over a million."""
    return max(1, min(n // PART_ROWS, 2 * spark.sparkContext.defaultParallelism), n // 1_000_000)


def fit_trees(ready: DataFrame, classes: int, rounds=100, depth=6, rate=0.3, l2=1.0, gamma=0.0, least_child=1.0, one_task=None, loss="softmax") -> tuple[list, np.ndarray]:
    """Trees (class, feature, limit, value) in the order of rounds, and the gain of each feature, from `features` and a
    `label` from 0 to classes - 1. Up to `one_task` rows (PART_ROWS if not given) are one task's work; the trees are the same either way."""
    vectors = ready.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"))
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    spark = ready.sparkSession
    edges = quantile_edges(vectors, width)
    options, tasks = (l2, gamma, least_child, loss), _Tasks

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                codes = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)
                yield tasks.block(codes, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32), np.zeros((len(x), classes)))

    def stored(rows):
        return materialize(rows).coalesce(1 if alone else parts_of(spark, n)).persist()

    def at_values(grown):
        return [(c, f, np.array([edges[i][b] if b < len(edges[i]) else np.inf for i, b in zip(f, limit)]), v) for c, f, limit, v in grown]

    def advanced(state, grown):
        def add(batches):
            for x, label, margins in tasks.blocks(batches, width, classes):
                yield tasks.block(x, label, tasks.add(margins.copy(), x, grown, depth))

        return state.mapInArrow(add, STATE)

    alone = n <= (one_task or PART_ROWS)
    even = vectors if alone else vectors.repartition(parts_of(spark, n))
    state, trees, gains = stored(even.mapInArrow(coded, STATE)), [], np.zeros(width)
    held = [state]
    try:
        if alone:
            for grown, own in _in_one_task(state, classes, width, rounds, depth, rate, options):
                trees, gains = trees + at_values(grown), gains + own
            return trees, gains
        for turn in range(rounds):
            step, now = _turn(options, rate, turn)
            grown, own = _round(classes, depth, width, l2, step, lambda growing, level: _cuts(state, growing, level, width, classes, now))
            trees, gains = trees + at_values(grown), gains + own
            if turn + 1 < rounds:
                # The first level of the next round fills the cache; older rounds' blocks are needed until then.
                state = stored(advanced(state, grown)) if (turn + 1) % REFRESH == 0 else advanced(state, grown).persist()
                held.append(state)
                for old in held[:-2]:
                    old.unpersist()
                held = held[-2:]
    finally:
        for old in held:
            old.unpersist()
    return trees, gains


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `probabilities`, or `margins` after a logistic loss, one per class, to rows with `features`. The trees are a parameter,
    stored with the pipeline."""

    model = Param(Params._dummy(), "model", "trees and gains as JSON")

    @keyword_only
    def __init__(self, *, model=None):
        super().__init__()
        if model is not None:
            self._set(model=model)

    @classmethod
    def of(cls, trees: list, gains: np.ndarray, classes: int, loss="softmax") -> "BoostedTrees":
        parts = [[c, f.tolist(), [v if np.isfinite(v) else None for v in limit.tolist()], value.tolist()] for c, f, limit, value in trees]
        return cls(model=json.dumps({"classes": classes, "trees": parts, "gains": gains.tolist(), "loss": loss}))

    @property
    def featureImportances(self):
        gains = np.array(json.loads(self.getOrDefault(self.model))["gains"])
        return Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spec, tasks = json.loads(self.getOrDefault(self.model)), _Tasks
        trees = [(c, np.array(f), np.array([np.inf if v is None else v for v in limit]), np.array(value)) for c, f, limit, value in spec["trees"]]
        classes, joint = spec["classes"], spec.get("loss", "softmax") == "softmax"

        @F.arrow_udf("array<double>")
        def chances(x: pa.Array) -> pa.Array:
            x = _matrix(x)
            margins = np.zeros((len(x), classes))
            if len(x) and trees:
                tasks.add(margins, x, trees, len(trees[0][3]).bit_length() - 1)
            return _lists(tasks.softmax(margins) if joint else margins) if len(x) else pa.array([], pa.list_(pa.float64()))

        return dataset.withColumn("probabilities" if joint else "margins", chances(vector_to_array("features")))
