"""Random forests whose trees are grown in tasks and kept as small arrays.

On noisy features a fully grown tree has a node or so per row; as objects of the driver, a hundred of them fill its memory. Here a node
takes six bytes. Rows are cut into bins first; each group of trees gets a copy of the bins, so trees grow side by side and no level of
theirs is a job. A tree is grown level by level: every open node draws its features and takes the cut with the largest fall of
the Gini impurity, from counts per bin where nodes are few, else from its sorted rows.
"""

import base64
import json
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.operators.boosting import quantile_edges

BINS = 64
LEAST_FALL = 1e-9  # of the impurity, per row


class _Tasks:
    """What runs in tasks; it is handed to workers by value."""

    @staticmethod
    def coded(x, edges):
        return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)

    @staticmethod
    def score(left, whole):
        """Squared counts over counts, of both sides together; larger is purer."""
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            return (left**2).sum(axis=-1) / left.sum(axis=-1) + (right**2).sum(axis=-1) / right.sum(axis=-1)

    @staticmethod
    def by_counts(node, code, label, weight, counts, bins):
        """Best score and cut per node, from counts per bin."""
        nodes, classes = counts.shape
        left = np.bincount((node * bins + code) * classes + label, weight, nodes * bins * classes).reshape(nodes, bins, classes).cumsum(axis=1)
        score = np.nan_to_num(_Tasks.score(left, counts[:, None]), nan=-1.0)  # an empty side
        cut = score.argmax(axis=1)
        return score[np.arange(nodes), cut], cut

    @staticmethod
    def by_rows(node, code, label, weight, counts, bins):
        """The same from sorted rows, whatever the number of nodes."""
        nodes, classes = counts.shape
        order = np.argsort(node * bins + code, kind="stable")
        node, code, held = node[order], code[order], np.zeros((len(order), classes))
        held[np.arange(len(order)), label[order]] = weight[order]
        held = held.cumsum(axis=0)
        before = np.vstack([np.zeros(classes), counts.cumsum(axis=0)[:-1]])
        at = np.flatnonzero((node[1:] == node[:-1]) & (code[1:] != code[:-1]))
        best, cut = np.full(nodes, -1.0), np.zeros(nodes, np.int64)
        if len(at):
            own = node[at]
            score = _Tasks.score(held[at] - before[own], counts[own])
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            best[own[first]] = np.maximum.reduceat(score, first)
            hit = np.flatnonzero(score == best[own])[::-1]
            cut[own[hit]] = code[at[hit]]  # the first of equal ones is written last
        return best, cut

    @staticmethod
    def grow(x, label, classes, bins, depth, tries, seed):
        """Arrays of a tree: feature, cut, child (the left one; the right one follows; -1 - number of the leaf), chances of leaves, falls per feature."""
        random = np.random.default_rng(seed)
        weight = random.poisson(1.0, len(x)).astype(np.float64)
        rows = np.flatnonzero(weight) if weight.any() else np.arange(len(x))
        weight = weight[rows] if weight.any() else np.ones(len(x))
        label, node, flat, width = label[rows].astype(np.int64), np.zeros(len(rows), np.int64), x.ravel(), x.shape[1]
        feature, cut, child, leaves, falls = [], [], [], [], np.zeros(width)
        nodes, made, known = 1, 1, 0
        for level in range(depth + 1):
            counts = np.bincount(node * classes + label, weight, nodes * classes).reshape(nodes, classes)
            total = counts.sum(axis=1)
            best, own_feature, own_cut = (counts**2).sum(axis=1) / total + LEAST_FALL * total, np.full(nodes, -1), np.zeros(nodes, np.int64)
            if level < depth:
                start, drawn = best.copy(), random.random((nodes, width)).argpartition(tries - 1, axis=1)[:, :tries]
                search = _Tasks.by_counts if nodes * bins <= len(rows) else _Tasks.by_rows
                for f in drawn.T:
                    score, at = search(node, flat[rows * width + f[node]].astype(np.int64), label, weight, counts, bins)
                    better = score > best
                    best[better], own_feature[better], own_cut[better] = score[better], f[better], at[better]
                np.add.at(falls, own_feature[own_feature >= 0], (best - start)[own_feature >= 0])
            inner = own_feature >= 0
            down = np.full(nodes, -1)
            down[inner] = 2 * np.arange(inner.sum())
            end = np.flatnonzero(~inner)
            leaves.append(counts[end] / total[end, None])
            links = made + down
            links[end] = -1 - known - np.arange(len(end))
            feature.append(np.maximum(own_feature, 0)), cut.append(own_cut), child.append(links)
            known, made = known + len(end), made + 2 * int(inner.sum())
            if not inner.any():
                break
            kept = inner[node]
            rows, node, label, weight = rows[kept], node[kept], label[kept], weight[kept]
            node = down[node] + (flat[rows * width + own_feature[node]] > own_cut[node])
            nodes = 2 * int(inner.sum())
        chances = np.concatenate(leaves)
        values, place = np.unique(chances, axis=0, return_inverse=True)  # most leaves hold one class
        links = np.concatenate(child)
        end = links < 0
        links[end] = -1 - place.ravel()[-1 - links[end]]
        return (np.concatenate(feature).astype(np.uint8 if width < 256 else np.int32), np.concatenate(cut).astype(np.uint8),
                links.astype(np.int32), values.astype(np.float32), falls / falls.sum() if falls.sum() else falls)

    @staticmethod
    def chances(codes, trees, classes):
        """Mean of the trees' chances per row of bins."""
        total, flat, start = np.zeros((len(codes), classes)), codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        for feature, cut, child, values, _ in trees:
            at = np.zeros(len(codes), np.int64)
            under = np.flatnonzero(child[at] >= 0)
            while len(under):
                here = at[under]
                at[under] = child[here] + (flat[start[under] + feature[here]] > cut[here])
                under = under[child[at[under]] >= 0]
            total += values[-1 - child[at]]
        return total / len(trees)


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_forest(ready: DataFrame, classes: int, trees=100, depth=30, seed=42) -> "Forest":
    """A forest of rows (features, label from 0 to classes - 1). Every group of trees holds all bins, a byte for each value."""
    vectors = ready.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"))
    width = vectors.agg(F.max(F.size("x"))).first()[0]
    edges, tasks, bins = quantile_edges(vectors, width, BINS), _Tasks, BINS
    groups = max(1, min(trees, 2 * ready.sparkSession.sparkContext.defaultParallelism))
    tries = int(np.ceil(np.sqrt(width)))

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                codes, label = tasks.coded(_matrix(batch.column(0)), edges), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (codes, label)], names=["codes", "label"])

    def grown(found: pa.Table) -> pa.Table:
        x = np.concatenate([np.frombuffer(c.as_buffer(), np.uint8).reshape(-1, width) for c in found["codes"]])
        label = np.concatenate([np.frombuffer(c.as_buffer(), np.int32) for c in found["label"]])
        order = np.lexsort((label, *x.T[::-1]))  # blocks may arrive in any order
        x, label, group = np.ascontiguousarray(x[order]), label[order], found["group"][0].as_py()
        own = [pickle.dumps(tasks.grow(x, label, classes, bins, depth, tries, [seed, t])) for t in range(group, trees, groups)]
        return pa.table([pa.array(range(group, trees, groups), pa.int32()), pa.array(own, pa.binary())], names=["tree", "arrays"])

    blocks = vectors.mapInArrow(coded, "codes binary, label binary")
    copies = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = copies.repartitionByRange(groups, "group").groupBy("group").applyInArrow(grown, "tree int, arrays binary").collect()
    return Forest.of([bytes(r["arrays"]) for r in sorted(found)], edges, classes)


class Forest(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `probabilities`, one per class, to rows with `features`. The trees are a parameter, stored with the pipeline."""

    model = Param(Params._dummy(), "model", "edges of bins as JSON and arrays of trees as base64")

    @keyword_only
    def __init__(self, *, model=None):
        super().__init__()
        if model is not None:
            self._set(model=model)

    @classmethod
    def of(cls, trees: list, edges: list, classes: int) -> "Forest":
        return cls(model=json.dumps({"classes": classes, "edges": [e.tolist() for e in edges], "trees": [base64.b64encode(t).decode() for t in trees]}))

    def _parts(self) -> tuple:
        spec = json.loads(self.getOrDefault(self.model))
        return [pickle.loads(base64.b64decode(t)) for t in spec["trees"]], [np.array(e) for e in spec["edges"]], spec["classes"]

    @property
    def totalNumNodes(self):
        return sum(len(child) for _, _, child, *_ in self._parts()[0])

    @property
    def featureImportances(self):
        return Vectors.dense(np.mean([falls for *_, falls in self._parts()[0]], axis=0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        (trees, edges, classes), tasks = self._parts(), _Tasks

        @F.arrow_udf("array<double>")
        def chances(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            found = tasks.chances(tasks.coded(_matrix(x), edges), trees, classes)
            return pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), classes).cast(pa.list_(pa.float64()))

        return dataset.withColumn("probabilities", chances(vector_to_array("features")))
