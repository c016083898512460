"""Linear machines with hinge loss on random kernel features, trained together.

Rows are kept as blocks of scaled features; kernel features are made from them anew in every pass, a slice at a time, so nothing of their
width is stored. One job gives losses and gradients of all machines at their present points; L-BFGS moves each of them on the driver,
which sees one row of sums per task.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.operators.boosting import parts_of

SLICE = 4096  # rows whose kernel features are in memory at once
STEPS = (2.0, 1.0, 0.5, 0.2)
STATE = "x binary, label binary, fold binary"  # a block of rows in each row


class _Tasks:
    """What runs in tasks; it is handed to workers by value."""

    @staticmethod
    def blocks(batches, width):
        """(features, labels, folds) of slices of each stored block."""
        for batch in batches:
            for x, label, fold in zip(*(c.to_pylist() for c in batch.columns)):
                x, label, fold = np.frombuffer(x, np.float32).reshape(-1, width), np.frombuffer(label, np.int32), np.frombuffer(fold, np.int32)
                for at in range(0, len(x), SLICE):
                    yield x[at:at + SLICE], label[at:at + SLICE], fold[at:at + SLICE]

    @staticmethod
    def kernel(x, weights, shifts):
        """Features of each row, and a 1 for the intercept."""
        out = np.ones((len(x), len(shifts) + 1), x.dtype)
        np.cos(x @ weights.T + shifts, out=out[:, :-1])
        out[:, :-1] *= np.sqrt(2.0 / len(shifts))
        return out

    @staticmethod
    def hinge(kernel, label, fold, machines, points):
        """Per machine (a, b, fold left out) and point tried: the gradient's sum, and the loss's sum last."""
        sign = np.stack([np.where(fold == f, 0, (label == b).astype(np.int8) - (label == a)) for a, b, f in machines], axis=1).astype(kernel.dtype)[:, :, None]
        slack = 1 - sign * (kernel @ points.reshape(-1, points.shape[2]).T).reshape(len(label), *points.shape[:2])
        push = np.where(slack > 0, sign, 0)
        gradient = -(push.reshape(len(label), -1).T @ kernel).astype(np.float64)
        return np.column_stack([gradient, (slack * (push != 0)).sum(axis=0, dtype=np.float64).ravel()])

    @staticmethod
    def logistic(margin, is_second, point):
        """Loss, gradient (2) and Hessian (3) sums of a curve over margins."""
        z = margin * point[0] + point[1]
        p = 1 / (1 + np.exp(-np.abs(z)))
        loss, residual, weight = np.logaddexp(0, z) - is_second * z, np.where(z > 0, p, 1 - p) - is_second, p * (1 - p)
        return [loss.sum(), residual @ margin, residual.sum(), weight @ margin**2, weight @ margin, weight.sum()]


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def descend(start, iterations, tolerance=1e-6, memory=10):
    """L-BFGS on a convex function as a coroutine: yields an array of STEPS points, takes (value, gradient) of each, returns the last point.

    A pass over the rows costs more than a few more points in it, so the steps of a line search are tried at once.
    """
    point = start
    value, gradient = (yield np.stack([point] * len(STEPS)))[0]
    past, values = [], [value]
    for _ in range(iterations):
        if np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
        direction, kept = -gradient, []
        for s, y in reversed(past):
            kept.append((s @ direction) / (s @ y))
            direction = direction - kept[-1] * y
        if past:
            s, y = past[-1]
            direction = direction * ((s @ y) / (y @ y))
        else:
            direction = direction / np.linalg.norm(gradient)
        for (s, y), a in zip(past, reversed(kept)):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        steps = np.array(STEPS)
        for _ in range(4):
            answers = yield point + steps[:, None] * direction
            best = min(range(len(steps)), key=lambda i: answers[i][0])
            if answers[best][0] < value:
                break
            steps = steps / 20
        else:
            if not past:
                break
            past = []  # once more, along the gradient
            continue
        s, y = steps[best] * direction, answers[best][1] - gradient
        if s @ y > 1e-12 * (y @ y) > 0:
            past = [*past, (s, y)][-memory:]
        point, (value, gradient) = point + s, answers[best]
        values.append(value)
        if len(values) > memory and values[-memory - 1] - value <= tolerance * values[0]:
            break
    return point


def newton(iterations=100, tolerance=1e-10):
    """Two numbers, as a coroutine: yields points, takes (value, gradient, Hessian), returns the last point."""
    point = np.zeros(2)
    value, gradient, hessian = yield point
    for _ in range(iterations):
        move = -np.linalg.lstsq(hessian, gradient, rcond=1e-15)[0]
        if not gradient @ move < -tolerance:
            break
        for _ in range(20):
            found = yield point + move
            if found[0] < value:
                break
            move = move / 2
        else:
            break
        point, (value, gradient, hessian) = point + move, found
    return point


def together(machines: dict, evaluate) -> dict:
    """Runs coroutines side by side; evaluate({name: point}) answers all that are still under way."""
    points, done = {name: next(m) for name, m in machines.items()}, {}
    while points:
        answers = evaluate(points)
        for name, answer in answers.items():
            try:
                points[name] = machines[name].send(answer)
            except StopIteration as end:
                done[name] = end.value
                del points[name]
    return done


def _summed(state: DataFrame, sums) -> np.ndarray:
    """The total over tasks of what sums(batches) gives; one row per task comes to the driver."""
    def packed(batches):
        total = sums(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total, np.float64).tobytes()], pa.binary())], names=["sums"])

    return sum(np.frombuffer(r["sums"]) for r in state.mapInArrow(packed, "sums binary").collect())


def _of_all(parts):
    """Sum of the arrays of an iterator; None without any."""
    total = None
    for part in parts:
        total = part if total is None else total + part
    return total


def fit_machines(scaled: DataFrame, width: int, weights, shifts, classes, n: int, iterations: int, folds: int) -> tuple[dict, dict]:
    """One machine for each pair of classes, from rows (features, label, fold).

    Returns {(a, b): weights and intercept} and {(a, b): (slope, intercept)}. The logistic curve turns margins into chances; it is fitted
    to margins of rows that the machine has not seen: those of each fold come from a machine of the other folds.
    """
    tasks, pairs = _Tasks, [(a, b) for i, a in enumerate(classes) for b in classes[i + 1:]]
    frame, shift = weights.astype(np.float32), shifts.astype(np.float32)
    cores, parts = scaled.sparkSession.sparkContext.defaultParallelism, parts_of(scaled.sparkSession, n)
    if cores < parts < 2 * cores:  # a second wave of tasks would leave most cores idle
        parts = cores

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                others = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int32) for c in ("label", "fold")]
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, *others)], names=["x", "label", "fold"])

    plain = scaled.select(vector_to_array("features").alias("x"), "label", "fold")
    state = (plain.repartition(parts) if parts > 1 else plain).mapInArrow(pack, STATE).persist()
    held = None
    try:
        def counted(batches):
            return _of_all(np.array([np.bincount(f[y == c], minlength=folds) for c in classes]) for _, y, f in tasks.blocks(batches, width))

        rows = dict(zip(classes, _summed(state, counted).reshape(len(classes), folds)))

        def is_left_out(a, b, f):
            """Whether rows of both classes remain without the fold."""
            return all(rows[c].sum() > rows[c][f] for c in (a, b))

        machines = {(a, b, f): sum(rows[c].sum() - (rows[c][f] if f >= 0 else 0) for c in (a, b)) for a, b in pairs
                    for f in (-1, *(f for f in range(folds) if is_left_out(a, b, f)))}

        def losses(points):
            """Values and gradients of the mean loss with the penalty |w|^2 / 2n at the points of each machine under way."""
            names, at = list(points), np.stack(list(points.values())).astype(np.float32)

            def sums(batches):
                return _of_all(tasks.hinge(tasks.kernel(x, frame, shift), y, f, names, at) for x, y, f in tasks.blocks(batches, width))

            out = {}
            for name, tried, found in zip(names, points.values(), _summed(state, sums).reshape(len(names), len(STEPS), -1)):
                free = tried * [*[1.0] * len(shifts), 0.0]
                values = found[:, -1] / machines[name] + (free**2).sum(axis=1) / (2 * n)
                out[name] = list(zip(values, found[:, :-1] / machines[name] + free / n))
            return out

        best = together({m: descend(np.zeros(len(shifts) + 1), iterations) for m in machines}, losses)
        unseen = np.stack([[best.get((*p, f), best[*p, -1]) for f in range(folds)] for p in pairs]).astype(np.float32)

        def margins(batches):
            """Per row and pair, the margin by the machine that has not seen the row's fold."""
            for x, y, f in tasks.blocks(batches, width):
                found, kernel = np.empty((len(pairs), len(x)), np.float32), tasks.kernel(x, frame, shift)
                for fold in range(folds):
                    found[:, f == fold] = unseen[:, fold] @ kernel[f == fold].T
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (found, y)], names=["margins", "label"])

        held = state.mapInArrow(margins, "margins binary, label binary").persist()

        def curves(points):
            def part(margin, label, names):
                both = [((label == a) | (label == b), p) for p, (a, b) in enumerate(pairs)]
                return np.array([tasks.logistic(margin[p][use].astype(np.float64), label[use] == pairs[p][1], points[pairs[p]])
                                 for use, p in both if pairs[p] in names])

            def sums(batches):
                return _of_all(part(np.frombuffer(m, np.float32).reshape(len(pairs), -1), np.frombuffer(y, np.int32), points)
                               for b in batches for m, y in zip(*(c.to_pylist() for c in b.columns)))

            out = {}
            for p, (loss, *g, a, b, c) in zip([p for p in pairs if p in points], _summed(held, sums).reshape(len(points), -1)):
                total, slope = machines[*p, -1], points[p][0]
                out[p] = (loss / total + 5e-7 * slope**2, np.array(g) / total + [1e-6 * slope, 0], np.array([[a, b], [b, c]]) / total + [[1e-6, 0], [0, 0]])
            return out

        found = together({p: newton() for p in pairs}, curves)
    finally:
        for table in (state, held):
            if table is not None:
                table.unpersist()
    return {p: best[*p, -1] for p in pairs}, {p: tuple(map(float, found[p])) for p in pairs}
