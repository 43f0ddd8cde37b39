"""A perceptron trained on weighted rows: equal rows count once, with their number as weight.

Spark's ``MultilayerPerceptronClassifier`` takes no weights, so it passes over every repeat of a row a
hundred times. The learner here has the same network, start weights, loss and steps (L-BFGS with a strong
Wolfe line search). Each step is one Spark job: tasks add up loss and gradient over their cached blocks of
rows, the driver holds one such vector per task. The result is Spark's own model.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose activations are held at once.
CHUNK = 2048
#: Pairs of steps and gradient changes that L-BFGS remembers.
MEMORY = 10


def _layers(weights: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each layer's (inputs x outputs) matrix and bias, in the order of Spark's weight vector."""
    out, at = [], 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        bias = at + n_in * n_out
        out.append((weights[at:bias].reshape(n_in, n_out), weights[bias:bias + n_out]))
        at = bias + n_out
    return out


def loss_and_gradient(blocks: Iterable[np.ndarray], weights: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Gradient, then loss, of the summed cross entropy over rows ``features..., label, weight``."""
    layers = _layers(weights, sizes)
    total = np.zeros(len(weights) + 1)
    grads = _layers(total, sizes)
    for block in blocks:
        for start in range(0, len(block), CHUNK):
            rows = block[start:start + CHUNK]
            label, weight = rows[:, -2].astype(np.int64), rows[:, -1]
            seen = [rows[:, :-2]]
            for matrix, bias in layers[:-1]:
                seen.append(0.5 + 0.5 * np.tanh(0.5 * (seen[-1] @ matrix + bias)))  # the sigmoid, without overflow
            scores = seen[-1] @ layers[-1][0] + layers[-1][1]
            scores -= scores.max(axis=1, keepdims=True)
            delta = np.exp(scores)
            sums = delta.sum(axis=1)
            own = np.arange(len(rows)), label
            total[-1] += weight @ (np.log(sums) - scores[own])
            delta /= sums[:, None]
            delta[own] -= 1
            delta *= weight[:, None]
            for i in reversed(range(len(layers))):
                grads[i][0][...] += seen[i].T @ delta
                grads[i][1][...] += delta.sum(axis=0)
                if i:
                    delta = (delta @ layers[i][0].T) * (seen[i] * (1 - seen[i]))
    return total


def _pack(batches: Iterator) -> Iterator:
    """Arrow batches ``features, label, weight`` -> one row each: the block's bytes."""
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows:
            features = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            block = np.column_stack([features, batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)])
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(block, dtype="float64").tobytes()], pa.binary())], ["block"])


def wolfe_step(slope_at: Callable[[float], tuple[float, float]], value: float, slope: float, step: float, tries: int = 10) -> float | None:
    """A step along a direction that meets the strong Wolfe conditions; None if ``tries`` don't find one.

    ``slope_at(t)`` gives the value and the slope at ``t``; ``value`` and ``slope`` are those at 0.
    """
    def too_high(t, v):
        return v > value + 1e-4 * t * slope

    def flat(d):
        return abs(d) <= 0.9 * abs(slope)

    def zoom(low, high):
        for _ in range(tries):
            left, right = sorted((low, high))
            width = right[0] - left[0]
            d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / -width
            d2 = np.sqrt(max(d1 * d1 - left[2] * right[2], 0.0))
            bottom = right[2] - left[2] + 2 * d2
            t = right[0] - width * (right[2] + d2 - d1) / bottom if bottom else left[0] + width / 2
            t = min(max(t, left[0] + 0.1 * width), left[0] + 0.9 * width)
            v, d = slope_at(t)
            if too_high(t, v) or v >= low[1]:
                high = (t, v, d)
            elif flat(d):
                return t
            else:
                if d * (high[0] - low[0]) >= 0:
                    high = low
                low = (t, v, d)
        return None

    low = (0.0, value, slope)
    for i in range(tries):
        v, d = slope_at(step)
        if not np.isfinite(v):
            step /= 2
            continue
        if too_high(step, v) or (i and v >= low[1]):
            return zoom(low, (step, v, d))
        if flat(d):
            return step
        if d >= 0:
            return zoom((step, v, d), low)
        low = (step, v, d)
        step *= 1.5
    return None


def minimise(fn: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """L-BFGS from ``start``; stops after ``max_iter`` steps, or when the value or the gradient hardly changes."""
    x = start
    value, grad = fn(x)
    first, values, pairs = abs(value), deque([value], MEMORY), deque(maxlen=MEMORY)
    for _ in range(max_iter):
        if np.linalg.norm(grad) <= max(tol * abs(value), 1e-8):
            break
        direction = grad.copy()
        parts = []
        for s, y in reversed(pairs):
            a = s @ direction / (s @ y)
            direction -= a * y
            parts.append(a)
        if pairs:
            s, y = pairs[-1]
            direction *= s @ y / (y @ y)
        for (s, y), a in zip(pairs, reversed(parts)):
            direction += s * (a - y @ direction / (s @ y))
        direction = -direction
        seen = {}

        def along(t):
            seen[t] = fn(x + t * direction)
            return seen[t][0], seen[t][1] @ direction

        step = wolfe_step(along, value, grad @ direction, 1.0 if pairs else 1.0 / np.linalg.norm(direction))
        if step is None:
            if not pairs:
                break
            pairs.clear()  # forget the curvature, go on by the steepest descent
            continue
        (value, new_grad), moved = seen[step], step * direction
        if moved @ (new_grad - grad) > 0:
            pairs.append((moved, new_grad - grad))
        x, grad = x + moved, new_grad
        values.append(value)
        if abs(value - max(values)) <= tol * first:
            break
    return x


class WeightedPerceptron(Estimator):
    """Fits Spark's ``MultilayerPerceptronClassificationModel`` to rows that count ``weight`` times."""

    def __init__(self, layers: Sequence[int], features: str, label: str, weight: str, seed: int = 123, max_iter: int = 100, tol: float = 1e-6):
        super().__init__()
        self.sizes, self.features, self.label, self.weight = list(layers), features, label, weight
        self.seed, self.max_iter, self.tol = seed, max_iter, tol

    def _spark_model(self, dataset: DataFrame, weights=None):
        """Spark's model of the given weights, or of the weights that Spark starts from: its learner with no step to go."""
        learner = MultilayerPerceptronClassifier(featuresCol=self.features, labelCol=self.label, layers=self.sizes, seed=self.seed, maxIter=0)
        if weights is not None:
            learner = learner.setInitialWeights(weights.tolist())
        return learner.fit(dataset.select(self.features, self.label).limit(1))

    def _fit(self, dataset: DataFrame):
        sizes = self.sizes
        rows = dataset.select(vector_to_array(self.features), F.col(self.label).cast("double"), F.col(self.weight).cast("double"))
        blocks = rows.mapInArrow(_pack, "block binary").rdd.map(lambda r: np.frombuffer(r[0]).reshape(-1, sizes[0] + 2))
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = blocks.map(lambda block: float(block[:, -1].sum())).sum()

            def mean(weights):
                parts = blocks.mapPartitions(lambda part: [loss_and_gradient(part, weights, sizes)]).collect()
                total = np.sum(parts, axis=0) / n
                return float(total[-1]), total[:-1]

            start = self._spark_model(dataset).weights.toArray()
            return self._spark_model(dataset, minimise(mean, start, self.max_iter, self.tol))
        finally:
            blocks.unpersist()
