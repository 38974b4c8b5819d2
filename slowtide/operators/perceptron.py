"""The perceptron's loss over rows that stand for several equal ones, and L-BFGS by the rules of MLlib's trainer."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slowtide.session import ship

#: A point of a search: distance, value, slope along the direction, gradient.
Point = tuple[float, float, float, np.ndarray]


def loss(layers: Sequence[int], weights: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Cross-entropy of the rows `x` with the classes `y`, row i counted n[i] times, and its gradient.

    Sigmoid layers below a softmax; `weights` are laid out as MLlib's, per layer the matrix by inputs, then the biases.
    """
    parts, at = [], 0
    for a, b in pairwise(layers):
        parts.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    outs = [x]
    with np.errstate(over="ignore"):
        for w, b in parts[:-1]:
            outs.append(1 / (1 + np.exp(-(outs[-1] @ w + b))))
    z = outs[-1] @ parts[-1][0] + parts[-1][1]
    z -= z.max(axis=1, keepdims=True)
    p, right = np.exp(z), (np.arange(len(y)), y)
    whole = p.sum(axis=1)
    value = float(n @ (np.log(whole) - z[right]))
    delta = p / whole[:, None]
    delta[right] -= 1
    delta *= n[:, None]
    slopes = []
    for k in reversed(range(len(parts))):
        slopes += [delta.sum(axis=0), (outs[k].T @ delta).ravel()]
        if k:
            delta = (delta @ parts[k][0].T) * outs[k] * (1 - outs[k])
    return value, np.concatenate(slopes[::-1])


def _sums(layers: Sequence[int], weights: np.ndarray, means: np.ndarray, factors: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, loss and gradient of a task, in one array."""
    sums = np.zeros(2 + len(weights))
    for batch in batches:
        *x, y, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        value, slope = loss(layers, weights, (np.column_stack(x) - means) * factors, y.astype(int), n.astype(float))
        sums += np.concatenate([[n.sum(), value], slope])
    yield pa.RecordBatch.from_pydict({"sums": pa.array([sums], pa.list_(pa.float64()))})


def mean_loss(df: DataFrame, layers: Sequence[int], means: np.ndarray, factors: np.ndarray) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """The mean loss and its gradient as a function of the weights, one pass over `df` each.

    `df` has the features, taken as (x - mean) * factor, the class and the number of rows that a row stands for, all of
    them double. A task sends one array of the size of the weights.
    """
    ship(df.sparkSession)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        parts = df.mapInArrow(partial(_sums, layers, weights, means, factors), "sums array<double>").toArrow()
        sums = parts["sums"].combine_chunks().flatten().to_numpy().reshape(-1, 2 + len(weights)).sum(axis=0)
        return float(sums[1] / sums[0]), sums[2:] / sums[0]

    return at


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, most: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """L-BFGS from `x`, at most `most` steps, each by a search for the strong Wolfe conditions.

    It ends when a step no longer lowers the largest of the last 20 values by `tolerance` of the first, when the
    gradient is below `tolerance` of the value, or when the search fails twice running, the second time along the gradient.
    """
    value, slope = f(x)
    values, steps, failed = [value], deque(maxlen=memory), False
    while len(values) <= most and np.linalg.norm(slope) > max(tolerance * abs(value), 1e-8):
        down = _direction(slope, steps)
        point = _search(f, x, value, slope, down, 1.0 if steps else 1 / np.linalg.norm(down))
        if point is None:
            if failed:
                break
            failed = True
            steps.clear()
            continue
        moved, turned = point[0] * down, point[3] - slope
        steps.append((moved, turned))
        x, value, slope = x + moved, point[1], point[3]
        values.append(value)
        failed = False
        if abs(value - max(values[-20:])) <= tolerance * abs(values[0]):
            break
    return x


def _direction(slope: np.ndarray, steps: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    down, shares = -slope, []
    for moved, turned in reversed(steps):
        shares.append((moved @ down) / (moved @ turned))
        down = down - shares[-1] * turned
    if steps:
        moved, turned = steps[-1]
        down = down * ((moved @ turned) / (turned @ turned))
    for (moved, turned), share in zip(steps, reversed(shares)):
        down = down + moved * (share - (turned @ down) / (moved @ turned))
    return down


def _search(f: Callable, x: np.ndarray, value: float, slope: np.ndarray, down: np.ndarray, first: float, tries: int = 10) -> Point | None:
    """A point of `x + t * down` with a value low enough and a slope flat enough (Nocedal and Wright, 3.5 and 3.6)."""

    def at(t: float) -> Point:
        v, g = f(x + t * down)
        return t, v, float(g @ down), g

    low = start = (0.0, value, float(slope @ down), slope)
    if start[2] >= 0:
        return None
    enough = lambda p: p[1] <= value + 1e-4 * p[0] * start[2]
    flat = lambda p: abs(p[2]) <= 0.9 * abs(start[2])
    t, high = first, None
    for k in range(tries):
        point = at(t)
        if not np.isfinite(point[1]):
            t /= 2
        elif not enough(point) or k and point[1] >= low[1]:
            high = point
            break
        elif flat(point):
            return point
        elif point[2] >= 0:
            low, high = point, low
            break
        else:
            low, t = point, 1.5 * t
    for _ in range(tries if high else 0):
        point = at(_between(low, high))
        if not enough(point) or point[1] >= low[1]:
            high = point
        else:
            if flat(point):
                return point
            if point[2] * (high[0] - low[0]) >= 0:
                high = low
            low = point
    return None


def _between(a: Point, b: Point) -> float:
    """Where the cubic through two points is least, at least a tenth of their distance from either."""
    a, b = sorted((a, b), key=lambda p: p[0])
    wide = b[0] - a[0]
    d1 = a[2] + b[2] - 3 * (b[1] - a[1]) / wide
    root = max(d1 * d1 - a[2] * b[2], 0.0) ** 0.5
    rise = b[2] - a[2] + 2 * root
    t = b[0] - wide * (b[2] + root - d1) / rise if rise else (a[0] + b[0]) / 2
    return min(max(t, a[0] + 0.1 * wide), b[0] - 0.1 * wide)
