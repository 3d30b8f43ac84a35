"""A balanced partition of a neighbour graph and a classifier that learns it, for a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of the sample that are compared with all others at once.
SLICE = 256


def neighbours(spark: SparkSession, sample: np.ndarray, degree: int) -> np.ndarray:
    """For each row of the sample its nearest others by inner product; the slices are dealt over the cluster."""
    shared = spark.sparkContext.broadcast(sample)
    degree = min(degree, len(sample) - 1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                rows = np.arange(start, min(start + SLICE, len(sample)))
                scores = shared.value[rows] @ shared.value.T
                scores[np.arange(len(rows)), rows] = -np.inf
                near = np.argpartition(-scores, degree - 1, axis=1)[:, :degree]
                columns = [pa.array(rows), pa.array(np.sort(near, axis=1).tolist(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "near"])

    slices = -(-len(sample) // SLICE)
    starts = spark.range(0, slices * SLICE, SLICE, numPartitions=min(slices, 64))
    found = starts.mapInArrow(search, "row bigint, near array<bigint>").orderBy("row").collect()
    shared.unpersist()
    return np.array([row["near"] for row in found])


class Graph:
    """An undirected graph as rows of neighbours."""

    def __init__(self, near: np.ndarray):
        n, degree = near.shape
        a, b = np.repeat(np.arange(n), degree), near.ravel()
        ends = np.unique(np.r_[a * n + b, b * n + a])
        self.n, self.source, self.target = n, ends // n, ends % n

    def inside(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edges between the nodes, by their places among these."""
        place = np.full(self.n, -1)
        place[nodes] = np.arange(len(nodes))
        a, b = place[self.source], place[self.target]
        kept = (a >= 0) & (b >= 0)
        return a[kept], b[kept]


def halves(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator, sweeps: int = 60, rounds: int = 12) -> np.ndarray:
    """Two halves of equal size, to within one, with few edges between them.

    The start is the median of the second eigenvector of the graph's random walk. Then
    as many nodes change sides in either direction as lose edges by it, best first.
    """
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    x = rng.normal(size=n)
    for _ in range(sweeps):
        x -= np.sum(x * degree) / np.sum(degree)
        x = (x + np.bincount(a, weights=x[b], minlength=n) / degree) / 2
        x /= np.linalg.norm(x) or 1.0
    side = np.zeros(n, np.int64)
    side[np.argsort(x, kind="stable")[n // 2 :]] = 1
    best, least = side, np.sum(side[a] != side[b])
    for _ in range(rounds):
        gain = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
        zero, one = (np.flatnonzero(side == k) for k in (0, 1))
        zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
        pairs = min(len(zero), len(one))
        worth = gain[zero[:pairs]] + gain[one[:pairs]] > 0
        # All at once would undo each other; half of them rarely do.
        moved = int(np.argmin(worth)) if not worth.all() else pairs
        moved = -(-moved // 2)
        if not moved:
            break
        side = side.copy()
        side[zero[:moved]], side[one[:moved]] = 1, 0
        if (cut := np.sum(side[a] != side[b])) < least:
            best, least = side, cut
    return best


def balanced(near: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """A part below `parts`, a power of two, for every node; sizes differ by a few nodes at most."""
    graph, rng = Graph(near), np.random.default_rng(seed)
    found = np.zeros(graph.n, np.int64)
    for _ in range(parts.bit_length() - 1):
        split = found * 2
        for part in np.unique(found):
            nodes = np.flatnonzero(found == part)
            split[nodes] += halves(*graph.inside(nodes), len(nodes), rng)
        found = split
    return found


@dataclass(frozen=True)
class Classifier:
    """One hidden layer; it gives every part a score, higher for a likelier part."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def trained(x: np.ndarray, wanted: np.ndarray, hidden: int = 128, epochs: int = 30, batch: int = 256, seed: int = 1) -> Classifier:
    """A classifier that learns the rows of probabilities `wanted`, by Adam steps on the cross entropy."""
    rng = np.random.default_rng(seed)
    width, parts = x.shape[1], wanted.shape[1]
    scale = 1 / (np.sqrt(np.mean(np.sum(x * x, axis=1))) or 1.0)
    weights = [
        rng.normal(size=(width, hidden)) * scale * np.sqrt(2), np.zeros(hidden),
        rng.normal(size=(hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts),
    ]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    total = epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), batch):
            rows = order[start : start + batch]
            inner = x[rows] @ weights[0] + weights[1]
            active = np.maximum(inner, 0)
            out = active @ weights[2] + weights[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = (error @ weights[2].T) * (inner > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), active.T @ error, error.sum(axis=0)]
            step += 1
            rate = 3e-3 * (1 - (step - 1) / total)
            for k, slope in enumerate(slopes):
                # Weights on the input move in proportion to its size, whatever the scale of the vectors.
                unit = scale if k == 0 else 1.0
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope * slope
                weights[k] -= unit * rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-12)
    return Classifier(*weights)


def learned_parts(spark: SparkSession, sample: np.ndarray, parts: int, degree: int = 10) -> Classifier:
    """A classifier for a balanced partition of the sample's neighbour graph.

    A row is taught the parts of its neighbours and its own, as shares: a query's
    neighbours are what the parts are searched for.
    """
    near = neighbours(spark, sample, degree)
    part = balanced(near, parts)
    wanted = np.zeros((len(sample), parts))
    for column in [np.arange(len(sample))[:, None], near]:
        np.add.at(wanted, (np.repeat(np.arange(len(sample)), column.shape[1]), part[column].ravel()), 1.0)
    return trained(sample, wanted / wanted.sum(axis=1, keepdims=True))
