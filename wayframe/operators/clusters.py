"""k-means that gives the same clusters wherever it runs.

Vectors are rounded to whole numbers, so that distances, sums and costs are exact and no
order of addition shows. Each restart begins at another drawn vector and adds the vector
farthest from those it has; then vectors go to their nearest centre and centres to the mean
of their vectors, rounded down, until nothing moves, however many rounds that takes. All
restarts that still move advance in the same job: a round reads the vectors once, and each
task hands on one sum per restart and centre. What the driver holds is the centres, whose
number the caller sets, and a digest per restart and round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayframe.operators.draw import draw_key
from wayframe.sources.scratch import settle

EXACT = 1 << 53  # whole numbers that a double holds
FINEST = 1_000_000
_LOW = (1 << 20) - 1


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("point")
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to centres, exact for whole numbers within the bound."""
    return (points * points).sum(axis=1)[:, None] - 2 * (points @ centers.T) + (centers * centers).sum(axis=1)


def _farthest(centers: np.ndarray, names: str):
    """The vector farthest from a restart's centres; equal ones by token."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, tokens = _matrix(batch), np.asarray(batch.column("token").to_pylist(), object)
            for restart, own in enumerate(centers):
                near = _distances(points, own).min(axis=1)
                far = np.flatnonzero(near == near.max())
                best = int(far[np.argmin(tokens[far])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([restart], pa.int32()), pa.array([-int(near[best])]), pa.array([tokens[best]], pa.string()),
                     pa.array([points[best].astype(np.int64)], pa.list_(pa.int64()))], names=names.split())

    return search


def _moves(centers: np.ndarray):
    """A task's sums per restart, cluster and dimension; dimensions -1 to -3 are size and cost (high, low)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restarts, k, dims = centers.shape
        total = np.zeros((restarts, k, dims + 3), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch)
            whole = points.astype(np.int64)
            for restart, own in enumerate(centers):
                away = _distances(points, own)
                label = away.argmin(axis=1)
                cost = away[np.arange(len(label)), label].astype(np.int64)
                values = np.concatenate([whole, np.ones((len(label), 1), np.int64), (cost >> 20)[:, None], (cost & _LOW)[:, None]], axis=1)
                for cluster in np.unique(label):
                    total[restart, cluster] += values[label == cluster].sum(axis=0)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // (k * (dims + 3))).astype(np.int32)), pa.array((at // (dims + 3) % k).astype(np.int32)),
             pa.array((at % (dims + 3)).astype(np.int32)), pa.array(total.ravel())], names=["restart", "cluster", "dim", "value"])

    return sums


def _labels(centers: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = _distances(_matrix(batch), centers).argmin(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("token"), pa.array(label.astype(np.int32))], names=["token", "cluster"])

    return assign


def _digest(centers: np.ndarray) -> bytes:
    return hashlib.sha256(centers.tobytes()).digest()


def whole_points(vectors: DataFrame, token: str, vector: str) -> tuple[DataFrame, int]:
    """(token, point) in whole units of 1 / scale, and the scale: a power of ten, fine but exact."""
    measured = vectors.agg(
        F.max(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))).alias("most"),
        F.max(F.size(vector)).alias("dims"), F.min(F.size(vector)).alias("fewest")).first()
    if measured["dims"] != measured["fewest"]:
        raise ValueError(f"vectors of {measured['fewest']} and of {measured['dims']} dimensions")
    most, dims, scale = measured["most"] or 0.0, max(measured["dims"] or 1, 1), FINEST
    while scale > 1 and 4 * dims * (most * scale + 1) ** 2 >= EXACT:
        scale //= 10
    point = F.transform(vector, lambda x: F.rint(x.cast("double") * scale).cast("long"))
    return settle(vectors.select(F.col(token).cast("string").alias("token"), point.alias("point")), "points"), scale


def k_means(
    vectors: DataFrame, k: int, *, seed: int = 64, restarts: int = 10,
    token: str = "sample_data_token", vector: str = "vector",
) -> tuple[DataFrame, np.ndarray]:
    """Assignments ``<token>, cluster`` and centres (k rows) of the restart with the least cost.

    Fewer distinct vectors than k leave clusters empty. Equal distances go to the lower
    cluster, equal costs to the earlier restart. A restart ends when its centres stay, or
    come back to where they were before, which rounding down could cause.
    """
    points, scale = whole_points(vectors, token, vector)
    first = points.orderBy(draw_key("token", seed), "token").limit(restarts).collect()
    if not first:
        raise ValueError("no vectors to cluster")
    centers = np.array([[r["point"]] for r in first], np.float64)
    names = "restart near token point"
    while centers.shape[1] < k:
        found = points.mapInArrow(_farthest(centers, names), "restart int, near long, token string, point array<bigint>")
        rows = found.groupBy("restart").agg(F.min(F.struct("near", "token", "point")).alias("b")).orderBy("restart").collect()
        centers = np.concatenate([centers, np.array([[r["b"]["point"]] for r in rows], np.float64)], axis=1)
    costs, moving = [0] * len(centers), [*range(len(centers))]
    been = [set() for _ in moving]
    while moving:
        own = centers[moving]
        sums = points.mapInArrow(_moves(own), "restart int, cluster int, dim int, value long").groupBy("restart", "cluster", "dim").agg(
            F.sum("value").alias("value")).toArrow()
        table = np.zeros((*own.shape[:2], own.shape[2] + 3), np.int64)
        table[tuple(np.asarray(sums[c]) for c in ("restart", "cluster", "dim"))] = np.asarray(sums["value"])
        size = table[:, :, -3:-2]
        moved = np.where(size > 0, table[:, :, :-3] // np.maximum(size, 1), own).astype(np.float64)
        still = []
        for restart, total, here, there in zip(moving, table, own, moved):
            costs[restart] = (int(total[:, -2].sum()) << 20) + int(total[:, -1].sum())
            been[restart].add(_digest(here))
            if _digest(there) not in been[restart]:
                centers[restart] = there
                still.append(restart)
        moving = still
    best = centers[int(np.argmin(costs))]
    assigned = points.mapInArrow(_labels(best), "token string, cluster int")
    return assigned.select(F.col("token").alias(token), "cluster"), best / scale
