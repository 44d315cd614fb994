"""Centroid clustering on integer vectors, with dot products kept and updated by what changed.

Every vector keeps its exact dot product with every centroid. When centroids
move, only their components that changed are multiplied with the vectors'
same components and added; the nearest centroid is then the smallest of
|c|^2 - 2 v.c, without touching the other components. Vectors that stayed in
their cluster don't enter the new sums either: those that moved are taken out
of one cluster's sums and put into the other's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

MOST = 1 << 24  # of a component's absolute value: sums of products stay exact in 64 bits
BATCH = 4096  # vectors looked at together
STATE = "vec_id long, v binary, square long, dots binary, cluster int, was int"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH):
            yield batch.slice(i, BATCH)


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.int64)


def integer_vectors(vectors: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """(vec_id, q): vectors of ``size`` finite components, each as floor(scale * x), x as double."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where((F.size("x") == size) & F.coalesce(fine, F.lit(False)))
    # A double holds whole numbers this small exactly; larger ones are told from them before they are cast.
    scaled = F.transform("x", lambda x: F.floor(F.least(F.greatest(x, F.lit(-4.0 * MOST)), F.lit(4.0 * MOST)) * scale))
    return rows.select("vec_id", scaled.alias("q"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``; ties by components, null ids last."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.orderBy(named.asc_nulls_last(), "q").limit(k).collect()  # k vectors
    return np.array([r["q"] for r in found], np.int64)


def _start(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The first state: vectors with all their dot products, in no cluster before."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            q = np.array(batch.column("q").flatten(), np.int64).reshape(-1, size)
            yield _state(batch.column("vec_id"), q, q @ centroids.T, centroids, np.full(len(q), -1))

    return rows.mapInArrow(run, STATE)


def _state(ids: pa.Array, q: np.ndarray, dots: np.ndarray, centroids: np.ndarray, was: np.ndarray) -> pa.RecordBatch:
    far = (centroids * centroids).sum(1) - 2 * dots
    cluster = far.argmin(1)  # the first of equals
    arrays = [
        ids, pa.array([x.tobytes() for x in q.astype("<i4")], pa.binary()), pa.array((q * q).sum(1)),
        pa.array([x.tobytes() for x in dots.astype("<i8")], pa.binary()), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["vec_id", "v", "square", "dots", "cluster", "was"])


def _advanced(state: DataFrame, before: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state after centroids moved: dot products change by the components that did."""
    k, size = centroids.shape
    moves = [(j, np.flatnonzero(centroids[j] != before[j])) for j in range(k)]
    moves = [(j, at, (centroids[j] - before[j])[at]) for j, at in moves if len(at)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            q, dots = _matrix(batch.column("v"), size, "<i4"), _matrix(batch.column("dots"), k, "<i8")
            for j, at, change in moves:
                dots[:, j] += q[:, at] @ change
            yield _state(batch.column("vec_id"), q, dots, centroids, np.array(batch.column("cluster"), np.int64))

    return state.mapInArrow(run, STATE)


def _moved_sums(state: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed their cluster add to each cluster's count and sums; each task folds its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, size + 1), np.int64)  # the last row takes those from no cluster
        for batch in _batches(batches):
            q = np.concatenate([np.ones((batch.num_rows, 1), np.int64), _matrix(batch.column("v"), size, "<i4")], 1)
            np.add.at(total, np.array(batch.column("cluster"), np.int64), q)
            np.subtract.at(total, np.array(batch.column("was"), np.int64), q)
        j, d = np.nonzero(total[:k])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (j, d, total[j, d])], ["j", "d", "n"])

    moved = state.where("cluster <> was").select("v", "cluster", "was").mapInArrow(run, "j long, d long, n long")
    out = np.zeros((k, size + 1), np.int64)
    for r in moved.groupBy("j", "d").agg(F.sum("n").alias("n")).collect():  # k * (size + 1) at most
        out[r["j"], r["d"]] = r["n"]
    return out[:, 0], out[:, 1:]


def clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2", key: str = "vec_id", vector: str = "embedding",
    size: int = 64, scale: int = 256,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector kept, stored, and the final centroids.

    Kept are vectors of exactly ``size`` components, none null or non-finite;
    repeated rows and null ids are vectors like others. Fewer than ``k``
    vectors: each is a centroid. Each round assigns all vectors to the nearest
    centroid (ties: the smaller number) and replaces those of non-empty
    clusters by the floor of their vectors' exact mean; last, all are assigned
    once more. A scaled component beyond ``MOST`` is refused with an error, as
    its distance is beyond a long. The driver holds ``k`` centroids, their sums
    and nothing of the vectors' number. No vector kept: no rows.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, key, vector, size, scale), "integer-vectors")
    most = rows.agg(F.max(F.greatest(F.array_max("q"), -F.array_min("q")))).collect()[0][0]
    if most is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, size), np.int64)
    if most > MOST:
        raise ValueError(f"a component of {most} is beyond {MOST}")
    centroids = first_centroids(rows, k, seed)
    k = len(centroids)
    state = stored(_start(rows, centroids), "dot-products")
    discard(rows)
    count, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
    for _ in range(rounds):
        more, change = _moved_sums(state, k, size)
        count, sums = count + more, sums + change
        before, centroids = centroids, np.where(count[:, None] > 0, sums // np.maximum(count, 1)[:, None], centroids)
        old, state = state, stored(_advanced(state, before, centroids), "dot-products")
        discard(old)
    square = (centroids * centroids).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            dots, cluster = _matrix(batch.column("dots"), k, "<i8"), np.array(batch.column("cluster"), np.int64)
            distance = np.array(batch.column("square"), np.int64) - 2 * dots[np.arange(len(dots)), cluster] + square[cluster]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(distance)], ["vec_id", "cluster", "distance"])

    found = stored(state.select("vec_id", "square", "dots", "cluster").mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    discard(state)
    return found, centroids


def cluster_report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with its cluster's sum of distances, that over all, and a digest of the cluster's centroid."""
    spark = found.sparkSession
    own = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows at most
    rows = [(j, own[j], sum(own.values()), ",".join(map(str, centroids[j].tolist()))) for j in sorted(own)]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string")
    named = table.select("cluster", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
