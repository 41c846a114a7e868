"""Clustering of vectors around centroids in whole numbers, so that every run gives the same clusters.

A vector's nearest centroid is found as the winner of a tournament: of two centroids, the side of
their bisecting plane on which the vector lies tells which one is nearer. Normals and thresholds of
all planes are whole numbers, made once a round; a vector takes one test per centroid but one.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.shared import settled

# Scaled components from here on have squared distances that no 64-bit integer holds.
LARGEST = 1 << 27
# Rows that a worker tests at a time.
ROWS = 4096


class Bisectors:
    """The planes between every two of ``k`` whole-number centroids.

    ``x`` is nearer to ``j`` than to ``i`` exactly if ``x · normal[i, j] > threshold[i, j]``; at zero
    difference both are equally near and the smaller number stays.
    """

    def __init__(self, centroids: Sequence[Sequence[int]]):
        self.c = np.array(centroids, np.int64).reshape(len(centroids), -1)
        self.normal = 2 * (self.c[None, :, :] - self.c[:, None, :])
        square = (self.c * self.c).sum(1)
        self.threshold = square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row of whole numbers."""
        normal, threshold = self.normal, self.threshold
        widest = int(np.abs(x).max(initial=0)) * int(np.abs(normal).max(initial=0)) * x.shape[1]
        if max(widest, int(np.abs(threshold).max(initial=0))) < 1 << 53:  # doubles are exact there, and faster
            x, normal, threshold = x.astype(np.float64), normal.astype(np.float64), threshold.astype(np.float64)
        # the first round pairs the same two centroids for all rows; what is left differs by row from then on
        left, right = np.arange(0, len(self.c) - 1, 2), np.arange(1, len(self.c), 2)
        wins = x @ normal[left, right].T > threshold[left, right]
        alive = [np.where(wins[:, p], right[p], left[p]) for p in range(len(left))]
        if len(self.c) % 2:
            alive.append(np.full(len(x), len(self.c) - 1))
        while len(alive) > 1:
            won = []
            for i, j in zip(alive[0::2], alive[1::2]):
                side = np.einsum("nd,nd->n", x, normal[i, j])
                won.append(np.where(side > threshold[i, j], j, i))
            alive = won + ([alive[-1]] if len(alive) % 2 else [])
        return alive[0]

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        gap = x - self.c[cluster]
        return (gap * gap).sum(1)


def whole_numbers(vectors: pa.Array, components: int, scale: int) -> np.ndarray:
    """Floor of ``scale`` times each component, a row a vector."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(scale * flat)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ArithmeticError(f"a component times {scale} is {LARGEST} or more: its distances exceed 64 bits")
    return out.astype(np.int64).reshape(-1, components)


def usable(vector: str, components: int) -> Column:
    """Whether a vector has the right number of components, all of them finite numbers."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == components) & finite, F.lit(False))


def starting_vectors(kept: DataFrame, id: str, vector: str, k: int, salt: str) -> DataFrame:
    """The ``k`` vectors whose ids have the smallest hashes, in that order."""
    named = kept.select(F.sha2(F.concat(F.lit(salt), F.col(id).cast("string")), 256).alias("_h"), F.col(vector).alias("_v"))
    return named.filter(F.col("_h").isNotNull()).orderBy("_h", "_v").limit(k)


def cluster_sums(kept: DataFrame, vector: str, planes: Bisectors, scale: int) -> DataFrame:
    """``(cluster, n, s0, s1, …)``: rows and component sums of every cluster, added up inside tasks first."""
    k, d = planes.c.shape
    names = [f"s{i}" for i in range(d)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = whole_numbers(batch.column(0).slice(at, ROWS), d, scale)
                own = planes.nearest(x)
                n += np.bincount(own, minlength=k)
                order = np.argsort(own, kind="stable")
                there, first = np.unique(own[order], return_index=True)
                sums[there] += np.add.reduceat(x[order], first)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), *[pa.array(sums[some, i]) for i in range(d)]],
                                         ["cluster", "n", *names])

    schema = ", ".join(f"{c} long" for c in ["cluster", "n", *names])
    return kept.select(vector).mapInArrow(run, schema).groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ["n", *names]])


def assigned(kept: DataFrame, id: str, vector: str, planes: Bisectors, scale: int) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""
    d = planes.c.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = whole_numbers(batch.column(1).slice(at, ROWS), d, scale)
                own = planes.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, ROWS), pa.array(own.astype(np.int32)), pa.array(planes.distances(x, own))],
                    ["_id", "cluster", "distance"])

    rows = kept.select(F.col(id).alias("_id"), vector)
    schema = rows.select("_id").withColumns({"cluster": F.lit(0).cast("int"), "distance": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(run, schema)


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 64, k: int = 40,
            rounds: int = 5, scale: int = 256, salt: str = "2:") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every usable vector.

    Components become ``floor(scale · x)``. The ``k`` vectors with the smallest SHA-256 of ``salt``
    and id start as centroids; each round gives every vector to its nearest centroid (the smaller
    number at ties) and moves a centroid to the floor of its vectors' mean. A round is one scan that
    adds up inside the tasks; the driver sees ``k`` rows a round and nothing that grows with the
    vectors.

    Null vectors, vectors of other sizes and those with a null, NaN or infinite component are left
    out, and an empty table gives an empty result. A null id is clustered but never a start. Repeated
    rows all stay and weigh each; of two starts with equal ids the smaller vector comes first. Fewer
    than ``k`` vectors with an id give as many clusters, none of them no rows. Columns besides id and
    vector are not read, so their names cannot clash. A component whose scaled value reaches 2²⁷ is
    an error, since distances would not fit 64 bits.
    """
    kept = vectors.filter(usable(vector, components))
    starts = starting_vectors(kept, id, vector, k, salt).select("_v").toArrow()  # k rows
    centroids = whole_numbers(starts.column(0).combine_chunks(), components, scale).tolist() if starts.num_rows else []
    if not centroids:
        empty = kept.limit(0).select(F.col(id).alias(id))
        return empty.withColumns({"cluster": F.lit(0), **{c: F.lit(0).cast("long") for c in (
            "distance", "cluster_inertia", "inertia")}, "centroid_sha256": F.lit("")})
    for _ in range(rounds):
        for r in cluster_sums(kept, vector, Bisectors(centroids), scale).collect():  # k rows
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(components)]
    rows = settled(assigned(kept, id, vector, Bisectors(centroids), scale), "clusters")
    totals = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = [(c, total, sum(totals.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, total in totals.items()]
    table = rows.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows at most
    return rows.join(F.broadcast(table), "cluster").select(
        F.col("_id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
