"""Centroid clustering with an equal-average equal-variance nearest-neighbour search.

Vectors are whole numbers, so distances, sums and means are exact and every rerun, on any
partitioning, gives the same clusters.

*Search.* Centroids stand in the order of their component sums. From the place of the
vector's own sum the scan goes outward, always to the nearer side. With ``S`` the sum of
the ``d`` components and ``V`` the length of the deviation from the mean,

    distance >= (S_x - S_c)**2 / d                       (equal average)
    distance >= (S_x - S_c)**2 / d + (V_x - V_c)**2      (equal variance)

The first grows along each side, so a centroid that it rejects ends the side; it is
compared in whole numbers. The second is taken in floating point with a margin and only
skips. What is left gets its exact distance; of equal distances the smaller number wins.

*Rounds.* Each task adds up its vectors by cluster before a shuffle of one row for each
cluster and task; the driver holds the centroids, ``k`` vectors, whatever the data are.

Vectors with another number of components, a null or a non-finite component are left out.
Rows with equal or null ids are vectors of their own. Of equal starting hashes (equal ids)
the smaller vector comes first. With fewer than ``k`` vectors there are fewer centroids,
with none no rows. Components are exact up to 2**53 and cut to that beyond; distances and
inertia above 2**63 - 1 are reported as that.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.session import stage

#: Vectors that a task compares at a time.
BLOCK = 1 << 12
_LARGEST = 2**63 - 1


def _narrow(width: int) -> int:
    """Size of components up to which distances and squared sums fit 64 bits."""
    return (1 << 29) // max(width, 1)


def whole_vectors(rows: DataFrame, key: str, vector: str, size: int, scale: int = 1024) -> DataFrame:
    """``key, vector``: the rows with ``size`` finite components, each as floor(scale * x)."""
    x = F.col("vector")
    kept = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")).where(
        (F.size(x) == size)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    )
    edge = F.lit(float(2**53))
    return kept.select(
        "key",
        F.transform(x, lambda v: F.floor(F.greatest(F.least(v * scale, edge), -edge)).cast("long")).alias("vector"),
    )


def starting(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:key``; the query reads ``k`` rows."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.select(name.alias("name"), "vector").orderBy("name", "vector").limit(k).collect()
    return _exact(np.array([r.vector for r in first], dtype=object))


def fit(vectors: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after ``rounds`` of assigning and replacing each by its floored mean.

    A centroid without vectors stays. Sums are decimal(38, 0), exact for 10**19 vectors.
    """
    for _ in range(rounds if len(centroids) else 0):
        parts = vectors.select("vector").mapInArrow(_sums(centroids), "cluster int, place int, n long, total decimal(38,0)")
        totals = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        moved = centroids.astype(object)
        for r in totals.collect():  # at most k vectors
            moved[r.cluster, r.place] = int(r.total) // r.n
        centroids = _exact(moved)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vectors`` with the ``cluster`` and its squared ``distance``."""
    if not len(centroids):  # there are no vectors
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("cluster", "int"), ("distance", "long"))]
        return vectors.select("key", *none)
    kind = vectors.schema["key"].dataType.simpleString()
    packed = vectors.select(F.struct("key").alias("row"), "vector")
    out = packed.mapInArrow(_assigned(centroids), f"row struct<key: {kind}>, cluster int, distance long")
    return out.select(F.col("row.key").alias("key"), "cluster", "distance")


def clustered(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64,
    k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024,
) -> tuple[DataFrame, np.ndarray]:
    """``key, cluster, distance, cluster_inertia, inertia`` for every kept vector, and the centroids."""
    vectors = stage(whole_vectors(rows, key, vector, size, scale), "whole_vectors")
    centroids = fit(vectors, starting(vectors, k, seed), rounds)
    found = stage(assign(vectors, centroids), "assigned")
    # one row for each cluster; the total sums those
    summed = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r.cluster: int(r.s) for r in summed.collect()}
    total = min(sum(inertia.values()), _LARGEST)
    of_cluster = _by_cluster([min(inertia.get(c, 0), _LARGEST) for c in range(len(centroids))], "long")
    out = found.select(
        F.col("key").alias(key), "cluster", "distance",
        of_cluster.alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"),
    )
    return out, centroids


def by_cluster(values: list[str]) -> Column:
    """A constant of each cluster as a column beside ``cluster``."""
    return _by_cluster(values, "string")


def _by_cluster(values: list, kind: str) -> Column:
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))


def _exact(vectors: np.ndarray) -> np.ndarray:
    """64-bit numbers where every distance fits, else Python's whole numbers."""
    if not vectors.size:
        return np.zeros((0, 0), np.int64)
    wide = max(abs(int(v)) for v in vectors.ravel()) > _narrow(vectors.shape[1])
    return vectors.astype(object if wide else np.int64)


class Search:
    """Centroids in the order of their sums, with what the inequalities need."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.array(sorted(range(len(sums)), key=lambda c: (sums[c], c)))
        self.centroids = centroids[self.order]
        self.sums = sums[self.order]
        self.width = centroids.shape[1]
        self.deviations = self._deviation(self.centroids, self.sums)

    def _deviation(self, x: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Length of the difference from the mean, rounded."""
        spread = (x * x).sum(axis=1) * self.width - sums * sums
        return np.sqrt(np.maximum(spread.astype(np.float64), 0) / self.width)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of every row and its squared distance."""
        n, k = len(x), len(self.order)
        sums = x.sum(axis=1)
        deviation = self._deviation(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, -1, x.dtype)
        chosen = np.full(n, k)
        rows = np.arange(n)
        while rows.size:
            low, high = left[rows], right[rows]
            gap_low = np.abs(sums[rows] - self.sums[np.maximum(low, 0)])
            gap_high = np.abs(self.sums[np.minimum(high, k - 1)] - sums[rows])
            down = (low >= 0) & ((high >= k) | (gap_low <= gap_high).astype(bool))
            at = np.where(down, low, np.minimum(high, k - 1))
            gap = np.where(down, gap_low, gap_high)
            # the nearer side is beyond the best: so are all others
            open_ = (best[rows] < 0).astype(bool) | (gap * gap <= best[rows] * self.width).astype(bool)
            open_ &= (low >= 0) | (high < k)
            rows, at, gap, down = rows[open_], at[open_], gap[open_], down[open_]
            left[rows[down]] -= 1
            right[rows[~down]] += 1
            apart = deviation[rows] - self.deviations[at]
            bound = gap.astype(np.float64) ** 2 / self.width + apart * apart
            # the margin covers the rounding of deviations and of the bound
            slack = 1e-9 * (deviation[rows] + self.deviations[at] + 1) ** 2 + 1
            near = (best[rows] < 0).astype(bool) | (bound * (1 - 1e-9) - slack <= best[rows].astype(np.float64))
            who, which = rows[near], at[near]
            difference = x[who] - self.centroids[which]
            distance = (difference * difference).sum(axis=1)
            number = self.order[which]
            better = (best[who] < 0).astype(bool) | (distance < best[who]).astype(bool)
            better |= (distance == best[who]).astype(bool) & (number < chosen[who])
            best[who[better]] = distance[better]
            chosen[who[better]] = number[better]
        return chosen, best


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """``first row, end row, vectors`` of a batch."""
    column = batch.column("vector")
    if not batch.num_rows:
        return
    width = len(column[0])
    for at in range(0, batch.num_rows, BLOCK):
        piece = column.slice(at, BLOCK)
        yield at, at + len(piece), piece.flatten().to_numpy().reshape(-1, width)


def _matched(search: Search, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = search.centroids.dtype == object or np.abs(x).max() > _narrow(search.width)
    return search.nearest(x.astype(object) if wide else x)


def _sums(centroids: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        k, width = centroids.shape
        count, sums = np.zeros(k, np.int64), np.zeros((k, width), object)
        for batch in batches:
            for _, _, x in _blocks(batch):
                cluster, _ = _matched(search, x)
                for c in np.unique(cluster):
                    mine = x[cluster == c]
                    if np.abs(mine).max() > _LARGEST // BLOCK:
                        mine = mine.astype(object)
                    sums[c] += mine.sum(axis=0).astype(object)
                    count[c] += len(mine)
        some = np.flatnonzero(count)
        yield pa.record_batch(
            [pa.array(np.repeat(some, width), pa.int32()), pa.array(np.tile(np.arange(width), some.size), pa.int32()),
             pa.array(np.repeat(count[some], width), pa.int64()),
             pa.array([Decimal(int(v)) for v in sums[some].ravel()], pa.decimal128(38, 0))],
            names=["cluster", "place", "n", "total"],
        )

    return work


def _assigned(centroids: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            for at, end, x in _blocks(batch):
                cluster, square = _matched(search, x)
                distance = [min(int(s), _LARGEST) for s in square] if square.dtype == object else square
                yield pa.record_batch(
                    [batch.column("row").slice(at, end - at), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["row", "cluster", "distance"],
                )

    return work
