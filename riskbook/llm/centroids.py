"""Centroid clustering with an equal-average equal-variance search for the nearest centroid.

Vectors become integers, so that sums, means and distances are exact and reruns agree whatever the
partitions.  Centroids are sorted by the sum of their components.  For a vector, candidates are scanned
outward from its own sum; with k components, sums S and deviations V (root of the sum of squared distances from
the mean), a centroid's squared distance is at least (S_x - S_c)^2 / k + (V_x - V_c)^2.  The first term alone ends the
scan on its side, both together reject a candidate, and what remains gets its exact integer distance.  The
bounds are doubles with room for their rounding, so that none rejects a centroid that is as near as the best.

A round sums the vectors of each cluster inside each task first; what reaches the driver is one sum for each
centroid and component.  The kept vectors are stored once, so that all rounds see the same rows.

Defined cases: vectors that are null, have another number of components, or a null or non-finite component
are left out; null identifiers are kept and are the last choice as a first centroid; rows with equal identifiers are
vectors of their own (as first centroids in the order of their components); of fewer vectors than centroids each is one; an
empty cluster keeps its centroid; no kept vector gives an empty result; clashing extra columns are left
out.  A component beyond `WIDEST` after scaling raises an error, since distances would not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.storage import store

CENTROIDS = 16
COMPONENTS = 64
SCALE = 64
ROUNDS = 3
SALT = "1"
#: 64 squared differences of such components are below 2 ** 63.
WIDEST = 1 << 27
#: Vectors that are searched at once.
ROWS = 4096


# -- vectors -----------------------------------------------------------------------


def _integers(column: str, size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            whole = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False) == size
            rows = batch.filter(pa.array(whole))
            values = rows.column(column).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
            good = np.isfinite(values).all(1)  # a null component is read as NaN
            with np.errstate(over="ignore"):
                scaled = np.floor(scale * values[good])
            if len(scaled) and np.abs(scaled).max() > WIDEST:
                raise ValueError(f"a component is beyond {WIDEST} after scaling")
            flat = pa.array(scaled.astype(np.int32).ravel())
            vector = pa.ListArray.from_arrays(pa.array(np.arange(len(scaled) + 1, dtype=np.int32) * size), flat)
            yield pa.RecordBatch.from_arrays([rows.column("id").filter(pa.array(good)), vector], names=["id", "vector"])

    return run


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


# -- the search --------------------------------------------------------------------


def _shape(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and deviation of each vector; from the mean first, so that deviations are right to 10 ** -6."""
    total = vectors.sum(1)
    return total, np.sqrt(((vectors - (total / vectors.shape[1])[:, None]) ** 2).sum(1))


class Search:
    """Nearest centroids of many vectors; `compared` counts the exact distances."""

    def __init__(self, centroids: np.ndarray):
        total, _ = _shape(centroids)
        self.order = np.argsort(total, kind="stable")
        self.centroids = centroids[self.order]
        self.total, self.deviation = _shape(self.centroids)
        self.compared = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid; of equally near ones the smallest number."""
        parts = [self._nearest(vectors[i : i + ROWS]) for i in range(0, len(vectors), ROWS)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many, size = len(self.centroids), vectors.shape[1]
        total, deviation = _shape(vectors)
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        winner = np.full(len(vectors), many)
        above = np.searchsorted(self.total, total)  # the next candidate on either side
        below = above - 1
        left = np.arange(len(vectors))
        while len(left):
            up, down = above[left], below[left]
            gap_up = np.where(up < many, np.abs(self.total[np.minimum(up, many - 1)] - total[left]), np.inf)
            gap_down = np.where(down >= 0, np.abs(total[left] - self.total[np.maximum(down, 0)]), np.inf)
            upward = gap_up <= gap_down
            gap = np.where(upward, gap_up, gap_down)
            mean = gap**2 / size
            # rounding of sums, roots and quotients stays far below one part in 10 ** 9
            limit = best[left] * (1 + 1e-9) + 1
            open_ = mean <= limit
            left, up, down, upward, mean, limit = (x[open_] for x in (left, up, down, upward, mean, limit))
            if not len(left):
                break
            candidate = np.where(upward, up, down)
            above[left] += upward
            below[left] -= ~upward
            spread = (self.deviation[candidate] - deviation[left]) ** 2
            near = (mean + spread) * (1 - 1e-9) <= limit + 1e-5 * (self.deviation[candidate] + deviation[left] + 1)
            rows, candidate = left[near], candidate[near]
            self.compared += len(rows)
            distance = ((vectors[rows] - self.centroids[candidate]) ** 2).sum(1)
            number = self.order[candidate]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < winner[rows]))
            best[rows[better]], winner[rows[better]] = distance[better], number[better]
        return winner, best


# -- Spark -------------------------------------------------------------------------


def _summed(centroids: np.ndarray):
    many, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        sums, counts = np.zeros((many, size), np.int64), np.zeros(many, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), size)
            cluster, _ = search.nearest(vectors)
            order = np.argsort(cluster, kind="stable")
            firsts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if len(order):
                sums[cluster[order][firsts]] += np.add.reduceat(vectors[order], firsts, axis=0)
            counts += np.bincount(cluster, minlength=many)
        here = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(np.repeat(here, size), pa.int32()),
                "component": pa.array(np.tile(np.arange(size), len(here)), pa.int32()),
                "total": pa.array(sums[here].ravel()),
                "vectors": pa.array(np.repeat(counts[here], size)),
            }
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            cluster, distance = search.nearest(_matrix(batch.column("vector"), centroids.shape[1]))
            arrays = [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, many: int, salt: str) -> np.ndarray:
    """The vectors with the smallest sha256 of `salt:id`, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    chosen = vectors.withColumn("digest", digest).orderBy(F.asc_nulls_last("digest"), "vector").limit(many)
    return np.array([r["vector"] for r in chosen.select("vector").collect()], np.int64)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floor of the mean of each centroid's vectors; without vectors the centroid itself."""
    sums = vectors.select("vector").mapInArrow(_summed(centroids), "cluster int, component int, total long, vectors long")
    whole = sums.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("vectors").alias("vectors")
    )
    out = centroids.copy()
    for row in whole.collect():  # at most one for each centroid and component
        out[row["cluster"], row["component"]] = int(row["total"]) // row["vectors"]
    return out


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centroids: int = CENTROIDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    rounds: int = ROUNDS,
    salt: str = SALT,
) -> tuple[DataFrame, np.ndarray]:
    """Clusters of vectors, as rows (id, cluster, distance), and the centroids that they were assigned to."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    kept = store(rows.mapInArrow(_integers("vector", components, scale), f"id {kind}, vector array<int>"), "vectors")
    middles = first_centroids(kept, centroids, salt)
    if not len(middles):
        return kept.selectExpr("id", "0 AS cluster", "0L AS distance"), middles
    for _ in range(rounds):
        middles = next_centroids(kept, middles)
    return kept.mapInArrow(_assigned(middles), f"id {kind}, cluster int, distance long"), middles


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each vector beside its cluster's and the whole inertia, and a digest of its centroid."""
    assigned = store(assigned, "assigned")
    found = assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # one row for each centroid
    inertia = {r["cluster"]: r["inertia"] for r in found}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    whole = sum(inertia.values())
    known = [(i, inertia[i], whole, digest[i]) for i in sorted(inertia)]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(known, names)), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
