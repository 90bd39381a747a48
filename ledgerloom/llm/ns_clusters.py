"""k-means on integer vectors with ns-bounds: exact assignments, few distances.

Method. Every vector keeps the squared distance to its own centroid and a lower bound of the distance to each other one, each
with the round in which it was last evaluated. All earlier centroids are retained; before a round a bound is loosened by the
norm of its centroid's total displacement since that evaluation, which is never more than the sum of the per-round drifts.
While the loosened lower bounds exceed the loosened upper one the vector stays where it is. Where one does not, the own distance is
evaluated, and then the distances to all centroids that still fail, in whole numbers; ties go to the smaller number. Bounds are
floating-point numbers rounded away from the claim they support, so that they only save work and never decide.

Cost. Vectors are never shuffled: a round reads them with their bounds, writes them again, and adds up 64 sums a cluster in parts.
The driver sees the centroids and one row per cluster.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import write_shared

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
#: Components stay below this in magnitude, so that a squared distance of 64 components fits a long.
LARGEST = 1 << 27
_SLACK = 1e-6


def _usable(vector: Column) -> Column:
    """Exactly 64 components, all finite and small enough. NaN compares as the largest number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(SCALE * x.cast("double")) < LARGEST))
    return F.coalesce((F.size(vector) == DIMENSIONS) & fine, F.lit(False))


def integer_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, v): the rows that have a usable vector, each component floor(64 x)."""
    whole = F.transform(F.col(vector), lambda x: F.floor(SCALE * x.cast("double")).cast("int"))
    return vectors.where(_usable(F.col(vector))).select(F.col(key).alias("id"), whole.alias("v"))


def starts(points: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the least sha256; rows without an id come last, equal hashes by their vectors."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.orderBy(order.asc_nulls_last(), "v").select("v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def assign(v: np.ndarray, state, history: list[np.ndarray], finish: bool = False):
    """The state of the vectors `v` in the round of the last centroids in `history`, and how many distances were evaluated.

    A state is (cluster, near, near_at, lower, lower_at); None before the first round. `near` is the squared distance to the own centroid in
    round `near_at`. With `finish` it is that of this round for all.
    """
    now, centroids = len(history) - 1, history[-1]
    n, k = len(v), len(centroids)
    exact = lambda rows, j: ((v[rows] - centroids[j]) ** 2).sum(1)
    if state is None:
        every = np.arange(n)
        d = np.stack([exact(every, j) for j in range(k)], 1)
        cluster = d.argmin(1)
        at = np.full((n, k), now, np.int8)
        return (cluster.astype(np.int32), d[every, cluster], np.full(n, now, np.int8), _below(np.sqrt(d)), at), n * k
    cluster, near, near_at, lower, lower_at = (x.copy() for x in state)
    moved = np.stack([np.sqrt(((centroids - c) ** 2).sum(1).astype(float)) for c in history])  # round, centroid
    upper = np.sqrt(near) + moved[near_at, cluster]
    loose = lower - moved[lower_at, np.arange(k)]
    loose[np.arange(n), cluster] = np.inf
    doubtful = np.flatnonzero((loose <= (upper + _SLACK * (1 + upper))[:, None]).any(1))
    again = np.arange(n) if finish else doubtful
    for j in np.unique(cluster[again]):
        own = again[cluster[again] == j]
        near[own], near_at[own] = exact(own, j), now
    evaluated = len(again)
    upper = np.sqrt(near[doubtful])
    fails = loose[doubtful] <= (upper + _SLACK * (1 + upper))[:, None]
    before, own_near = cluster.copy(), near.copy()
    for j in range(k):
        rows = doubtful[fails[:, j]]
        d = exact(rows, j)
        lower[rows, j], lower_at[rows, j] = _below(np.sqrt(d)), now
        better = (d < near[rows]) | ((d == near[rows]) & (j < cluster[rows]))
        cluster[rows[better]], near[rows[better]] = j, d[better]
        evaluated += len(rows)
    left = np.flatnonzero(cluster != before)
    lower[left, before[left]], lower_at[left, before[left]] = _below(np.sqrt(own_near[left])), now
    return (cluster, near, near_at, lower, lower_at), evaluated


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _list(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))


def _assigned(points: DataFrame, history: list[np.ndarray], finish: bool) -> DataFrame:
    kind = points.schema["id"].dataType.simpleString()
    dimensions, k, first = history[0].shape[1], len(history[0]), "cluster" not in points.columns

    def run(stream):
        for batch in stream:
            if not batch.num_rows:
                continue
            v, state = _matrix(batch["v"], dimensions, np.int64), None
            if not first:
                state = (batch["cluster"].to_numpy(), batch["near"].to_numpy(), batch["near_at"].to_numpy(),
                         _matrix(batch["lower"], k, np.float32), _matrix(batch["lower_at"], k, np.int8))
            (cluster, near, near_at, lower, lower_at), evaluated = assign(v, state, history, finish)
            work = np.full(len(v), evaluated / len(v))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["v"], pa.array(cluster), pa.array(near), pa.array(near_at), _list(lower), _list(lower_at), pa.array(work)],
                names=["id", "v", "cluster", "near", "near_at", "lower", "lower_at", "evaluated"])

    columns = [c for c in ("id", "v", "cluster", "near", "near_at", "lower", "lower_at") if c in points.columns]
    return points.select(columns).mapInArrow(
        run, f"id {kind}, v array<int>, cluster int, near long, near_at tinyint, lower array<float>, lower_at array<tinyint>, evaluated double")


def _means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Componentwise floor of sum over count; empty clusters stay."""
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(before.shape[1])]
    after = before.copy()
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # one row a cluster
        after[r.cluster] = [r[f"s{i}"] // r.n for i in range(before.shape[1])]
    return after


def cluster(points: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance, evaluated) per row of `points` (id, v: whole numbers, all of one length), and the final centroids.

    Every round assigns all vectors and moves the centroids; then vectors are assigned once more. `distance` is squared; `evaluated` is the
    number of exact distances that the last assignment took for a vector on average. Fewer vectors than `clusters` give as many centroids; none
    give an empty result. Equal vectors and repeated rows each count, a null id stays null. One state a round is written to the shared folder.
    """
    history = [starts(points, clusters, seed)]
    if not len(history[0]):
        empty = points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0.0).alias("evaluated"))
        return empty.limit(0), history[0]
    state = points
    for _ in range(rounds):
        state = write_shared(_assigned(state, history, False), "ns-state")
        history.append(_means(state, history[-1]))
    last = _assigned(state, history, True)
    return write_shared(last.select("id", "cluster", F.col("near").alias("distance"), "evaluated"), "ns-last"), history[-1]


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per row that has a usable vector.

    Rows whose vector is null, has another length, or holds a null, a non-finite number or one of 2^21 and more in magnitude (whose squared
    distances no long holds) are left out. Repeated rows come back repeated, null ids null; other columns are not read. An inertia beyond a
    long is null. An empty table gives an empty result.
    """
    assigned, centroids = cluster(integer_vectors(vectors, vector, key), clusters, rounds)
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda x: int(x) if x < 1 << 63 else None
    total = fits(sum(sums.values()))
    rows = [(j, fits(s), total, centroid_digest(centroids[j])) for j, s in sorted(sums.items())]
    named = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(  # one row a cluster
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
