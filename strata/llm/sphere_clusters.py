"""Exact k-means whose distance bounds are loosened by the geometry of clusters.

For every vector an upper bound of the distance to its own centroid and a lower
bound of that to all others are kept. When centroids move, the upper bound grows
by the own one's drift, and the lower one shrinks by the most that any other
centroid can have come nearer. That is less than its full drift: the vectors of
a cluster lie in a sphere (center c, radius r) around its old centroid. For a
centroid that moved from p to q by d, with middle m = (p + q) / 2,

    |x - p| - |x - q| = 2 d t / (|x - p| + |x - q|) <= d cos(angle of x - m with q - p),

as t, the part of x - m along the move, is |x - m| times that cosine and the sum
of the two distances is at least 2 |x - m|. In the plane of m, q and c the sphere
is seen from m within asin(r / |c - m|) of the direction to c, so the largest
cosine in it is known; a centroid that moves away comes no nearer at all.
Vectors whose bounds don't meet keep their cluster unread; the others are
scanned exactly in integers.

Vectors lie in blocks of a table bucketed by block, written once. A round joins
it with the blocks' bounds (18 bytes a vector), which alone are shuffled and
written anew, and adds up what the vectors that changed their cluster take from
one sum and bring to another.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import plain_key, restore_key, shuffle_width, staged
from strata.llm.impact_search import quantise
from strata.session import scratch_path

#: Blocks (of up to a thousand vectors) of a bucket of the table of vectors, where there are more than shuffle partitions.
BUCKET_BLOCKS = 256
#: Blocks that a Python step is handed at a time: half a megabyte each at 64 dimensions.
BATCH_BLOCKS = 16
#: Components up to this keep squared distances in 64 dimensions exact in double precision; larger ones are computed with Python's integers.
EXACT = 1 << 22
#: The largest value of a result column; greater sums are given as this.
MOST = (1 << 63) - 1

_STATE = np.dtype([("cluster", "<i2"), ("upper", "<f8"), ("lower", "<f8")])
#: Relative room left for rounding in every bound.
_ROOM = 1e-9


def drifts(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[a, j]: the most that centroid j can have come nearer to any vector in the sphere of cluster a (a itself: 0)."""
    k = len(old)
    move = new - old
    length = np.sqrt((move * move).sum(axis=1))
    out = np.zeros((k, k))
    for j in np.flatnonzero(length > 0):
        to = old - (old[j] + new[j]) / 2  # from the middle of the move to the spheres' centers
        far = np.sqrt((to * to).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip(to @ move[j] / (far * length[j]), -1, 1))
            seen = np.arcsin(np.clip(radius / far, 0, 1))
        nearest = np.cos(np.clip(angle - seen, 0, np.pi / 2))
        out[:, j] = length[j] * np.where((far > 0) & (radius < far), nearest, 1.0)
        out[j, j] = 0
    return out


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact: doubles that hold integers, or Python's integers where those can't."""
    most = max((int(abs(x).max()) if x.size else 0 for x in (vectors, centroids)), default=0)
    if most <= EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    x, c = vectors.astype(object), centroids.astype(object)
    return np.stack([((x - y) * (x - y)).sum(axis=1) for y in c], axis=1) if len(x) else np.zeros((0, len(c)))


@dataclass
class Move:
    """What a round must know: the centroids, and how the bounds loosen since the round before (None in the first)."""

    centroids: np.ndarray
    drift: np.ndarray | None = None
    nearer: np.ndarray | None = None


def _unsure(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Those of ``rows`` whose bounds meet."""
    return rows[state["upper"][rows] * (1 + _ROOM) >= state["lower"][rows] * (1 - _ROOM)]


def step_block(vectors: np.ndarray, state: np.ndarray | None, move: Move) -> tuple[np.ndarray, np.ndarray]:
    """The block's new state and the indices of vectors that were scanned."""
    centroids = move.centroids
    k = len(centroids)
    if state is None:
        state = np.zeros(len(vectors), _STATE)
        unsure = np.arange(len(vectors))
    else:
        state = state.copy()
        own = state["cluster"]
        state["upper"] += move.drift[own]
        state["lower"] -= move.nearer[own]
        unsure = _unsure(state, np.arange(len(state)))
        if len(unsure):  # the exact own distance may already settle it
            x, c = vectors[unsure], centroids[own[unsure]]
            x, c = (x, c) if max(abs(x).max(), abs(centroids).max()) <= EXACT else (x.astype(object), c.astype(object))
            state["upper"][unsure] = np.sqrt(((x - c) ** 2).sum(axis=1).astype(np.float64))
            unsure = _unsure(state, unsure)
    if len(unsure):
        d = squared_distances(vectors[unsure], centroids)
        best = np.argmin(d, axis=1)  # the first of equal ones: the smaller number
        roots = np.sqrt(d.astype(np.float64))
        rows = np.arange(len(unsure))
        upper = roots[rows, best]
        roots[rows, best] = np.inf
        state["cluster"][unsure], state["upper"][unsure] = best, upper
        state["lower"][unsure] = roots.min(axis=1) if k > 1 else np.inf
    return state, unsure


@dataclass
class Clusters:
    """The result: ``rows`` (vec_id, cluster, distance; staged), final centroids, and the vectors scanned in each round."""

    rows: DataFrame
    centroids: list[list[int]]
    scanned: list[int] = field(default_factory=list)


def _blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of the vectors, as they come: block, n, ids, no_ids, matrix (long components)."""

    def cut(batches):
        task, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            if len(batch):
                matrix = np.stack(batch["v"].to_numpy()).astype("<i8")
                yield pd.DataFrame({"block": [(task << 32) + nth], "n": [len(batch)], "ids": [batch["vec_id"].to_numpy("<i8").tobytes()], "no_ids": [batch["no_key"].to_numpy(np.uint8).tobytes()], "matrix": [matrix.tobytes()]})
                nth += 1

    return plain_key(vectors, "vec_id", "v").mapInPandas(cut, "block long, n int, ids binary, no_ids binary, matrix binary")


def _bucketed(blocks: DataFrame) -> str:
    """The name of a table of ``blocks``, bucketed by block: joins on block shuffle the other side only."""
    spark = blocks.sparkSession
    blocks = staged(blocks, "vector-blocks")
    n = blocks.count()
    buckets = max(1, min(max(shuffle_width(spark), -(-n // BUCKET_BLOCKS)), n))
    name = f"strata_blocks_{uuid4().hex[:12]}"
    blocks.repartition(buckets, "block").write.bucketBy(buckets, "block").sortBy("block").option("path", scratch_path(spark, "vector-buckets")).saveAsTable(name)
    return name


def cluster_vectors(vectors: DataFrame, starts: list[list[int]], rounds: int = 10) -> Clusters:
    """k-means of ``vectors`` (vec_id, v: equally long lists of longs) from the centroids ``starts``, in integers.

    Each round assigns every vector to the nearest centroid (ties: the smaller
    number) and replaces every non-empty centroid by its vectors'
    componentwise floor(sum / count); a last assignment follows. Once no
    centroid moves, further rounds would change nothing and are left out.
    """
    spark = vectors.sparkSession
    dims, k = len(starts[0]), len(starts)
    name = _bucketed(_blocks(vectors))
    try:
        table = spark.table(name)

        def matrix_of(row) -> np.ndarray:
            return np.frombuffer(row["matrix"], "<i8").reshape(-1, dims)

        def joined(state: DataFrame | None, columns: list[str]) -> DataFrame:
            if state is None:
                return table.select("block", *columns, F.lit(None).cast("binary").alias("state"))
            return table.select("block", *columns).join(state.select("block", "state").hint("shuffle_hash"), "block")

        def rounds_step(move: Move):
            def run(batches):
                for batch in batches:
                    for row in batch.to_dict("records"):
                        x = matrix_of(row)
                        before = None if row["state"] is None else np.frombuffer(row["state"], _STATE)
                        after, unsure = step_block(x, before, move)
                        moved = unsure if before is None else unsure[before["cluster"][unsure] != after["cluster"][unsure]]
                        sums = [[0] * (dims + 1) for _ in range(k)]
                        for sign, which in ((1, after), (-1, before)):
                            for j in np.unique(which["cluster"][moved]).tolist() if which is not None else []:
                                some = moved[which["cluster"][moved] == j]
                                part = x[some].astype(object) if abs(x[some]).max(initial=0) > EXACT else x[some]
                                for at, v in enumerate([len(some), *part.sum(axis=0).tolist()]):
                                    sums[j][at] += sign * int(v)
                        radius = [float(after["upper"][after["cluster"] == j].max(initial=0)) for j in range(k)]
                        changes = [(j * (dims + 1) + at, str(v)) for j, s in enumerate(sums) for at, v in enumerate(s) if v]
                        yield pd.DataFrame({"block": [row["block"]], "state": [after.tobytes()], "scanned": [len(unsure)], "radius": [radius], "at": [[a for a, _ in changes]], "change": [[v for _, v in changes]]})

            return run

        centroids = [list(c) for c in starts]
        totals = [[0] * (dims + 1) for _ in range(k)]
        state, move, scanned = None, Move(np.array(centroids, np.int64)), []
        for _ in range(rounds):
            parts = joined(state, ["matrix"]).mapInPandas(rounds_step(move), "block long, state binary, scanned long, radius array<double>, at array<int>, change array<string>")
            state = staged(parts, "bounds", BATCH_BLOCKS)
            for r in state.select(F.explode(F.arrays_zip("at", "change")).alias("x")).groupBy("x.at").agg(F.sum(F.col("x.change").cast("decimal(38,0)")).alias("s")).collect():  # k * (dims + 1) rows
                totals[r["at"] // (dims + 1)][r["at"] % (dims + 1)] += int(r["s"])
            seen = state.agg(F.sum("scanned"), *(F.max(F.get("radius", F.lit(j))) for j in range(k))).first()
            scanned.append(int(seen[0] or 0))
            after = [[v // t[0] for v in t[1:]] if t[0] else c for c, t in zip(centroids, totals)]
            old, new = (np.array(c, dtype=object).astype(np.float64) for c in (centroids, after))
            nearer = drifts(old, new, np.array([r or 0.0 for r in seen[1:]]) * (1 + _ROOM))
            drift = np.sqrt(((new - old) ** 2).sum(axis=1))
            still, centroids = after == centroids, after
            move = Move(np.array(centroids, dtype=object).astype(np.int64), drift * (1 + _ROOM), nearer.max(axis=1) * (1 + _ROOM))
            if still:
                break

        def last(batches):
            for batch in batches:
                for row in batch.to_dict("records"):
                    x = matrix_of(row)
                    after, _ = step_block(x, None if row["state"] is None else np.frombuffer(row["state"], _STATE), move)
                    own = after["cluster"].astype(np.int64)
                    if max(abs(x).max(initial=0), abs(move.centroids).max(initial=0)) <= EXACT:
                        d = ((x - move.centroids[own]) ** 2).sum(axis=1).tolist()
                    else:
                        d = ((x.astype(object) - move.centroids.astype(object)[own]) ** 2).sum(axis=1).tolist()
                    yield pd.DataFrame({"vec_id": np.frombuffer(row["ids"], "<i8"), "no_key": np.frombuffer(row["no_ids"], np.uint8) > 0, "cluster": own.astype(np.int32), "distance": [min(int(v), MOST) for v in d]})

        rows = joined(state, ["ids", "no_ids", "matrix"]).mapInPandas(last, "vec_id long, no_key boolean, cluster int, distance long")
        rows = staged(restore_key(rows, "vec_id").select("vec_id", "cluster", "distance"), "clusters", BATCH_BLOCKS)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return Clusters(rows, centroids, scanned)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the ``k`` smallest hashes of ``seed`` and id, in that order; rows that repeat an id by their components."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v")
    return [list(r["v"]) for r in hashed.orderBy("h", "v").limit(k).collect()]


def cluster_embeddings(rows: DataFrame, dims: int = 64, scale: int = 1024, k: int = 8, seed: int = 3, rounds: int = 10) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of the vectors of ``rows`` (vec_id, embedding) with ``dims`` components, none null or non-finite.

    Null and repeated ids are clustered like any other row; with fewer than
    ``k`` vectors there are fewer centroids; sums beyond the range of a long
    are given as the largest one; other columns are ignored; without vectors
    there are no rows.
    """
    v = quantise(F.col("embedding"), scale)
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.size("v") == dims)
    starts = first_centroids(kept, k, seed)
    spark = rows.sparkSession
    if not starts:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    found = cluster_vectors(kept, starts, rounds)
    sums = {r["cluster"]: int(r["s"]) for r in found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    facts = [(j, min(s, MOST), min(sum(sums.values()), MOST), hashlib.sha256(",".join(map(str, found.centroids[j])).encode()).hexdigest()) for j, s in sums.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
