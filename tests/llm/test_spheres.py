import hashlib
import math

import numpy as np
import pytest

from strata.llm.sphere_clusters import EXACT, MOST, Move, cluster_embeddings, cluster_vectors, drifts, first_centroids, squared_distances, step_block

SCHEMA = "vec_id long, embedding array<double>, cluster int, block string, state string"


def brute(rows, dims, k, rounds=10, scale=1024, seed=3):
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cs = [v for _, v in first]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        cs = [[sum(x) // own.count(j) for x in zip(*(v for (_, v), o in zip(kept, own) if o == j))] if j in own else c for j, c in enumerate(cs)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    each = {j: sum(d for _, o, d in out if o == j) for _, j, _ in out}
    return sorted((repr(i), j, min(d, MOST), min(each[j], MOST), min(sum(each.values()), MOST), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for i, j, d in out)


def got(df):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def rows_of(pick, n, dims, centers=6):
    middle = pick.normal(0, 1, (centers, dims))
    return [(i, [float(x) for x in middle[i % centers] + pick.normal(0, 0.2, dims)]) for i in range(n)]


def test_clusters_ties_copies_nulls_and_other_lengths(spark):
    rows = rows_of(np.random.default_rng(1), 400, 5)
    rows += [(1000 + i, [0.5] * 5) for i in range(60)] + [(7, [9.0] * 5), (7, [9.0] * 5), (None, [1.0] * 5), (None, [-2.0] * 5), ((1 << 60) + 1, [0.25] * 5)]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 4), (2003, [1.0, None, 0.0, 0.0, 0.0]), (2004, [float("nan")] * 5), (2005, [float("-inf")] * 5)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows + bad], SCHEMA)
    assert got(cluster_embeddings(df, 5, k=8)) == brute(rows + bad, 5, 8)


def test_few_equal_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    assert got(cluster_embeddings(df, 2, k=8)) == brute(rows, 2, 8)
    assert got(cluster_embeddings(df.limit(1), 2, k=8))[0][1:3] == (0, 0)
    assert cluster_embeddings(df.where("vec_id < 0"), 2).count() == 0


def test_components_beyond_doubles(spark):
    rows = [(i, [x * 1e13, -x * 3e12 + i]) for i, x in enumerate((1.0, 1.0, -2.0, 5.5, 5.25, 7.0))] + [(9, [1e300, 0.0]), (10, [-1e300, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    limited = [(i, [min(max(x, -(2.0**53)), 2.0**53) if abs(x) > 1e200 else x for x in v]) for i, v in rows]
    out = got(cluster_embeddings(df, 2, k=3))
    assert len(out) == 8 and all(0 <= r[2] <= MOST for r in out)
    assert got(cluster_embeddings(df.where("vec_id < 9"), 2, k=3)) == brute(limited[:6], 2, 3)


def test_drifts_bound_what_a_sphere_can_lose_and_are_below_full_drift():
    pick = np.random.default_rng(2)
    for _ in range(60):
        old = pick.normal(0, 3, (4, 6))
        new, radius = old + pick.normal(0, 1, (4, 6)) * pick.choice([0, 0.1, 2], (4, 1)), np.abs(pick.normal(0, 2, 4))
        bound = drifts(old, new, radius)
        assert (bound <= np.sqrt(((new - old) ** 2).sum(axis=1)) + 1e-9).all()
        for a in range(4):
            x = pick.normal(0, 1, (500, 6))
            x = old[a] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[a] * pick.random((500, 1)) ** (1 / 6)
            for j in range(4):
                if j != a:
                    came = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                    assert came.max() <= bound[a, j] + 1e-9


def test_far_clusters_lose_less_than_the_full_drift():
    old = np.array([[0.0, 0.0], [10.0, 0.0]])
    assert drifts(old, np.array([[0.0, 0.0], [10.0, 3.0]]), np.array([1.0, 1.0]))[0, 1] < 0.8  # of a drift of 3
    assert drifts(old, np.array([[0.0, 0.0], [13.0, 0.0]]), np.array([1.0, 1.0]))[0, 1] == pytest.approx(0, abs=1e-12)  # away from the sphere


def test_bounds_save_scans(spark):
    rows = rows_of(np.random.default_rng(4), 600, 8)
    df = spark.createDataFrame([(i, [math.floor(x * 1024) for x in v]) for i, v in rows], "vec_id long, v array<long>")
    found = cluster_vectors(df, first_centroids(df, 6, 3))
    assert found.scanned[0] == 600 and sum(found.scanned[1:]) < 600 * (len(found.scanned) - 1) / 2


def test_step_keeps_what_is_certain():
    x = np.array([[0, 0], [1, 0], [100, 0]])
    state, scanned = step_block(x, None, Move(np.array([[0, 0], [100, 0]])))
    assert state["cluster"].tolist() == [0, 0, 1] and len(scanned) == 3
    again, scanned = step_block(x, state, Move(np.array([[0, 0], [99, 0]]), np.array([0.0, 1.0]), np.array([1.0, 0.0])))
    assert again["cluster"].tolist() == [0, 0, 1] and not len(scanned)


def test_large_distances_are_exact():
    x = np.array([[EXACT * 8 + 1, 3], [-EXACT * 1024, 7]])
    assert squared_distances(x, x[:1]).tolist() == [[0], [((EXACT * 8 + 1) + EXACT * 1024) ** 2 + 16]]


def test_the_table_of_blocks_is_dropped(spark):
    df = spark.createDataFrame([(i, [i, 0]) for i in range(30)], "vec_id long, v array<long>")
    cluster_vectors(df, [[0, 0], [20, 0]])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("strata_blocks")]
