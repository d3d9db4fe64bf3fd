import math

import numpy as np
from pyspark.sql import functions as F

from strata.llm.impact_search import build_index, exact_top_k, quantise, search, search_block


def brute(rows, wanted, k):
    vectors = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(float(x) * 256) for x in v]
        vectors[key] = min(vectors.get(key, q), q)
    out = set()
    for q in vectors:
        if wanted(q):
            score = lambda c: sum(a * b for a, b in zip(vectors[q], vectors[c]))
            best = sorted((-score(c), c) for c in vectors if c != q)[:k]
            out |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(best)}
    return out


def as_set(df):
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()}


def test_ties_copies_nulls_and_lengths(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(x) for x in pick.normal(0, 0.3, 8)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)] + [(2000 + i, [0.0] * 8) for i in range(5)]
    rows += [(1, [9.0] * 8), (1, [9.0] * 8), (3000, None), (3001, [1.0, None] + [0.0] * 6), (3002, [float("nan")] * 8), (3003, [float("inf")] * 8), (None, [1.0] * 8), (3004, []), (3005, [0.25, -0.25])]
    df = spark.createDataFrame([(*r, 1, "g") for r in rows], "vec_id long, embedding array<double>, block int, g string")
    assert as_set(exact_top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows, lambda k: k % 50 == 0, 5)


def test_many_blocks_and_groups(spark):
    pick = np.random.default_rng(4)
    rows = [(i, [int(x) for x in pick.integers(-90, 90, 6)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = search(build_index(df, 4, block_rows=16), df.where("vec_id % 7 = 0"), 3, group_rows=5)
    assert as_set(got) == brute([(k, [x / 256 for x in v]) for k, v in rows], lambda k: k % 7 == 0, 3)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert as_set(exact_top_k(df, F.col("vec_id") == 0)) == {(0, 1, 1, 256 * 512)}
    assert exact_top_k(df.where("vec_id < 0"), F.lit(True)).count() == 0
    empty = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<float>")
    assert as_set(exact_top_k(empty, F.lit(True))) == {(0, 1, 1, 0), (1, 1, 0, 0)}


def test_a_search_stops_before_the_last_segment_when_members_are_proven(spark):
    rows = [(i, [1000 + i, 0, 0, 0]) for i in range(6)] + [(10 + i, [i % 9, i % 5, i % 7, 1]) for i in range(500)]
    index = build_index(spark.createDataFrame(rows, "vec_id long, v array<long>"), 4).collect()[0].asDict()
    members, vectors, done = search_block(index, np.array([[5, 0, 0, 0]], np.int64), 3)
    assert done < np.count_nonzero(vectors) / 10 and set(vectors[members[0], 0]) >= {1005, 1004, 1003}


def test_fewer_than_half_of_the_postings_are_processed_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", quantise(F.col("embedding")).alias("v"))
    index = build_index(rows, 6)
    queries = np.array([r.v for r in rows.where("vec_id % 50 = 0").orderBy("vec_id").collect()], np.int64)
    for block in index.collect():
        members, vectors, done = search_block(block.asDict(), queries, 5)
        postings = np.count_nonzero(vectors)
        assert done < 0.5 * postings * len(queries)
        scores = queries @ vectors.T
        assert all(set(np.argsort(-s, kind="stable")[:6]) <= set(m) for s, m in zip(scores, members))
        _, _, again = search_block(block.asDict(), queries, 5, np.sort(scores, axis=1)[:, -6])
        assert again < done  # scores known from other blocks prune more


def test_floors_of_the_first_blocks_leave_results_as_they_are(spark):
    pick = np.random.default_rng(6)
    rows = [(i, [int(x) for x in pick.integers(-90, 90, 6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = search(build_index(df, 4, block_rows=20), df.where("vec_id % 3 = 0"), 3, group_rows=4, first_blocks=2)
    assert as_set(got) == brute([(k, [x / 256 for x in v]) for k, v in rows], lambda k: k % 3 == 0, 3)


def test_scores_beyond_doubles_and_longs_are_exact(spark):
    big = 1 << 40
    rows = [(0, [big, 1]), (1, [big, 5]), (2, [big, 4]), (3, [big, -7]), (4, [-big, 0]), (5, [1 << 23, 0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    clip = lambda x: max(min(x, (1 << 63) - 1), -(1 << 63))
    want = {(0, n + 1, c, clip(s)) for n, (s, c) in enumerate(sorted(((big * v[0] + v[1], k) for k, v in rows[1:]), key=lambda t: (-t[0], t[1])))}
    assert as_set(search(build_index(df, 6), df.where("vec_id = 0"), 5)) == {(q, r, c, s) for q, r, c, s in want}


def test_components_beyond_longs_are_the_largest(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    most = (1 << 63) - 1
    assert as_set(exact_top_k(df, F.col("vec_id") == 0)) == {(0, 1, 2, most), (0, 2, 1, -most - 1)}
