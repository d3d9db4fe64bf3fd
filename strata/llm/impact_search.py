"""Exact top-k inner products from an impact-ordered index, score at a time.

Every component of a vector is an integer. The index holds blocks of vectors;
a block's postings (dimension, vector, value) lie in segments by quantised
impact: segment s holds the values with |value| // step == s. A search goes
through a block's segments by descending impact for a group of queries at once
and adds each segment to the accumulators. What is unseen of a vector and of the
query, in the vector's unseen dimensions, bounds the rest by Cauchy-Schwarz:

    accumulator - slack <= score <= accumulator + slack,
    slack = |unseen part of the query| * |unseen part of the vector|.

The query's floor is the k-th score known so far: at first the one that the
blocks searched before have left, then the k-th lower bound; and the vectors that
look best after a segment are scored exactly to raise it. A vector whose upper bound is below the floor cannot
be a member, which is proof, so that query leaves it out of all later segments;
once few are possible, those are scored exactly and the rest of the segments is
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.common import shuffle_width, staged

#: Vectors of an index block, and queries of a group: their product bounds a task's accumulators.
BLOCK_ROWS = 4096
GROUP_ROWS = 256
#: Query groups that meet one copy of a block's postings.
CHUNK_GROUPS = 4
#: Blocks searched first; their k-th scores are the floors of all others.
FIRST_BLOCKS = 4
#: Impact segments of a block.
SEGMENTS = 32
#: Shares of a block's postings after which bounds are tested, at the last segment before each.
TESTED = (0.01, 0.12, 0.3, 0.38, 0.46, 0.56, 0.75, 1.0)
#: Share of a block's vectors that a group must still need for segments to be added for the whole group.
TOGETHER = 0.5
#: Sum of absolute products up to which doubles hold scores exactly; beyond, all are computed with Python's integers.
EXACT = 1 << 52

#: Rows that a Python step of a search is handed at a time: an index block takes some megabytes.
BATCH_BLOCKS = 8
#: The largest long.
MOST = (1 << 63) - 1

INDEX_SCHEMA = "block long, n long, dims int, step long, ids binary, copies binary, segment_ends binary, dim binary, row binary, value binary"
MATCH_SCHEMA = "query_id long, vec_id long, score long"


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component in double precision, within -MOST and MOST; null for a vector that is null or holds null or a non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.greatest(F.floor(x.cast("double") * scale).cast("long"), F.lit(-MOST))))


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def build_index(vectors: DataFrame, copies: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The staged index of ``vectors`` (vec_id, v), one row per block.

    Equal vectors of a block share one entry that keeps the ``copies``
    smallest ids: ties go to smaller ids, so no other one can be a member.
    """
    n_blocks = max(1, -(-vectors.count() // block_rows))

    def build(key, rows):
        rows = rows.sort_values("vec_id")
        dims = max(1, *map(len, rows["v"]))
        matrix, ids = _matrix(rows["v"], dims), rows["vec_id"].to_numpy(np.int64)
        _, first, member = np.unique(matrix, axis=0, return_index=True, return_inverse=True)
        member = member.reshape(-1)
        order = np.argsort(member, kind="stable")  # ids ascend within an entry
        nth = np.arange(len(order)) - np.searchsorted(member[order], member[order])
        order = order[nth < copies]
        matrix = matrix[first]
        size = np.abs(matrix)
        step = max(1, -(-(int(size.max(initial=0)) + 1) // SEGMENTS))
        row, dim = np.nonzero(matrix)
        segment = size[row, dim] // step
        by_impact = np.lexsort((row, dim, -segment))
        ends = np.cumsum(np.bincount(segment, minlength=SEGMENTS)[::-1])
        return pd.DataFrame({
            "block": [int(key[0])], "n": [len(matrix)], "dims": [dims], "step": [step], "ids": [ids[order].tobytes()],
            "copies": [np.bincount(member[order], minlength=len(matrix)).tobytes()], "segment_ends": [ends.astype(np.int64).tobytes()],
            "dim": [dim[by_impact].astype(np.int32).tobytes()], "row": [row[by_impact].astype(np.int32).tobytes()],
            "value": [matrix[row, dim][by_impact].tobytes()],
        })

    blocks = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))).select("block", "vec_id", "v")
    return staged(blocks.groupBy("block").applyInPandas(build, INDEX_SCHEMA), "impact-index")


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer scores; of any size, where 64 bits can't hold them."""
    if int(abs(vectors).max(initial=0)) * int(abs(query).astype(object).sum()) < EXACT:
        return vectors @ query
    return vectors.astype(object) @ query.astype(object)


def search_block(block: dict, queries: np.ndarray, k: int, floors: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, int]:
    """Possible members of each query (entry numbers), the entries' vectors, and how many times a posting was processed for a query.

    ``floors``: scores that k other vectors at least are known to reach (-inf: none).
    """
    n, dims = block["n"], max(block["dims"], queries.shape[1])
    ends = np.frombuffer(block["segment_ends"], np.int64)
    dim, row, value = (np.frombuffer(block[c], t) for c, t in (("dim", np.int32), ("row", np.int32), ("value", np.int64)))
    vectors = np.zeros((n, dims), np.int64)
    vectors[row, dim] = value
    exact_q = np.zeros((len(queries), dims), np.int64)
    exact_q[:, : queries.shape[1]] = queries
    if int(abs(value).max(initial=0)) * int(abs(exact_q).astype(object).sum(axis=1).max(initial=0)) >= EXACT:
        return [np.arange(n) for _ in exact_q], vectors, len(value) * len(queries)
    q, x = exact_q.astype(np.float64), vectors.astype(np.float64)
    floor = np.full(len(q), -np.inf) if floors is None else floors.astype(np.float64)
    best = np.full((len(q), k + 1), -np.inf)  # scored so far; one more than k, as the query's own vector may be among them
    total, rest_q = np.zeros((len(q), n)), np.tile((q * q).sum(axis=1, keepdims=True), (1, n))
    rest_v = (x * x).sum(axis=1)
    possible, scored = np.ones((len(q), n), bool), np.zeros((len(q), n), bool)
    few, start, done = 3 * (k + 1), 0, 0
    rows = np.arange(len(q))[:, None]

    def raise_floors(sums: np.ndarray, low: np.ndarray) -> None:
        """From the k-th lower bound, and exact scores of what looks best."""
        np.maximum(floor, np.partition(low, n - k - 1, axis=1)[:, n - k - 1], out=floor)
        top = np.argpartition(sums, max(0, n - few), axis=1)[:, max(0, n - few) :]
        found = np.where(scored[rows, top] | ~possible[rows, top], -np.inf, np.einsum("qd,qkd->qk", q, x[top]))
        scored[rows, top] = True
        best[:] = np.partition(np.hstack([best, found]), found.shape[1], axis=1)[:, found.shape[1] :]
        np.maximum(floor, best[:, 0], out=floor)

    def slack_of(rest: np.ndarray, ends_at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(rest, 0)) * ends_at * (1 + 1e-9) + 1e-6

    part, left, alone = np.zeros((n, dims)), rest_v, None
    for s, end in _stops(ends):
        r, d, v = row[start:end], dim[start:end], value[start:end]
        start = end
        part[:] = 0
        part[r, d] = v
        held, each = part != 0, np.bincount(r, minlength=n)
        left = left - (part * part).sum(axis=1)
        ends_at = np.sqrt(np.maximum(left, 0))
        if alone is None:
            total += q @ part.T
            rest_q -= (q * q) @ held.T
            done += len(r) * len(q)
            slack = slack_of(rest_q, ends_at)
            sums = np.where(possible, total, -np.inf)
            if s < len(TESTED) - 1 and n > k:
                if s > 1:  # the sums tell by now what looks best
                    done += min(few, n) * dims * len(q)
                    raise_floors(sums, sums - slack)
                else:
                    np.maximum(floor, np.partition(sums - slack, n - k - 1, axis=1)[:, n - k - 1], out=floor)
            possible &= total + slack >= floor[:, None]
            if possible.mean() < TOGETHER:
                alone = [np.flatnonzero(p) for p in possible]
        else:  # each query has its own vectors left
            for i, at in enumerate(alone):
                if len(at) <= few:
                    continue
                total[i, at] += part[at] @ q[i]
                rest_q[i, at] -= held[at] @ (q[i] * q[i])
                done += int(each[at].sum())
                sums, slack = total[i, at], slack_of(rest_q[i, at], ends_at[at])
                top = at[np.argpartition(sums, -(k + 1))[-(k + 1) :]]
                top = top[~scored[i, top]]
                scored[i, top] = True
                best[i] = np.partition(np.append(best[i], x[top] @ q[i]), len(top))[len(top) :]
                done += len(top) * dims
                floor[i] = max(floor[i], best[i, 0], np.partition(sums - slack, -(k + 1))[-(k + 1)])
                alone[i] = at[sums + slack >= floor[i]]
        if alone is not None and max(map(len, alone)) <= few:
            break
    members = [np.flatnonzero(p) for p in possible] if alone is None else alone
    return members, vectors, done + sum(map(len, members)) * dims


def _stops(ends: np.ndarray) -> list[tuple[int, int]]:
    """The postings up to which segments are read before bounds are tested, and the test's number: the last segment end before each of TESTED, at least one segment on."""
    out: list[tuple[int, int]] = []
    total = int(ends[-1]) if len(ends) else 0
    for s, share in enumerate(TESTED):
        last = out[-1][1] if out else 0
        inside = ends[(ends > last) & (ends <= share * total)]
        later = ends[ends > last]
        if len(inside):
            out.append((s, int(inside[-1])))
        elif len(later) and (not out or s == len(TESTED) - 1):
            out.append((s, int(later[0])))
    while out and out[-1][1] < total:
        out.append((len(TESTED) - 1, int(ends[ends > out[-1][1]][0])))
    return out or [(len(TESTED) - 1, 0)]


def _matches(index: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each block of ``index`` for each query of ``groups`` (g, block, query_ids, vs, floors)."""

    def match(batches):
        entry = at = ids = ends = None
        for batch in batches:
            for r in batch.to_dict("records"):
                if r["g"] < 0:
                    entry, at = {**r, "n": int(r["n"]), "dims": int(r["dims"])}, r["block"]  # floats next to the groups' nulls
                    ids, ends = np.frombuffer(r["ids"], np.int64), np.cumsum(np.frombuffer(r["copies"], np.int64))
                    continue
                if entry is None or at != r["block"]:
                    continue  # a block without vectors
                wanted = _matrix(r["vs"], max(1, *map(len, r["vs"])))
                floors = np.array([-np.inf if f is None or f != f else f for f in r["floors"]], np.float64)
                members, vectors, _ = search_block(entry, wanted, k, floors)
                padded = np.zeros((len(wanted), vectors.shape[1]), np.int64)
                padded[:, : wanted.shape[1]] = wanted
                out = []
                for own, query, entries in zip(r["query_ids"], padded, members):
                    scores = _exact(vectors[entries], query)
                    found = [(-int(x), int(i), own) for x, e in zip(scores, entries) for i in ids[(ends[e - 1] if e else 0) : ends[e]] if i != own]
                    out += sorted(found)[:k]
                if out:
                    yield pd.DataFrame([(own, i, min(max(-x, -MOST - 1), MOST)) for x, i, own in out], columns=["query_id", "vec_id", "score"])

    asked = groups.withColumn("chunk", F.floor(F.col("g") / CHUNK_GROUPS))
    copies = asked.select("block", "chunk").distinct().join(index, "block")
    both = copies.withColumn("g", F.lit(-1).cast("long")).unionByName(asked, allowMissingColumns=True)
    both = both.repartition(shuffle_width(index.sparkSession), "block", "chunk").sortWithinPartitions("block", "chunk", "g")
    return staged(both.mapInPandas(match, MATCH_SCHEMA), "matches", BATCH_BLOCKS)


def search(index: DataFrame, queries: DataFrame, k: int = 5, group_rows: int = GROUP_ROWS, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """The ``k`` best of all indexed vectors for each query (query_id, v), its own id left out.

    Returns query_id, rank (from 1), vec_id, score; ties go to smaller
    vec_id; a query with fewer candidates gets them all. Vectors of unequal
    lengths are compared as if padded with zeros. Scores are exact integers of
    any size; one beyond a long is given as the nearest long. A block's
    postings are read once for ``CHUNK_GROUPS`` groups of queries; a block
    gives at most k rows a query.
    """
    n_groups = max(1, -(-queries.count() // group_rows))
    last = index.agg(F.max("block")).first()[0] or 0
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = queries.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)))

    def in_groups(rows: DataFrame, start: int, stop: int) -> DataFrame:
        groups = rows.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("vec_id", "v", "floor"))).alias("q"))
        groups = groups.select("g", F.col("q.vec_id").alias("query_ids"), F.col("q.v").alias("vs"), F.col("q.floor").alias("floors"))
        return groups.withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(stop))))

    matches = _matches(index, in_groups(queries.withColumn("floor", F.lit(None).cast("long")), 0, min(last, first_blocks - 1)), k)
    if last >= first_blocks:
        floors = matches.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        matches = matches.union(_matches(index, in_groups(queries.join(floors, "vec_id", "left"), first_blocks, last), k))
    return matches.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_top_k(vectors: DataFrame, wanted: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """Top ``k`` of ``vectors`` (vec_id, embedding) for those rows for which ``wanted`` holds.

    Vectors that are null, or hold null or a non-finite component, and rows
    without an id take no part. Of rows that repeat an id the smallest vector
    counts. Further columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select("vec_id", quantise(F.col("embedding"), scale).alias("v")).where("vec_id is not null and v is not null")
    rows = staged(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    return search(build_index(rows, k + 1), rows.where(wanted), k)
