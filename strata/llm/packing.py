"""Pattern packing: few-document length patterns, repeated as non-negative least squares says.

Documents are tokenised once and cut into pieces of at most ``size`` ids. Only
the histogram of piece lengths (at most ``size`` rows) reaches the driver.
There, patterns of two to four lengths that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative
least squares and rounded down, and what is left is packed best-fit, longest
first, still as counts of equal lengths. The plan says which ranks of each
length go to which sequences; every piece then finds its own place.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.common import plain_key, restore_key, staged
from strata.llm.tokens import groups_of, tidied, worker_encoder

#: Partner lengths tried for each first length in the patterns of three and four; more patterns fit better and take longer.
PARTNERS = 12
SWEEPS = 40

PIECE_SCHEMA = "doc_id long, no_key boolean, piece int, start long, length long, ids binary, task int, nth long"


def cut_pieces(n_ids: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole when it fits, else full pieces after a shorter first one."""
    first = n_ids % size or size
    return [(0, first), *((s, size) for s in range(first, n_ids, size))]


def tokenise_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0) -> DataFrame:
    """The pieces of every document, staged. ``nth`` counts the pieces of one length in one task."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        encoder, task, seen = worker_encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for a, b in groups_of(texts):
                rows = []
                for key, none, raw in zip(batch["doc_id"].iloc[a:b], batch["no_key"].iloc[a:b], encoder.encode(texts[a:b])):
                    raw += end
                    for piece, (start, length) in enumerate(cut_pieces(len(raw) // 4, size)):
                        rows.append((key, none, piece, start, length, raw[4 * start : 4 * (start + length)], task, seen[length]))
                        seen[length] += 1
                yield pd.DataFrame(rows, columns=["doc_id", "no_key", "piece", "start", "length", "ids", "task", "nth"])

    rows = plain_key(docs, "doc_id", F.col("text").cast("string").alias("text"))
    return staged(restore_key(rows.mapInPandas(tidied(encode), PIECE_SCHEMA), "doc_id"), "pieces", compression="zstd")


def enumerate_patterns(lengths: list[int], size: int, partners: int = PARTNERS) -> list[tuple[int, ...]]:
    """Patterns of two to four of the lengths that fill ``size`` exactly, each in descending order.

    All pairs; for three and four, each first length with up to ``partners``
    second (and third) lengths spread evenly over what fits, so the number of
    patterns grows with ``size`` and not with the data.
    """
    there, found = np.zeros(size + 1, bool), set()
    there[lengths] = True

    def spread(low: int, high: int) -> list[int]:
        fit = np.flatnonzero(there[low : high + 1]) + low if high >= low else np.array([], int)
        return fit[np.unique(np.linspace(0, len(fit) - 1, min(len(fit), partners)).astype(int))].tolist() if len(fit) else []

    for a in sorted(lengths, reverse=True):
        rest = size - a
        if 0 < rest <= a and there[rest]:
            found.add((a, rest))
        for b in spread(max(1, -(-rest // 2)), min(a, rest - 1)):
            if there[rest - b]:
                found.add((a, b, rest - b))
        for b in spread(max(1, -(-rest // 3)), min(a, rest - 2))[:: max(1, partners // 4)]:
            for c in spread(max(1, -(-(rest - b) // 2)), min(b, rest - b - 1))[:: max(1, partners // 4)]:
                if there[rest - b - c]:
                    found.add((a, b, c, rest - b - c))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ||A x - counts||, by coordinate descent from zero.

    Column p of A holds how often pattern p uses each length. One pass sets
    each count to its own best value, given the others, or zero.
    """
    x, left = [0.0] * len(patterns), counts.astype(float).tolist()
    columns = [list(Counter(p).items()) for p in patterns]
    norms = [sum(m * m for _, m in c) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for k, column in enumerate(columns):
            step = sum(m * left[n] for n, m in column) / norms[k]
            new = max(0.0, x[k] + step)
            if delta := new - x[k]:
                x[k] = new
                moved = max(moved, abs(delta))
                for n, m in column:
                    left[n] -= m * delta
        if moved < 1e-3:
            break
    return np.array(x)


def plan_packing(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use up ``counts[length]`` pieces of each length below ``size`` exactly."""
    left, plan = counts.astype(np.int64).copy(), []
    left[size] = 0
    patterns = enumerate_patterns(np.flatnonzero(left).tolist(), size)
    for pattern, x in zip(patterns, fit_repeats(patterns, left)):
        times = min([int(x), *(int(left[n]) // m for n, m in Counter(pattern).items())])
        if times > 0:
            plan.append((pattern, times))
            for n in pattern:
                left[n] -= times
    return plan + best_fit(left, size)


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts of equal lengths: equal open sequences move together."""
    room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]  # open sequences by free ids
    for length in range(size, 0, -1):
        todo = int(counts[length])
        free = length
        while todo:
            while free <= size and not room[free]:
                free += 1
            if free > size:  # nothing open fits: open as many as are needed
                each = size // length
                if full := todo // each:
                    room[size - each * length].append(((length,) * each, full))
                if todo % each:
                    room[size - (todo % each) * length].append(((length,) * (todo % each), 1))
                break
            pattern, times = room[free].pop()
            used = min(times, todo)
            if times > used:
                room[free].append((pattern, times - used))
            room[free - length].append((pattern + (length,), used))
            todo -= used
            free = max(length, free - length) if free - length >= length else free
    return [x for group in room for x in group]


def place_table(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """For each length, the ranks from ``rank`` on that go to sequences from ``sequence`` on, at ``offset``."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into as few sequences of at most ``size`` ids as the patterns allow.

    Returns one row per piece: doc_id, piece, start, length, ids (binary
    u32), sequence_id, offset. A null text counts as empty (one id, the
    end); null and repeated keys are packed like any other row; other columns
    are ignored; an empty table gives none. Full pieces are sequences of their
    own, with negative numbers.
    """
    pieces = tokenise_pieces(docs, tokenizer, size, end_id)
    tasks = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(size + 1, np.int64)
    for row in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        counts[row["length"]] = row["n"]
    places = place_table(plan_packing(counts, size))
    key = places["length"].to_numpy(np.int64) * (1 << 48) + places["rank"].to_numpy(np.int64)
    first_rank, first_seq, at = (places[c].to_numpy(np.int64) for c in ("rank", "sequence", "offset"))

    def place(batches):
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            sequence, offset = -1 - rank, np.zeros(len(batch), np.int64)
            if len(key):
                slot = np.maximum(0, np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1)
                part = length < size
                sequence = np.where(part, first_seq[slot] + rank - first_rank[slot], sequence)
                offset = np.where(part, at[slot], offset)
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    bases = tasks.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"])
    ranked = plain_key(ranked, "doc_id", "piece", "start", "length", "ids", (F.col("base") + F.col("nth")).alias("rank"))
    placed = ranked.mapInPandas(place, "doc_id long, no_key boolean, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return restore_key(placed, "doc_id")
