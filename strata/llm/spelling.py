"""Spelling variants: words one edit apart, found by scans of sorted word lists.

The distinct words are sorted twice: as they are, and reversed. Two words that
differ by one inserted, deleted or replaced code point agree either on the
first half of the shorter one or on its last half, so each word searches only
the range of either list that shares its own half. A search goes through such a
range in order and keeps the rows of the edit matrix, three cells wide around
the diagonal, by depth: the next word goes on from the row at its longest
common prefix (LCP) with the one before, and where all cells of a row exceed
one edit, the whole range that shares this prefix is skipped.

Spark cuts the sorted lists into blocks of bounded size by range. A word looks
into its own block, and goes to each further block in its range unless the
prefix shared by all that block's words already exceeds one edit, which the
same scan over the list of block prefixes tells. Every pair is met in one of
the lists only, so counts and best forms of the blocks simply add up.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import plain_key, staged

#: Words of a block of a sorted list, in expectation: bounds a task's memory and the list of blocks.
BLOCK_WORDS = 1 << 14
#: Distinct words that a task counts before it hands them on: bounds its memory, the counts are added up.
COUNTED_WORDS = 300_000
#: Fixed values of the contract: least length (code points) and count of a word, times that a form must be as frequent, share of runs altered.
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES, ALTERED = 5, 3, 2, 97

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LAST = "\U0010ffff"
_FAR = 2  # any distance above one edit


def altered(run: bytes, seed: int, share: int = ALTERED) -> str:
    """The word of a lower-cased run (UTF-8); ``seed``: crc32 of what the run's hash starts with."""
    word, h = run.decode(), crc32(run, seed)
    if h % share:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all whole texts, staged; a null text has none, a null key counts as ''."""

    def count(batches):
        total: Counter = Counter()

        def flush():
            if total:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total.clear()

        for batch in batches:
            for key, none, text in zip(batch["doc_id"].tolist(), batch["no_key"].tolist(), batch["text"].tolist()):
                seed = crc32(b":" if none else b"%d:" % key)
                for run, n in Counter(_RUN.findall(text)).items():
                    if len(run) >= least_length and len(word := altered(run.encode().lower(), seed)) >= least_length:  # bytes: A-Z only
                        total[word] += n
            if len(total) >= COUNTED_WORDS:
                yield from flush()
        yield from flush()

    rows = plain_key(docs.where("text is not null"), "doc_id", F.col("text").cast("string").alias("text"))
    counts = rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return staged(counts.where(F.col("n") >= least_count), "words")


def lcp(x: str, y: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    for k in range(n):
        if x[k] != y[k]:
            return k
    return n


class SortedList:
    """Ascending strings and the LCP of each with the one before."""

    def __init__(self, keys: list[str]):
        self.keys, self.lcps = keys, [0, *map(lcp, keys, keys[1:])]

    def near(self, word: str, shared: int, whole: bool = True):
        """Indices of strings that agree with ``word`` on its first ``shared`` code points and differ by exactly one edit.

        ``whole`` False: of the strings of which some continuation is within
        one edit; such strings may also be shorter than ``shared``.
        """
        keys, lcps, size = self.keys, self.lcps, len(word)
        start = word[:shared]
        i, stop = bisect_left(keys, start), bisect_right(keys, start + _LAST)
        if not whole:  # prefixes of the start itself stand before it
            yield from (j for j in dict.fromkeys(bisect_left(keys, start[:k]) for k in range(shared)) if j < i and start.startswith(keys[j]))
        # rows[d]: distances of the string's first d code points to the word's first d - 1, d and d + 1
        rows = [None] * shared + [(1, 0, 1 if shared < size else _FAR)]
        first = i
        while i < stop:
            key = keys[i]
            d = shared if i == first else lcps[i]
            if d > len(rows) - 1:
                d = len(rows) - 1
            del rows[d + 1 :]
            a, b, c = rows[d]
            length = len(key)
            while d < length:
                x = key[d]
                low = b + 1
                if d and (y := a + (word[d - 1] != x if d <= size else _FAR)) < low:
                    low = y
                mid = c + 1
                if (y := b + (word[d] != x if d < size else _FAR)) < mid:
                    mid = y
                if low + 1 < mid:
                    mid = low + 1
                high = mid + 1
                if (y := c + (word[d + 1] != x if d + 1 < size else _FAR)) < high:
                    high = y
                if d + 2 > size:
                    high = _FAR
                    if d + 1 > size:
                        mid = _FAR
                        if d > size:
                            low = _FAR
                a, b, c = low, mid, high
                d += 1
                if a > 1 and b > 1 and c > 1:
                    break
                rows.append((a, b, c))
            else:
                if not whole or (a if length == size + 1 else b if length == size else c if length == size - 1 else _FAR) == 1:
                    yield i
                i += 1
                continue
            # no continuation of the first d code points is near: skip all that share them
            i += 1
            if i < stop and lcps[i] >= d:
                i = bisect_right(keys, key[:d] + _LAST, i, stop)


def searched(word: str, backward: bool) -> int:
    """Code points at the front (of the reversed word, if ``backward``) that any near word to be met in this list shares."""
    return len(word) // 2 if backward else (len(word) - 1) // 2


def met_here(x: str, y: str, backward: bool) -> bool:
    """Whether the near pair of list entries is met in this list: the forward one, if the words agree on half the shorter one."""
    if backward:
        x, y = x[::-1], y[::-1]
    return (lcp(x, y) >= min(len(x), len(y)) // 2) != backward


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n_near (its near words), best (their -n and word: the smallest is the best) for the ``words`` (word, n) that have any; staged."""
    lists = words.select(F.lit(False).alias("backward"), F.col("word").alias("key"), "n").union(words.select(F.lit(True), F.reverse("word"), "n"))
    n_blocks = max(1, -(-2 * words.count() // block_words))
    lists = lists.repartitionByRange(n_blocks, "backward", "key").withColumn("block", F.spark_partition_id())
    lists = staged(lists, "sorted-words")
    of_blocks = lists.groupBy("backward", "block").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    of_blocks = sorted(tuple(r) for r in of_blocks.select("backward", "low", "high", "block").collect())  # one row per block_words words
    directory = {}
    for backward in (False, True):
        some = [r[1:] for r in of_blocks if r[0] == backward]
        directory[backward] = [low[: lcp(low, high)] for low, high, _ in some], [b for *_, b in some], [low for low, *_ in some], [high for _, high, _ in some]

    def route(batches):
        """The further blocks that each word must look into."""
        plans = {}
        for backward, (prefixes, blocks, lows, highs) in directory.items():
            plans[backward] = SortedList(sorted(set(prefixes))), prefixes, blocks, lows, highs
        for batch in batches:
            out = []
            for backward, key, block in zip(batch["backward"].tolist(), batch["key"].tolist(), batch["block"].tolist()):
                distinct, prefixes, blocks, lows, highs = plans[backward]
                start = key[: searched(key, backward)]
                first, stop = bisect_left(highs, start), bisect_right(lows, start + _LAST)
                if stop - first <= 1 and blocks[first] == block:
                    continue
                alive = {distinct.keys[i] for i in distinct.near(key, len(start), whole=False)}
                out += [(blocks[k], backward, key) for k in range(first, stop) if blocks[k] != block and prefixes[k] in alive]
            if out:
                yield pd.DataFrame(out, columns=["block", "backward", "key"])

    def search(batches):
        """Rows come by block: its words first, in order, then the words from other blocks."""
        block = entries = None
        keys: list[str] = []
        counts: list[int] = []

        def found_in_own():
            nonlocal entries
            entries = SortedList(keys)
            yield from found(keys)

        def found(asked):
            backward, out = block[1], []
            for key in asked:
                near = [i for i in entries.near(key, searched(key, backward)) if met_here(key, entries.keys[i], backward)]
                if near:
                    best = min((-counts[i], keys[i][::-1] if backward else keys[i]) for i in near)
                    out.append((key[::-1] if backward else key, len(near), *best))
            if out:
                yield pd.DataFrame(out, columns=["word", "n_near", "less_n", "form"])

        for batch in batches:
            for (at, backward, guest), part in batch.groupby(["block", "backward", "guest"], sort=True):
                if (at, backward) != block:
                    if entries is None and keys:
                        yield from found_in_own()
                    block, entries, keys, counts = (at, backward), None, [], []
                if not guest:
                    keys += part["key"].tolist()
                    counts += part["n"].tolist()
                    continue
                if entries is None:
                    yield from found_in_own()
                yield from found(part["key"].tolist())
        if entries is None and keys:
            yield from found_in_own()

    guests = lists.select("backward", "key", "block").mapInPandas(route, "block int, backward boolean, key string")
    rows = lists.select("block", F.lit(False).alias("guest"), "backward", "key", "n").union(guests.select("block", F.lit(True), "backward", "key", F.lit(0).cast("long")))
    rows = rows.repartition(n_blocks, "block", "backward").sortWithinPartitions("block", "backward", "guest", "key")
    parts = rows.mapInPandas(search, "word string, n_near long, less_n long, form string")
    return staged(parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less_n", "form")).alias("best")), "near-words")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of staged ``links`` (word, form): the last form reached. Counts at least double along the way, so it ends; each round halves it."""
    paths = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(paths.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "paths")
        paths = step.select("word", "root")
        if step.where("moved").isEmpty():
            return paths


def group_variants(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Null and empty texts have no words; rows that repeat a key or a text count
    each; ties go to the smaller word; other columns are ignored; an empty
    table gives no rows.
    """
    words = count_words(docs)
    near = near_words(words, block_words)
    taken = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.less_n") >= FORM_TIMES * F.col("n"), F.col("best")).alias("best"))
    taken = staged(taken.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less_n")).alias("form_n")), "forms")
    last = roots(taken.where("form is not null").select("word", "form"))
    return taken.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
