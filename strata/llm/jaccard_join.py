"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

Documents link when the Jaccard similarity of their sets of distinct word
shingles reaches a threshold. Shingles are 64-bit hashes, put in one order for
all documents: from rare to frequent, as far as a bounded list of the most
frequent ones tells, then by hash. Two linked documents share at least
o = threshold / (1 + threshold) * (sum of sizes) shingles, so their first m
common ones are among the first size - o + m of each. As o >= threshold * size,
a prefix of size - ceil(threshold * size) + m shingles serves every partner. A
document whose prefix promises many candidates takes a larger m (its prefix
grows by one shingle for each); a pair is verified when it shares the smaller m
of the two among the first size - o + m, and verification compares whole texts.

Groups of copies are never expanded into pairs. Documents with the same set
are one class, told apart by a 128-bit digest of the set, with an id of its own;
keys play no part until the groups are known. Then every class is compared with
one leader: each prefix shingle proposes its class with the most frequent
shingles (the text that the others were made from has no rare ones), and a class
takes the proposal it meets most often. Classes that hang together by then need
no more comparing among themselves, so the second, complete round only meets
pairs from different components.

Texts are compared where their pairs meet: the texts paired with one hub travel
to it, in chunks of bounded size, and each chunk gets the hub's text once. A
class sends the text of one of its rows only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import plain_key, restore_key, scratch, sent_if_small, shuffle_width, staged
from strata.llm.spans import SpanHasher
from strata.llm.tokens import groups_of, tidied, worker_kept

WORDS, PERCENT = 5, 80
#: Frequent shingles known to the order; a longer list saves candidates and costs memory in each task.
FREQUENT = 1 << 18
#: Estimated candidates that a prefix may promise at m = 1, and the largest m.
COST, MOST_MATCHES = 16, 12
#: Characters hashed at a time: bounds a task's memory.
GROUP_CHARS = 1_000_000
#: Texts that meet their hub in one chunk; more where there are over BIG_HUBS times as many pairs, so that hubs of several chunks are few.
CHUNK, BIG_HUBS = 256, 50_000


class Shingler:
    """Sorted sets of distinct shingle hashes of many texts at once."""

    def __init__(self, words: int = WORDS):
        self._words, self._hasher = words, SpanHasher()

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        raws = [b" ".join(t.encode().lower().split()) for t in texts]  # bytes: A-Z only; \x20 and \x09-\x0D
        data = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
        blank = (data == 32) | (data == 10)
        starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
        ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
        edges = np.cumsum([0, *(len(r) + 1 for r in raws)])
        first = np.searchsorted(starts, edges)
        count = np.diff(first)
        spans = np.minimum(np.maximum(count - self._words + 1, 1), count)  # a short text is one shingle
        begin = np.repeat(first[:-1] - (np.cumsum(spans) - spans), spans) + np.arange(int(spans.sum()))
        last = np.minimum(begin + self._words, np.repeat(first[1:], spans)) - 1
        hashes = self._hasher.hashes(data, starts[begin], ends[last]) if len(begin) else np.zeros(0, np.uint64)
        cuts = np.cumsum(spans)
        return [np.unique(hashes[b - n : b]) for n, b in zip(spans.tolist(), cuts.tolist())]


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """Shingles that a set of this size shares at least with any set it links with."""
    return -(-percent * size // 100)


def pair_overlap(x: int, y: int, percent: int = PERCENT) -> int:
    """Shingles that linked sets of these sizes share at least."""
    return -(-percent * (x + y) // (100 + percent))


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def prefix_of(shingles: np.ndarray, frequent: np.ndarray, level: np.ndarray, percent: int = PERCENT) -> tuple[int, np.ndarray, float]:
    """m, the prefix and the mean level of a set; ``frequent``: sorted hashes, ``level``: log2 of how often each was seen.

    m grows with the candidates that the part of the prefix promises which
    partners of the same size can meet.
    """
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        seen = np.where(frequent[at] == shingles, level[at], 0.0)
        order = np.argsort(seen, kind="stable")
        shingles, seen = shingles[order], seen[order]
    else:
        seen = np.zeros(len(shingles))
    n = len(shingles)
    t = least_overlap(n, percent)
    near = seen[: n - pair_overlap(n, n, percent) + 1]
    cost = float(np.where(near > 0, np.exp2(near), 0).sum())
    m = int(min(t, MOST_MATCHES, 1 + np.log2(max(1.0, cost / COST))))
    return m, shingles[: n - t + m], float(seen.mean())


def frequent_shingles(rows: DataFrame, words: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the most frequent shingles (sorted) and the log2 of their counts.

    Counted are shingles that repeat within a group of a task's texts; the
    counts only shape the order, which decides costs and never results.
    """

    def count(batches):
        shingler = worker_kept(("shingles", words), lambda: Shingler(words))
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in groups_of(texts, 6_000_000):
                sets = [s for c, d in groups_of(texts[a:b], GROUP_CHARS) for s in shingler.sets(texts[a:b][c:d])]
                shingle, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pd.DataFrame({"shingle": shingle[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

    counts = rows.select("text").mapInPandas(tidied(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = staged(counts.select("shingle", F.log2("n").alias("level")), "frequent")
    kept, cut = 0, 64.0
    steps = counts.groupBy(F.floor(F.col("level") * 4).alias("step")).count().orderBy(F.desc("step"))
    for row in steps.collect():  # at most 256 rows
        if kept + row["count"] > most:
            break
        kept, cut = kept + row["count"], row["step"] / 4
    found = counts.where(F.col("level") >= cut).toPandas()  # at most `most` rows
    shingle = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], found["level"].to_numpy(np.float64)[order]


def _least_neighbours(links: DataFrame, of: DataFrame) -> DataFrame:
    """The links (u, v) of ``of`` with ``low``, the least of u and its neighbours over ``links`` (u, v).

    A node with so many links that they would stand out in a shuffle (there
    are few, by their number) gets them where they are: its ``low`` is sent
    to all executors.
    """
    lows = links.groupBy("u").agg(F.least("u", F.min("v")).alias("low"), F.count("*").alias("degree"))
    total, most = lows.agg(F.sum("degree"), F.max("degree")).first()
    limit = max(16, (total or 0) // (4 * shuffle_width(links.sparkSession)))  # at most 4 nodes a shuffle partition have more
    plain = lows.select("u", "low")
    if (most or 0) <= limit:
        return of.join(plain, "u")
    hubs = F.broadcast(lows.where(F.col("degree") > limit).select("u", "low"))
    return of.join(hubs, "u").unionByName(of.join(hubs.select("u"), "u", "left_anti").join(plain, "u"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node on an edge; staged.

    Alternating stars: every node links its larger neighbours to the least of
    all, then its smaller ones and itself to the least of these, until nothing
    changes and every component is a star around its smallest node. Neither
    step adds links, and none gathers a node's links in one task.
    """
    with scratch(edges.sparkSession) as own:
        links = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
        print_of = (F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30))), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30))))
        state = links.agg(*print_of).first()
        most = state[0]
        while most:
            both = links.union(links.select("v", "u"))
            large = _least_neighbours(both, both.where("v > u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
            large = staged(large.distinct(), "large-star", at_most=most)
            small = _least_neighbours(large, large)
            small = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", F.col("low").alias("v")))
            after = staged(small.distinct(), "small-star", at_most=most)
            own.drop(links, large)
            links, before, state = after, state, after.agg(*print_of).first()
            if state == before:
                break
        return own.kept(staged(links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct()), "components", at_most=2 * most))


def verify(pairs: DataFrame, places: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` (hub, other; staged) whose whole texts link; staged.

    ``places`` (node, doc_id, text_hash): the row whose text stands for a
    node; ``rows``: doc_id, text_hash, text. Only these rows' texts are
    shuffled, once for each pair and chunk.
    """

    def check(batches):
        shingler = worker_kept(("shingles", words), lambda: Shingler(words))
        hub = own = None
        for batch in batches:
            sets = [s for a, b in groups_of(batch["text"].tolist(), GROUP_CHARS) for s in shingler.sets(batch["text"].iloc[a:b].tolist())]
            keep = []
            for at, node, text_set in zip(batch["hub"].tolist(), batch["node"].tolist(), sets):
                if node == at:
                    hub, own = at, text_set
                elif at == hub and linked(own, text_set, percent):
                    keep.append((at, node))
            if keep:
                yield pd.DataFrame(keep, columns=["a", "b"])

    with scratch(pairs.sparkSession) as scope:
        total = pairs.count()
        sizes = pairs.groupBy("hub").count()
        chunk = max(CHUNK, total // BIG_HUBS)
        big = F.broadcast(sizes.where(F.col("count") > chunk).select("hub", F.ceil(F.col("count") / chunk).alias("chunks")))  # BIG_HUBS at most
        dealt = pairs.join(big, "hub", "left").select("hub", "other", F.coalesce(F.pmod(F.xxhash64("other"), F.col("chunks")), F.lit(0)).alias("chunk"))
        asked = dealt.select(F.col("other").alias("node"), "hub", "chunk")
        asked = staged(asked.union(asked.select("hub", "hub", "chunk").distinct()).join(places, "node"), "asked", at_most=2 * total)
        asked = asked.select("node", "hub", "chunk", F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"))
        sent = rows.join(sent_if_small(asked, 64), (F.col("text_hash") == F.col("of_text")) & F.col("doc_id").eqNullSafe(F.col("of_doc")))
        sent = sent.select("hub", "chunk", "node", (F.col("node") != F.col("hub")).alias("guest"), "text")
        sent = sent.repartition(shuffle_width(pairs.sparkSession), "hub", "chunk").sortWithinPartitions("hub", "chunk", "guest")
        return scope.kept(staged(sent.select("hub", "node", "text").mapInPandas(tidied(check), "a long, b long").distinct(), "verified", at_most=total))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, itself
    included. Null and empty texts have no shingles and link with nothing;
    rows that repeat a doc_id share a component if their texts have words;
    a null doc_id is in a component of the others it links with, else null.
    Other columns are ignored; an empty table gives no rows.
    """
    with scratch(docs.sparkSession) as scope:
        grouped = text_groups(docs, words, percent)
        keyed = grouped.where("component is not null and doc_id is not null")
        several = staged(keyed.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("doc_id", "a"), "several-texts")
        if not several.isEmpty():  # the texts of one doc_id belong together
            shared = keyed.join(sent_if_small(several, 64), "doc_id").where("a <> component")
            merged = components(shared.select("a", F.col("component").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("whole"))
            grouped = staged(grouped.join(sent_if_small(merged, 96), "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole"), "merged-groups")
        names = grouped.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("keyless"))
        names = staged(names.where("component_id <> last or keyless").select("component", "component_id"), "component-names")  # any other row names its own
        out = grouped.join(sent_if_small(names, 64), "component", "left")
        return scope.kept(staged(out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), "near-duplicates"))


def text_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component; staged.

    ``component`` is a digest that all texts reachable by links share,
    whatever their keys; null for texts without shingles. ``text_hash`` takes
    a null text as empty.
    """
    with scratch(docs.sparkSession) as scope:
        return scope.kept(_text_groups(docs, words, percent))


def _text_groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    frequent, level = frequent_shingles(rows, words)

    def sign(batches):
        shingler = worker_kept(("shingles", words), lambda: Shingler(words))
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in groups_of(texts, GROUP_CHARS):
                out = []
                for s in shingler.sets(texts[a:b]):
                    m, prefix, mean = prefix_of(s, frequent, level, percent) if len(s) else (0, s, 0.0)
                    out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), m, prefix.view(np.int64), mean))
                out = pd.DataFrame(out, columns=["n", "class", "m", "prefix", "mean"])
                yield out.assign(doc_id=batch["doc_id"].iloc[a:b].to_numpy(), text_hash=batch["text_hash"].iloc[a:b].to_numpy(), no_key=batch["no_key"].iloc[a:b].to_numpy())

    schema = "doc_id long, no_key boolean, text_hash long, n long, class binary, m int, prefix array<long>, mean double"
    signed = staged(restore_key(plain_key(rows, "doc_id", "text_hash", "text").mapInPandas(tidied(sign), schema), "doc_id"), "signatures")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("place")
    classes = signed.where("n > 0").groupBy("class").agg(place, F.first("n").alias("n"), F.first("m").alias("m"), F.first("prefix").alias("prefix"), F.first("mean").alias("mean"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    places = classes.select("node", "place.doc_id", "place.text_hash")

    # tokens of two classes at least, counted by themselves; only their postings get more columns
    tokens = classes.select("node", F.posexplode("prefix").alias("pos", "token"))
    shared = staged(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token"), "shared-tokens")
    postings = tokens.join(shared, "token").join(classes.select("node", "n", "m", "mean"), "node")
    postings = staged(postings.select("token", "node", "pos", "n", "m", "mean"), "postings")

    def near_sizes(x: str, y: str):
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    leads = postings.groupBy("token").agg(F.max(F.struct("mean", (-F.col("node")).alias("node"), "n")).alias("lead"))
    leads = staged(leads.select("token", (-F.col("lead.node")).alias("lead"), F.col("lead.n").alias("lead_n")), "leads")  # staged, so that Spark can split a token's rows in the join
    first = postings.select("token", "node", "n").join(leads, "token").where("node <> lead").where(near_sizes("n", "lead_n")).groupBy("node", "lead").count()
    first = first.groupBy("node").agg(F.max(F.struct("count", -F.col("lead")))["col2"].alias("lead"))
    edges = verify(staged(first.select((-F.col("lead")).alias("hub"), F.col("node").alias("other")), "leaders"), places, rows, words, percent)
    labels = components(edges)

    placed = postings.join(labels, "node", "left").select("token", "node", "n", "m", "pos", F.coalesce("component", "node").alias("component"))
    main = placed.groupBy("token", "component").count().groupBy("token").agg(F.count("*").alias("k"), F.max(F.struct("count", "component"))["component"].alias("main")).where("k > 1").select("token", "main")
    mixed = staged(placed.join(staged(main, "mains"), "token"), "mixed")
    x = mixed.where("component <> main").select("token", *(F.col(c).alias(f"x_{c}") for c in ("node", "n", "m", "pos", "component")))
    y = mixed.select("token", "main", *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "m", "pos", "component")))
    met = x.join(y, "token").where("x_component <> y_component and (y_component = main or x_node < y_node)").where(near_sizes("x_n", "y_n"))
    reach = F.least("x_m", "y_m") - F.ceil(percent * (F.col("x_n") + F.col("y_n")) / (100 + percent))  # m - o
    met = met.where((F.col("x_pos") < F.col("x_n") + reach) & (F.col("y_pos") < F.col("y_n") + reach))
    met = met.groupBy(F.least("x_node", "y_node").alias("hub"), F.greatest("x_node", "y_node").alias("other")).agg(F.count("*").alias("shared"), F.min(F.least("x_m", "y_m")).alias("m"))
    edges = edges.union(verify(staged(met.where("shared >= m").select("hub", "other"), "candidates"), places, rows, words, percent))
    labels = components(edges)

    # rows of a class that isn't its component's first one get the digest of that one; all others are in their own
    digests = classes.select("node", "class")
    moved = labels.where("node <> component").join(digests, "node").join(digests.select(F.col("node").alias("component"), F.col("class").alias("whole")), "component")
    moved = staged(moved.select("class", "whole"), "moved-classes")
    out = signed.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class")).join(sent_if_small(moved, 112), "class", "left")
    return staged(out.select("doc_id", "text_hash", "n_shingles", F.coalesce("whole", "class").alias("component")), "text-groups")
