import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from strata.llm.jaccard_join import Shingler, components, least_overlap, near_duplicates, pair_overlap, prefix_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) or same:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(keys) if keys else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=str)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert found(edge_docs) == brute([r[:2] for r in edge_rows])
    assert near_duplicates(no_docs).count() == 0


def test_chains_shared_passages_and_groups_against_brute_force(spark):
    pick, rows = random.Random(5), []
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(pick.choices(words, k=60))
    for g in range(12):
        text = pick.choices(words, k=pick.choice([6, 30, 90, 150]))
        for _ in range(pick.choice([1, 2, 8, 20])):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(pick.randrange(3)):  # each copy differs from the one before: a chain
                text[pick.randrange(len(text))] = pick.choice(words)
    rows += [(len(rows) + i, passage + " " + " ".join(pick.choices(words, k=n))) for i, n in enumerate([2, 3, 20, 40, 60, 80, 3, 2, 15, 14])]
    pick.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@given(st.lists(st.text("ab \t\n\x0b Ab", max_size=40), max_size=5))
@settings(max_examples=80, deadline=None)
def test_sets_have_as_many_shingles_as_the_definition(texts):
    assert [len(s) for s in Shingler().sets(texts)] == [len(shingles(t)) for t in texts]


@given(st.integers(1, 200), st.integers(0, 60), st.integers(0, 2**32))
@settings(max_examples=200, deadline=None)
def test_linked_sets_share_the_smaller_m_in_their_prefixes(n, change, seed):
    pick = np.random.default_rng(seed)
    pool = np.unique(pick.integers(0, 2**63, n + 2 * change).astype(np.uint64))
    x, y = np.sort(pick.permutation(pool)[:n]), None
    y = np.unique(np.concatenate([x[: max(1, n - change)], pool[pick.integers(0, len(pool), change)]]))
    frequent = np.sort(pick.permutation(pool)[: len(pool) // 2])
    level = pick.integers(1, 12, len(frequent))
    both = len(np.intersect1d(x, y))
    if 100 * both >= 80 * (len(x) + len(y) - both):
        (mx, px, _), (my, py, _) = prefix_of(x, frequent, level), prefix_of(y, frequent, level)
        m = min(mx, my)
        reach = m - pair_overlap(len(x), len(y))
        assert len(np.intersect1d(px[: len(x) + reach], py[: len(y) + reach])) >= m
        assert len(px) == len(x) - least_overlap(len(x)) + mx


def test_a_large_group_of_copies_and_lookalikes_meets_few_pairs(spark):
    """Copies of one text that link through it, and texts that share much of it but link with nothing."""
    pick, rows = random.Random(8), []
    words = [f"w{i}" for i in range(9000)]
    base = pick.choices(words, k=150)
    for i in range(240):
        text = list(base)
        if i:
            for at in pick.sample(range(150), 2 if i % 2 else pick.choice([5, 6, 8])):
                text[at] = f"own{i}x{at}"
        rows.append((1000 - i, " ".join(text)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_components_with_hubs(spark):
    """Stars around the smallest and the largest node of thousands, joined by a path; a hub's rows never meet in one task."""
    edges = [(0, i) for i in range(1, 1500)] + [(10**6, i) for i in range(2000, 3500)] + [(1499, 5000), (5000, 5001), (5001, 3499)] + [(7000 + i, 7001 + i) for i in range(0, 400, 2)]
    random.Random(3).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert got == {x: 0 if x < 7000 or x == 10**6 else x - x % 2 for x in nodes}


def test_components_of_digests_and_of_nothing(spark):
    edges = spark.createDataFrame([(bytes([i]) * 16, bytes([i // 2]) * 16) for i in range(1, 40)] + [(bytes([200]) * 16, bytes([201]) * 16)], "a binary, b binary")
    got = {bytes(r.node)[0]: bytes(r.component)[0] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(40)}, 200: 200, 201: 200}
    assert components(edges.where("a = b")).count() == 0


def test_staged_tables_end_with_the_join(spark):
    from pathlib import Path

    from strata.session import checkpoint_root

    folder = Path(checkpoint_root(spark).removeprefix("file:")) / "strata"
    before = {p.name for p in folder.glob("*")}
    out = near_duplicates(spark.createDataFrame([(i, f"a b c d e f {i // 2}") for i in range(20)], "doc_id long, text string"))
    assert out.count() == 20 and {p.name.rpartition("-")[0] for p in folder.glob("*") if p.name not in before} == {"near-duplicates"}


def test_null_and_repeated_keys_link_through_all_their_texts(spark):
    pick = random.Random(9)
    base, other, third = ([f"{c}{pick.randrange(10**6)}" for _ in range(100)] for c in "abc")
    near = [list(base) for _ in range(5)]
    for i, text in enumerate(near):  # neighbours in the list link, others need not
        text[: 7 * i] = [f"own{k}" for k in range(7 * i)]
    rows = [(9, " ".join(near[0])), (None, " ".join(near[1])), (8, " ".join(near[2])), (None, " ".join(near[3])), (None, " ".join(near[4]))]
    rows += [(3, " ".join(other)), (5, " ".join(other)), (5, " ".join(third)), (None, " ".join(third[:-1])), (None, "alone with no key at all")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
