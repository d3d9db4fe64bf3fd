import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings, strategies as st

from strata.llm.spelling import SortedList, altered, count_words, group_variants, lcp, met_here, near_words, searched


def one_edit(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    k = lcp(x, y)
    return x[k + 1 :] == y[k + 1 :] if len(x) == len(y) else (x[k + 1 :] == y[k:] if len(x) > len(y) else x[k:] == y[k + 1 :])


def brute_words(rows):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate({c: c + 32 for c in range(65, 91)})
            h = crc32(f"{'' if key is None else key}:{low}".encode())
            total[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    words = brute_words(rows)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        if xs:
            best = min(xs, key=lambda x: (-words[x], x))
            form[w] = best if words[best] >= 2 * words[w] else None

    def root(w):
        while form.get(w):
            w = form[w]
        return w

    return sorted((w, form.get(w) or "", root(w), n, len(near[w]), words[form[w]] if form.get(w) else -1) for w, n in words.items())


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def vocabulary(seed, n, letters="abé"):
    pick = random.Random(seed)
    return [(i, " ".join("".join(pick.choice(letters) for _ in range(pick.randint(4, 7))) for _ in range(60))) for i in range(n)]


@pytest.mark.parametrize("block_words", [8, 64, 1 << 14])
def test_same_as_brute_force_in_blocks_of_any_size(spark, block_words):
    rows = vocabulary(1, 60)
    df = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "doc_id long, text string, n long, word string, backward boolean")
    assert got(group_variants(df, block_words)) == brute(rows)


def test_edge_rows(spark, edge_docs, edge_rows):
    assert got(group_variants(edge_docs)) == brute([r[:2] for r in edge_rows])


def test_no_rows_and_no_words(spark, no_docs):
    assert group_variants(no_docs).count() == 0
    df = spark.createDataFrame([(1, None), (None, ""), (2, "a b c 123")], "doc_id long, text string")
    assert group_variants(df).count() == 0


def test_only_ascii_is_lower_cased_and_hashes_take_the_row_key(spark):
    rows = [(k, t) for k in (None, -1, 5, 1 << 60) for t in ("ÀBCDE àbcde Àbcde ×÷×÷× ßßßßß Ÿtext", "Hello hello HELLO hellO")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in count_words(df).collect()} == brute_words(rows)
    seed = next(k for k in range(10_000) if crc32(b"hello", crc32(b"%d:" % k)) % 97 == 0)
    at = crc32(b"%d:hello" % seed) % 5
    assert altered(b"hello", crc32(b"%d:" % seed)) == "hello"[:at] + "hello"[at + 1 :]


def test_chains_end_at_their_last_form(spark):
    rows = [(1, " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48 + ["bbbbb"] * 96))]
    out = got(group_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == brute(rows) and {r[2] for r in out} == {brute(rows)[-1][0]}


def test_a_hot_prefix_is_spread_over_blocks(spark):
    pick = random.Random(5)
    words = sorted({"prefix" + "".join(pick.choice("abcd") for _ in range(5)) for _ in range(700)})
    df = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    want = {w: sum(one_edit(w, x) for x in words) for w in words}
    assert {r.word: r.n_near for r in near_words(df, 64).collect()} == {w: n for w, n in want.items() if n}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abā\U0001f600", min_size=5, max_size=9), max_size=60), st.data())
def test_scans_meet_every_near_pair_once(words, data):
    lists = [(SortedList(sorted(words)), False), (SortedList(sorted(w[::-1] for w in words)), True)]
    for w in sorted(words)[:10]:
        met = []
        for entries, backward in lists:
            q = w[::-1] if backward else w
            met += [entries.keys[i][:: -1 if backward else 1] for i in entries.near(q, searched(q, backward)) if met_here(q, entries.keys[i], backward)]
        assert sorted(met) == sorted(x for x in words if one_edit(w, x))
