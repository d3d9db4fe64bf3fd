import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import registry
from strata.llm.common import fold
from strata.llm.quality_model import estimate_prior, fit_nnpu, score_quality
from strata.llm.quality_rules import CUTOFFS, binomial_tail, choose_cutoff, judge
from strata.llm.toxicity import fit_noisy_or, fit_toxicity, hits, score_toxicity, sentences

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered, seen, copies = set(), set(), 0
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), copies, len(covered)


def measured(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()), key=str)


def expected(rows):
    out = []
    for key, text in rows:
        c = counts(text)
        out.append((key, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    return sorted(out, key=str)


def test_rule_counts_of_edge_rows(spark, edge_docs, edge_rows, no_docs, no_labels):
    rows = [r[:2] for r in edge_rows]
    judged = judge(edge_docs, no_labels)
    assert measured(judged) == expected(rows)
    assert all(r.kept == (not r.base_failed) for r in judged.collect())  # nothing is certified without labels
    assert judge(no_docs, no_labels).count() == 0
    texts = [(1, "a\na\n \na b\n\na"), (2, "a b c d e f a b c d e"), (3, "x " * 30), (4, "a b c d e a b c d e a b c d"), (5, "##|| <> $\x0b%\x0c&é日")]
    assert measured(judge(spark.createDataFrame([(*t, None) for t in texts], "doc_id long, text string, lang string"), no_labels)) == expected(texts)


def test_rules_of_all_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert measured(registry.op4_risk_rules(spark, SF)) == expected([tuple(r) for r in rows])


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 40, 0.05), (30, 40, 0.6), (40, 40, 0.3), (0, 1, 0.5), (60, 2000, 0.05)])
def test_binomial_tail_is_exact(k, n, p):
    exact = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_certified_cutoffs_keep_the_guarantee():
    """Over many draws of labelled texts, the chosen cutoff's true false-rejection rate exceeds the risk at most as often as the level says."""
    pick, risk, level, broken = np.random.default_rng(0), 0.05, 0.1, 0
    share = np.linspace(0.001, 0.3, len(CUTOFFS))  # the true rate of each cutoff, from lenient to strict
    for _ in range(400):
        exceeded = (pick.random(600)[:, None] < share).sum(axis=1)
        good = np.bincount(exceeded, minlength=len(CUTOFFS) + 1).tolist()
        cutoff = choose_cutoff(good, good, risk, level)
        broken += cutoff is not None and share[CUTOFFS.index(cutoff)] > risk
    assert broken / 400 <= level
    assert choose_cutoff([5] + [0] * len(CUTOFFS), [0] * (len(CUTOFFS) + 1), risk, level) is None  # too few labels


def test_cutoffs_reject_bad_texts_and_spare_good_ones(spark):
    clean = [(i, f"plain words number{i} say this and that about some other thing here today", "en") for i in range(900)]
    junk = [(2000 + i, " ".join(f"w{i}x{k}###" for k in range(14)), "en") for i in range(200)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 2000).cast("int").alias("quality"))
    kept = {r.doc_id for r in judge(docs, labels).where("kept").collect()}
    assert kept == {i for i, *_ in clean}


def test_more_than_a_hundred_strata_are_all_judged(spark):
    texts = [(f"l{k:03}", f"plain words number{i} say this and that about some other thing here today") for k in range(104) for i in range(100)]
    texts += [("zz", f"plain words number{i} say this and that about some other thing here today") for i in range(96)]
    junk = [("zz", " ".join(f"w{i}x{k}###" for k in range(14))) for i in range(2)]
    few = [("few", t) for _, t in texts[:5] + junk]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts + junk + few)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (~F.col("text").contains("###")).cast("int").alias("quality"))
    judged = judge(docs, labels, risk=0.5).collect()
    assert len(judged) == len(rows) and {rows[r.doc_id][1:] for r in judged if not r.kept} == {(t, lang) for lang, t in junk}


def test_nnpu_recovers_the_boundary_and_the_prior():
    pick = np.random.default_rng(1)
    good, mixed = pick.normal(2, 1, (3000, 2)), np.vstack([pick.normal(2, 1, (2100, 2)), pick.normal(-2, 1, (900, 2))])
    w = fit_nnpu(good.astype(np.float32), mixed.astype(np.float32), 0.7, steps=300)
    right = ((mixed @ w[:2] + w[2] > 0) == (np.arange(3000) < 2100)).mean()
    assert right > 0.97
    assert estimate_prior(good @ w[:2], mixed @ w[:2]) == pytest.approx(0.7, abs=0.06)


def test_quality_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in registry.op6_quality_model(spark, SF).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 for k, r in rows.items())
    held = [(rows[k].predicted, y) for k, y in labels if rows[k].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_toxicity_on_held_out_labels_and_its_sentences(spark):
    rows = {r.doc_id: r for r in registry.op8_toxicity(spark, SF).collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 for k, r in rows.items())
    held = [(rows[k].predicted, y) for k, y in labels if rows[k].held_out]
    assert np.mean([p == y for p, y in held]) > 0.9


def test_noisy_or_finds_the_offending_sentence(spark):
    plain = [f"Sentence {w} goes here. Then more {w} follows, and on. The end" for w in "abcdefghijklmnopqrstuvwxyz"] * 6
    docs = [(i, t, 0) for i, t in enumerate(plain)] + [(1000 + i, t.replace("Then more", "You vile zork, then"), 1) for i, t in enumerate(plain[:90])]
    docs = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.lit(True))
    text = "A calm start here. Someone said zork, vile indeed! A calm end."
    row = score_toxicity(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.score > 0.8 and [text[s.start : s.end] for s in row.sentences] == [" Someone said zork, vile indeed!"]
    assert score_toxicity(spark.createDataFrame([(1, "A calm start here. All is calm.")], "doc_id long, text string"), model).first().score < 0.1


def test_noisy_or_gradient_reduces_loss():
    texts = [(1, 3, [[0], [1]]), (0, 2, [[1]]), (1, 1, [[0, 1]]), (0, 4, [])] * 10
    w, bias = fit_noisy_or(texts, 2, steps=200)
    assert w[0] > 2 > abs(w[1]) - 3 and bias < -2


def test_sentences_cover_the_text_and_positions_hold_under_lower_case():
    text = "One. Two!? Three\nFour İstanbul vile"
    assert "".join(text[a:b] for a, b in sentences(text)) == text
    n, found = hits(text, {"vile": 0})
    assert n == 4 and [text[a:b] for a, b, _ in found] == ["Four İstanbul vile"]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs, no_labels):
    keys = sorted(str(r[0]) for r in edge_rows)
    learn = fold(F.col("doc_id"), 3) != 1
    labels = spark.createDataFrame([(3, 1, 0), (7, 1, 0), (8, 1, 0), (8, 0, 1), (None, 1, 1), (11, None, None), (12, 0, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, no_labels):
        scored, _ = score_quality(edge_docs, given, learn)
        got = scored.collect()
        assert sorted(str(r.doc_id) for r in got) == keys and all(0 <= r.score <= 1 for r in got)
        got = score_toxicity(edge_docs, fit_toxicity(edge_docs, given, learn)).collect()
        assert sorted(str(r.doc_id) for r in got) == keys and all(0 <= r.score <= 1 for r in got)
    assert score_quality(no_docs, no_labels, learn)[0].count() == 0
    assert score_toxicity(no_docs, fit_toxicity(no_docs, no_labels, learn)).count() == 0


def test_samples_are_bounded_by_rows_and_hold_no_null_keys(spark):
    from strata.llm.quality_model import _some, stage_features

    rows = [(None, f"null {i}") for i in range(300)] + [(7, f"hot {i}") for i in range(3000)] + [(8, "copy")] * 300 + [(10 + i, f"own {i}") for i in range(300)]
    features = stage_features(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [r.doc_id for r in _some(features, 400).select("doc_id").collect()]
    assert None not in got and len(got) == 400 and got.count(8) <= 1
    assert _some(features, 10**11).count() == 3000 + 1 + 300  # all, if fewer: no share that could round to none


def test_the_prior_comes_from_all_rows(spark):
    """A sample far too small for an estimate, over rows whose share of good ones is known."""
    pick = np.random.default_rng(3)
    good = lambda i: f"calm words about thing number{i} and more of it here today. " * 3
    bad = lambda i: f"W{i}!! ## BUY {i} $$ NOW && {i * 7} | " * 4
    rows = [(i, good(i) if pick.random() < 0.7 else bad(i)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, t in rows if t.startswith("calm") and pick.random() < 0.25], "doc_id long, quality int")
    _, model = score_quality(docs, labels, F.lit(True), fit_rows=120)
    assert model["prior"] == pytest.approx(0.7, abs=0.05)


def test_the_fit_in_spark_equals_the_local_one_and_takes_long_texts(spark):
    from strata.llm.toxicity import fit_staged

    texts = [(i % 2, 3 + i % 4, [[0, i % 5]] * (i % 3) + [[5]] * (i % 2)) for i in range(60)]
    rows = [(y, n - len(s), np.array([len(x) for x in s], np.int32).tobytes(), np.array([k for x in s for k in x], np.int32).tobytes()) for y, n, s in texts]
    bags = spark.createDataFrame(rows, "toxic int, plain int, sizes binary, ids binary").repartition(3)
    (w, b), (v, c) = fit_staged(bags, 60, 6, 12), fit_noisy_or(texts, 6, 12)
    assert np.allclose(w, v, atol=1e-6) and abs(b - c) < 1e-6
    long = "A calm sentence of many words goes here. " * 250_000  # 10 MB
    docs = [(i, "You vile zork. " * (i % 2) + f"Plain words {i} here.", i % 2) for i in range(60)] + [(100, long, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.lit(True))
    scores = {r.doc_id: r.score for r in score_toxicity(df.select("doc_id", "text"), model).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 1) for i in range(60)) and scores[100] < 0.5
