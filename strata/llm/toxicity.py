"""Toxicity by multiple-instance learning: a text is toxic if one of its sentences is.

Only texts are labelled. A sentence's probability is logistic in the words
(and word beginnings) it holds; a text's is their noisy-or,
1 - product(1 - p). Its likelihood is maximised over the labelled texts, so the
learnt weights say which sentences offend. The texts' known terms are staged once;
every step of the fit (L-BFGS) is a pass of Spark over them that adds up losses
and gradients, so the driver sees weights only, however long the texts are.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import plain_key, restore_key, sent_if_small, smallest_hashes, staged

#: Labelled texts the model is fitted on: those with the smallest hashes of key and text; parts that they are added up in.
FIT_ROWS, FIT_PARTS = 16_000, 16
#: Passes of the fit over the staged terms, at most.
FIT_PASSES = 60
#: Words and word beginnings the model weighs, and in how many of the fitted texts each must be.
TERMS, LEAST_TEXTS = 4096, 3
#: Lengths of the word beginnings that count as terms next to whole words.
STARTS = (3, 4, 5)

_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|$)")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the pieces up to a full stop, exclamation or question mark, or line end."""
    return [m.span() for m in _SENTENCE.finditer(text) if m.end() > m.start()]


def terms(words) -> set[str]:
    found = set(words)
    found.update([f"{w[:k]}*" for w in found for k in STARTS if len(w) > k])
    return found


def hits(text: str, vocabulary: dict[str, int]) -> tuple[int, list[tuple[int, int, list[int]]]]:
    """The number of sentences, and (start, end, known terms) of those that hold any."""
    found, n, known, low = [], 0, {}, text.lower()
    if len(low) != len(text):  # positions must hold in the text itself
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for start, end in sentences(text):
        n += 1
        ids: list[int] = []
        for word in _WORD.findall(low, start, end):
            if (of_word := known.get(word)) is None:
                known[word] = of_word = [vocabulary[t] for t in (word, *(f"{word[:k]}*" for k in STARTS if len(word) > k)) if t in vocabulary]
            ids += of_word
        if ids:
            found.append((start, end, sorted(set(ids))))
    return n, found


def noisy_or(sentence_of: np.ndarray, term: np.ndarray, text_of: np.ndarray, plain: np.ndarray, w: np.ndarray, bias: float):
    """Sentence probabilities and log(1 - probability) of the texts; ``plain``: sentences without known terms by text."""
    z = np.bincount(sentence_of, w[term], len(text_of)) + bias
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    none = np.bincount(text_of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(plain))
    return p, none + plain * np.log1p(-1 / (1 + np.exp(-bias)))


def loss_and_gradient(y: np.ndarray, plain: np.ndarray, sizes: list[np.ndarray], term: np.ndarray, w: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
    """Summed loss of texts and its gradient (the last one of the bias); ``sizes``: known terms of each sentence that has any, by text; ``term``: these, one after another."""
    each = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
    text_of = np.repeat(np.arange(len(y)), [len(s) for s in sizes])
    sentence_of = np.repeat(np.arange(len(each)), each)
    p, none = noisy_or(sentence_of, term, text_of, plain, w, bias)
    none = np.minimum(none, -1e-9)
    pull = np.where(y > 0, -np.exp(none) / -np.expm1(none), 1.0)  # d loss / d log-odds of a sentence, over its p
    by_sentence = pull[text_of] * p
    loss = np.where(y > 0, -np.log(-np.expm1(none)), -none).sum()
    ahead = np.bincount(term, by_sentence[sentence_of], len(w))
    return float(loss), np.append(ahead, by_sentence.sum() + (pull * plain).sum() / (1 + np.exp(-bias)))


def minimise(summed, n_texts: int, n_terms: int, steps: int, l2: float = 2e-5, memory: int = 10) -> tuple[np.ndarray, float]:
    """Weights and bias (-2 at most) by L-BFGS; ``summed(w, bias)`` gives loss and gradient over all texts."""

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, g = summed(x[:-1], float(x[-1]))
        return loss / n_texts + l2 / 2 * float(x[:-1] @ x[:-1]), g / n_texts + l2 * np.append(x[:-1], 0)

    x = np.append(np.zeros(n_terms), -6.0)
    (f, g), kept, passes = at(x), [], 1
    while passes < steps and np.abs(g).max(initial=0) > 1e-6:
        step, alphas = -g, []
        for s, y in reversed(kept):
            alphas.append(a := (s @ step) / (s @ y))
            step = step - a * y
        step = step * (kept[-1][0] @ kept[-1][1] / (kept[-1][1] @ kept[-1][1]) if kept else min(1.0, 4 / max(1e-12, np.abs(g).max())))
        for (s, y), a in zip(kept, reversed(alphas)):
            step = step + (a - (y @ step) / (s @ y)) * s
        if (slope := g @ step) >= 0:
            step, slope, kept = -g, -(g @ g), []
        size = min(1.0, 8 / np.abs(step).max())
        while passes < steps:
            new = x + size * step
            new[-1] = min(new[-1], -2.0)
            (f_new, g_new), passes = at(new), passes + 1
            if f_new <= f + 1e-4 * size * slope or size < 1e-6:
                break
            size /= 3
        s, y = new - x, g_new - g
        done = f - f_new < 1e-7 * abs(f)
        if f_new <= f:
            x, f, g = new, f_new, g_new
            if s @ y > 1e-12:
                kept = [*kept, (s, y)][-memory:]
        if done:
            break
    return x[:-1], float(x[-1])


def fit_noisy_or(texts: list[tuple[int, int, list[list[int]]]], n_terms: int, steps: int = FIT_PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, number of sentences, terms of the sentences that have any) of a few texts."""
    y, plain = np.array([t[0] for t in texts]), np.array([t[1] - len(t[2]) for t in texts], float)
    sizes = [np.array([len(s) for s in t[2]], np.int64) for t in texts]
    term = np.array([k for t in texts for s in t[2] for k in s], np.int64)
    return minimise(lambda w, bias: loss_and_gradient(y, plain, sizes, term, w, bias), len(texts), n_terms, steps)


def fit_staged(bags: DataFrame, n_texts: int, n_terms: int, steps: int = FIT_PASSES) -> tuple[np.ndarray, float]:
    """`fit_noisy_or` of staged ``bags`` (toxic, plain, sizes, ids): each pass gives one loss and gradient a task."""

    def summed(w: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
        def add(batches):
            loss, gradient = 0.0, np.zeros(n_terms + 1)
            for batch in batches:
                sizes = [np.frombuffer(s, np.int32) for s in batch["sizes"]]
                ids = np.frombuffer(b"".join(batch["ids"]), np.int32).astype(np.int64)
                part, g = loss_and_gradient(batch["toxic"].to_numpy(), batch["plain"].to_numpy(float), sizes, ids, w, bias)
                loss, gradient = loss + part, gradient + g
            yield pd.DataFrame({"loss": [loss], "gradient": [gradient.tobytes()]})

        parts = bags.mapInPandas(add, "loss double, gradient binary").collect()  # FIT_PARTS rows at most
        return sum(r["loss"] for r in parts), sum((np.frombuffer(r["gradient"]) for r in parts), np.zeros(n_terms + 1))

    return minimise(summed, n_texts, n_terms, steps)


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> dict:
    """Vocabulary, weights and bias learnt from ``fit_rows`` of the labelled texts whose keys may be learnt from (all, if fewer); equal texts of a key count once.

    Labels that contradict each other count as toxic. Without labels of both
    kinds the vocabulary is empty and every text scores near zero.
    """
    known = labels.where(learn).where("doc_id is not null and toxic is not null")
    known = staged(known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")), "known")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    keys = smallest_hashes(texts.select("doc_id", "text_hash").join(sent_if_small(known, 24), "doc_id", "left_semi"), fit_rows)
    keys = F.broadcast(keys.join(known, "doc_id"))  # fit_rows rows of three numbers
    sample = texts.join(keys, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    sample = staged(sample.select("toxic", "text").repartition(FIT_PARTS), "labelled")

    def count(batches):
        seen: list[Counter] = [Counter(), Counter()]

        def flush():
            every = list(set().union(*seen))
            for k in range(0, len(every), 100_000):
                some = every[k : k + 100_000]
                yield pd.DataFrame({"term": some, "clean": [seen[0][t] for t in some], "toxic": [seen[1][t] for t in some]})

        for batch in batches:
            for y, text in zip(batch["toxic"], batch["text"]):
                seen[y].update(terms(_WORD.findall(text.lower())))
                if len(seen[0]) > 1_000_000:  # pre-aggregated counts, added up below
                    yield from flush()
                    seen = [Counter(), Counter()]
        yield from flush()

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {"vocabulary": {}, "w": np.zeros(0), "bias": -6.0}
    counts = sample.mapInPandas(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rate = (F.col("clean") + 0.5) / n[0]
    telling = (F.col("toxic") / n[1] - rate) / F.sqrt(rate * F.greatest(1 - rate, F.lit(0.01)) / n[1])
    best = counts.where(F.col("toxic") >= LEAST_TEXTS).orderBy(F.desc(telling), "term").limit(TERMS)
    vocabulary = {r["term"]: k for k, r in enumerate(best.collect())}

    def find(batches):
        for batch in batches:
            for y, text in zip(batch["toxic"], batch["text"]):
                total, found = hits(text, vocabulary)
                sizes, ids = [len(s[2]) for s in found], [k for s in found for k in s[2]]
                yield pd.DataFrame({"toxic": [y], "plain": [total - len(found)], "sizes": [np.array(sizes, np.int32).tobytes()], "ids": [np.array(ids, np.int32).tobytes()]})

    bags = staged(sample.mapInPandas(find, "toxic int, plain int, sizes binary, ids binary"), "sentence-terms")
    w, bias = fit_staged(bags, sum(n.values()), len(vocabulary))
    return {"vocabulary": vocabulary, "w": w, "bias": bias}


def score_toxicity(docs: DataFrame, model: dict, located: float = 0.5) -> DataFrame:
    """doc_id, score, and the sentences (start, end, score; code points) that reach ``located``.

    Null and empty texts score 0; null and repeated keys are scored like any
    other row; other columns are ignored.
    """
    vocabulary, w, bias = model["vocabulary"], model["w"], model["bias"]

    def score(batches):
        base = float(np.log1p(-1 / (1 + np.exp(-bias))))
        for batch in batches:
            scores, where = [], []
            for text in batch["text"].fillna(""):
                n, found = hits(text, vocabulary)
                z = np.array([w[ids].sum() + bias for _, _, ids in found])
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                scores.append(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum() + (n - len(found)) * base)))
                where.append([(a, b, float(x)) for (a, b, _), x in zip(found, p) if x >= located])
            yield batch[["doc_id", "no_key"]].assign(score=scores, sentences=where)

    rows = plain_key(docs, "doc_id", F.col("text").cast("string").alias("text"))
    scored = rows.mapInPandas(score, "doc_id long, no_key boolean, score double, sentences array<struct<start: int, end: int, score: double>>")
    return restore_key(scored, "doc_id")
