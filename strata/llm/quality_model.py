"""Quality classifier learnt from trusted positives and unlabelled text (PU learning).

Only rows labelled good are trusted; every other row counts as unlabelled.
The class prior (the share of good rows) is estimated from the scores that a
first classifier of trusted against unlabelled rows, fitted on half of the
sample, gives all other rows of the corpus: at the best cut the share of
unlabelled rows above it over that of trusted rows, by histograms that Spark adds
up. The model then minimises the non-negative unbiased risk

    prior * R_good(+) + max(0, R_unlabelled(-) - prior * R_good(-))

with the logistic loss, so its output estimates the probability of being good.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import plain_key, restore_key, sent_if_small, smallest_hashes, staged

#: Rows of each kind that the model is fitted on: those with the smallest hashes of key and text.
FIT_ROWS = 12_000
#: Bins of the histograms of scores (log-odds from -30 to 30).
BINS = 2048

#: Character classes of the style features, by byte.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", ".,;:'\"()-", "!?", "#*$%&|<>")
_N = len(_CLASSES) + 2
FEATURES = 2 * (_N * _N + 10)


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.uint8)
    table[128:] = len(_CLASSES) + 1
    for k, chars in enumerate(_CLASSES):
        table[list(chars.encode())] = k
    return table


def style(text: str, classes: np.ndarray) -> np.ndarray:
    """Shares of character-class pairs, and how often words and lines repeat."""
    raw = text.encode()
    kinds = classes[np.frombuffer(raw, np.uint8)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * _N + kinds[1:], minlength=_N * _N) / max(1, len(raw) - 1)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, distinct = max(1, len(words)), len(set(words))
    rest = [
        np.log1p(len(words)), distinct / n, np.log1p(len(words)) * (1 - distinct / n), sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), len(raw) / n / 20,
        len(set(zip(words, words[1:], words[2:]))) / max(1, len(words) - 2), float(len(words) < 10), float(not words),
    ]
    x = np.concatenate([np.sqrt(pairs), rest])
    return np.concatenate([x, x * x]).astype(np.float32)


def fit_nnpu(good: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-3) -> np.ndarray:
    """Weights (the last one the bias) that minimise the non-negative risk, by Adam over all rows."""
    rows = np.vstack([good, unlabelled])
    rows = np.hstack([rows, np.ones((len(rows), 1), rows.dtype)])
    n, w = len(good), np.zeros(rows.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = rows @ w
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss_low = -np.log(np.maximum(1 - p, 1e-12))  # the loss of a row if it were bad
        rest = loss_low[n:].mean() - prior * loss_low[:n].mean()
        pull = np.concatenate([-prior * p[:n] / n, p[n:] / (len(rows) - n)])  # the gradient of `rest`
        if rest >= 0:
            pull[:n] += prior * (p[:n] - 1) / n
        else:
            pull = -pull
        g = rows.T @ pull + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def prior_of_counts(good: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """The share of good rows among unlabelled ones from how many of either have their score in each of ascending bins, at the cut with the least upper bound."""
    n_good, n_rest = int(good.sum()), int(unlabelled.sum())
    if n_good < 2 or n_rest < 2:
        return 0.5
    above_p, above_u = (x[::-1].cumsum()[::-1] / n for x, n in ((good, n_good), (unlabelled, n_rest)))
    cuts = np.flatnonzero((above_p >= 0.05) & (good > 0))
    slack = sum(np.sqrt(np.log(4 / confidence) / 2 / n) for n in (n_good, n_rest))
    best = cuts[np.argmin((above_u[cuts] + slack) / above_p[cuts])]
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def bins_of(z: np.ndarray) -> np.ndarray:
    return ((np.clip(z, -30, 29.999) + 30) * (BINS / 60)).astype(np.int32)


def estimate_prior(good: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """`prior_of_counts` of log-odds."""
    return prior_of_counts(*(np.bincount(bins_of(z), minlength=BINS) for z in (good, unlabelled)), confidence)


def scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8).astype(np.float32)


def stage_features(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text and style features of every whole text (null: empty), staged."""

    def extract(batches):
        classes = _class_table()
        for batch in batches:
            yield batch[["doc_id", "no_key", "text_hash"]].assign(x=[style(t, classes).tobytes() for t in batch["text"].fillna("")])

    text = F.col("text").cast("string")
    rows = plain_key(docs, "doc_id", F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    return staged(restore_key(rows.mapInPandas(extract, "doc_id long, no_key boolean, text_hash long, x binary"), "doc_id"), "style")


def _some(rows: DataFrame, wanted: int) -> DataFrame:
    """At most ``wanted`` of the different (doc_id, text) of ``rows``, by the smallest hashes of both; null keys never."""
    keys = F.broadcast(smallest_hashes(rows, wanted))  # a documented bound of fixed-size rows
    return rows.join(keys, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])


def _log_odds(features: DataFrame, model: dict, column: str, kind: str, of) -> DataFrame:
    """doc_id, text_hash and ``column``: what ``of`` makes of the log-odds of every row."""

    def score(batches):
        for batch in batches:
            if len(batch):
                x = scaled(np.frombuffer(b"".join(batch["x"]), np.float32).reshape(len(batch), FEATURES), model["mean"], model["scale"])
                yield batch[["doc_id", "no_key", "text_hash"]].assign(**{column: of(x @ model["w"][:-1] + model["w"][-1])})

    found = plain_key(features, "doc_id", "text_hash", "x").mapInPandas(score, f"doc_id long, no_key boolean, text_hash long, {column} {kind}")
    return restore_key(found, "doc_id")


def corpus_prior(features: DataFrame, trusted: DataFrame, learn: Column, fitted: DataFrame, model: dict) -> float:
    """The class prior from the scores of all rows that may be learnt from but those ``fitted`` (staged keys): only counts by bin reach the driver."""
    placed = _log_odds(features.where("doc_id is not null").where(learn), model, "bin", "int", bins_of)
    placed = placed.join(F.broadcast(fitted), ["doc_id", "text_hash"], "left_anti")
    placed = staged(placed.select("doc_id", "bin"), "score-bins")
    counts = np.zeros((2, BINS), np.int64)
    for kind, rows in enumerate((placed.join(sent_if_small(trusted, 16), "doc_id", "left_semi"), placed)):
        for r in rows.groupBy("bin").count().collect():  # BINS rows at most
            counts[kind, r["bin"]] = r["count"]
    return prior_of_counts(*counts)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS, prior: float | None = None) -> tuple[DataFrame, dict]:
    """(doc_id, text_hash, score) of every row of ``docs``, and the model.

    ``labels``: doc_id and quality; ``learn``: which keys may be learnt from.
    The fit uses ``fit_rows`` trusted and as many unlabelled rows, all when
    there are fewer; rows that repeat a key and its text count once there; the
    class prior comes from all rows. Null texts count as empty; null keys are
    scored and never learnt from; labels that contradict each other count as
    not good; without trusted rows all scores are 0.5. Other columns are
    ignored.
    """
    features = stage_features(docs)
    trusted = labels.where(learn).where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"))
    trusted = staged(trusted.where("q = 1").select("doc_id"), "trusted")
    keys = features.select("doc_id", "text_hash").where(learn)
    chosen = [smallest_hashes(k, fit_rows) for k in (keys.join(sent_if_small(trusted, 16), "doc_id", "left_semi"), keys)]
    half = F.pmod(F.xxhash64("text_hash", "doc_id", F.lit(1)), F.lit(2)) == 0
    sample = [features.join(F.broadcast(k), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "x", half.alias("half")).dropDuplicates(["doc_id", "text_hash"]).collect() for k in chosen]
    good, rest = (np.array([np.frombuffer(r["x"], np.float32) for r in x]).reshape(-1, FEATURES) for x in sample)
    if not len(good) or not len(rest):
        model = {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "w": np.zeros(FEATURES + 1), "prior": 0.5}
    else:
        mean, scale = rest.mean(axis=0), rest.std(axis=0) + 1e-4
        good, rest = (scaled(x, mean, scale) for x in (good, rest))
        model = {"mean": mean, "scale": scale, "prior": prior}
        if prior is None:  # one half, by another hash, fits the first classifier; all other rows give the estimate
            first = [x[np.array([r["half"] for r in s], bool)] for x, s in zip((good, rest), sample)]
            if all(map(len, first)):
                fitted = staged(chosen[0].union(chosen[1]).where(half).distinct(), "fitted-keys")
                model["prior"] = corpus_prior(features, trusted, learn, fitted, model | {"w": fit_nnpu(*first, 0.5, steps=150)})
            else:
                model["prior"] = 0.5
        model["w"] = fit_nnpu(good, rest, model["prior"])
    return _log_odds(features, model, "score", "double", lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))), model
