"""Quality rules whose cutoffs carry a guarantee on how many good texts they reject.

Every rule compares a share of a text (in permille) with a cutoff. On labelled
texts the cutoffs of a rule are tested from lenient to strict: one is certified
when the exact binomial test rejects "good texts are rejected at more than the
rule's part of the risk", and the first failure ends the sequence, which needs
no correction inside it. Over rules and strata the level is divided (Bonferroni),
so with the stated confidence all strata hold at once. Of the certified cutoffs
the most lenient one that still rejects nearly as many bad texts is used.

DataFrame expressions only; the driver sees the counts of one stratum and rule
at a time, for all strata that have enough good labels for any certificate.
"""

from __future__ import annotations

from math import exp, lgamma, log, log1p

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import BROADCAST_BYTES, sent_if_small, staged

_BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Cutoffs that are tested, from lenient to strict.
CUTOFFS = tuple(range(900, 0, -25))
#: Risk: share of a stratum's good texts that all rules together may reject; LEVEL: chance that any guarantee fails.
RISK, LEVEL = 0.05, 0.05
#: Share of the bad texts rejected by the strictest certified cutoff that the chosen one must reject too.
CATCH = 0.995
#: Rules: name -> (part, whole), columns of `measure`.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_windows": ("n_repeat_words", "n_words"),
    "repeated_neighbours": ("n_same_next", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside other lambda functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Number of words in windows of ``WINDOW`` words that are found twice or more, by 64-bit window hashes."""

    def covered(starts: Column) -> Column:  # a window reaches WINDOW words on, or to where the next one starts
        steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)

    def twice(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def neighbours(s: Column) -> Column:
            equal = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))

        found = let(let(placed, neighbours), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, twice))


def measure(text: Column) -> Column:
    """A struct of a text's counts; a null text has none of anything, and one line without words."""

    def chars(rest: str) -> Column:
        return F.length(F.regexp_replace(text, rest, "")).cast("long")

    def of_words(words: Column) -> Column:
        same = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: (a == b))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            _repeated(words).alias("n_repeat_words"),
            F.size(F.filter(same, lambda x: x)).cast("long").alias("n_same_next"),
        )

    text = F.coalesce(text, F.lit(""))
    words = let(F.filter(F.split(text, _BLANKS), lambda w: w != ""), of_words)
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("distinct")))

    def whole(w: Column) -> Column:
        return let(lines, lambda n: F.struct(
            *(w[c].alias(c) for c in ("n_words", "word_chars", "n_repeat_words", "n_same_next")),
            chars(r"[^#*$%&|<>]+").alias("n_symbols"), chars(r"[^\p{Lu}]+").alias("n_capitals"),
            n["n"].alias("n_lines"), (n["n"] - n["distinct"]).alias("n_dup_lines"),
        ))

    return let(words, whole)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed from the largest term down until the rest is negligible."""
    if k >= n:
        return 1.0
    total, i, term = 0.0, k, lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
    if k > n * p:  # the other tail is the short one
        return 1.0 - _upper(k + 1, n, p)
    while i >= 0:
        total += exp(term)
        if i == 0 or exp(term) < 1e-18 * total:
            break
        term += log(i) - log(n - i + 1) + log1p(-p) - log(p)
        i -= 1
    return min(1.0, total)


def _upper(k: int, n: int, p: float) -> float:
    total, term = 0.0, lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
    for i in range(k, n + 1):
        total += exp(term)
        if exp(term) < 1e-18 * total:
            break
        term += (log(n - i) if n > i else 0) - log(i + 1) + log(p) - log1p(-p)
    return min(1.0, total)


def choose_cutoff(good: list[int], bad: list[int], risk: float, level: float) -> int | None:
    """The cutoff of one rule and stratum, or None if not even the most lenient one is certified.

    ``good[k]``, ``bad[k]``: how many labelled texts exceed k of ``CUTOFFS``,
    which are its k strictest ones.
    """
    n, certified = sum(good), 0
    for k in range(len(CUTOFFS)):
        if not n or binomial_tail(sum(good[len(CUTOFFS) - k :]), n, risk) > level:
            break
        certified += 1
    if not certified:
        return None
    caught = [sum(bad[len(CUTOFFS) - k :]) for k in range(certified)]
    return CUTOFFS[next(k for k, x in enumerate(caught) if x >= CATCH * caught[-1])]


def choose_cutoffs(measured: DataFrame, risk: float = RISK, level: float = LEVEL) -> dict[tuple[str, str], int]:
    """(stratum, rule) -> cutoff from ``measured``: stratum, quality and the counts of labelled texts."""
    sizes = staged(measured.groupBy("stratum").agg(F.count(F.when(F.col("quality") == 1, 1)).alias("n_good")), "strata")
    part, level = risk / len(RULES), level / max(1, sizes.count() * len(RULES))
    enough = staged(sizes.where(F.col("n_good") * -log1p(-part) >= -log(level) - 1e-9).select("stratum"), "judged-strata")  # with fewer, not even no rejected text certifies
    cutoffs = F.array(*map(F.lit, CUTOFFS))
    levels = [
        F.struct(F.lit(rule).alias("rule"), let(F.struct(F.col(n).alias("p"), F.col(whole).alias("w")), lambda x: F.size(F.filter(cutoffs, lambda c: 1000 * x["p"] > c * x["w"]))).alias("over"))
        for rule, (n, whole) in RULES.items()
    ]
    rows = measured.join(sent_if_small(enough, F.octet_length("stratum")), "stratum", "left_semi").select("stratum", "quality", F.explode(F.array(*levels)).alias("x"))
    counts = rows.groupBy("stratum", "quality", "x.rule", "x.over").count()
    counts = staged(counts.groupBy("stratum", "rule").agg(F.collect_list(F.struct("quality", "over", "count")).alias("counts")), "rule-counts")
    chosen = {}
    for r in counts.toLocalIterator():  # a row a rule and stratum, a few hundred good labels behind each: at most a hundredth of the labels, one partition at a time
        good, bad = [0] * (len(CUTOFFS) + 1), [0] * (len(CUTOFFS) + 1)
        for x in r["counts"]:
            (good if x["quality"] == 1 else bad)[x["over"]] += x["count"]
        chosen[r["stratum"], r["rule"]] = choose_cutoff(good, bad, part, level)
    return {k: c for k, c in chosen.items() if c is not None}


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Every column of ``docs`` (doc_id, text, lang) but the text, a hash of it, its counts, ``base_failed`` and ``kept``, staged.

    Strata are the values of ``lang`` (null is one of them). Null texts have
    no words and fail the base rules; null keys are judged and never labelled;
    rows that repeat a key are judged each; labels that contradict each other
    count as bad; without labels only the base rules reject. Columns of
    ``docs`` must not be named like the counts; further ones are dropped.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), measure(text).alias("m"))
    measured = staged(rows.select("doc_id", "text_hash", "stratum", "m.*"), "measured")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cutoffs = choose_cutoffs(measured.join(known, "doc_id"), risk, level)
    strata = sorted({s for s, _ in cutoffs})
    limits = docs.sparkSession.createDataFrame([(s, *(cutoffs.get((s, r)) for r in RULES)) for s in strata], ", ".join(["stratum string", *(f"limit_{r} int" for r in RULES)]))
    rows = measured.join(F.broadcast(limits) if sum(len(x.encode()) + 64 for x in strata) <= BROADCAST_BYTES else limits, "stratum", "left")
    rejected = F.lit(False)
    for rule, (part, whole) in RULES.items():
        rejected |= F.coalesce(1000 * F.col(part) > F.col(f"limit_{rule}") * F.col(whole), F.lit(False))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select(*measured.columns, failed.alias("base_failed"), (~failed & ~rejected).alias("kept"))
