"""Homomorphic fingerprints of documents: wide vectors of their paragraphs, added up modulo powers of two.

A text is a multiset of paragraphs (its lines that aren't empty). Each gives a
vector of ``WORDS`` numbers below 2**60, and a text's fingerprint is their sum
modulo 2**60. So the order of paragraphs doesn't matter, and a paragraph is
inserted or deleted by adding or subtracting its vector, without the rest of
the text. A vector holds

* how many features the paragraph has: its different words, each with the one
  before it (of runs without blanks, pieces of ``PIECE`` code points);
* ``SKETCH`` numbers of four 15-bit lanes: each feature adds 1 or -1 to the
  lanes of one of them, as its hash says. Such sums of random signs estimate, by
  their squares, how many features only one of two texts has, which gives the
  texts' likeness. Numbers whose squares are ``HEAVY`` times the middle one's
  are left out of it, so no feature that is repeated very often can outweigh
  all others;
* ``EQUAL`` numbers of the paragraph's SHA-256 hashes, which tell texts with
  different paragraphs apart (480 bits).

DataFrame expressions only.
"""

from __future__ import annotations

import json
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.common import shuffle_width
from strata.llm.quality_rules import let

#: Fixed layout of a vector: bits and hexadecimal digits of a number, lanes of a sketch number and their bits.
BITS, DIGITS, LANES, LANE_BITS = 60, 15, 4, 15
SKETCH, EQUAL = 15, 8
WORDS = 1 + SKETCH + EQUAL
_MASK = (1 << BITS) - 1
_ONES = sum(1 << (LANE_BITS * k) for k in range(LANES))
_HALF = 1 << (LANE_BITS - 1)

#: Times the middle sum of squares beyond which a sketch number is left out of a likeness.
HEAVY = 8
#: Code points of a word's pieces.
PIECE = 24
#: Ranges of the document order for each shuffle partition.
RANGES = 2
_KEY = ("known", "id", "h", "u")


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda n, x: (n + of(x)).bitwiseAND(F.lit(_MASK)))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def _features(paragraph: Column) -> Column:
    """Different 60-bit hashes of the words, each with the one before it (none before the first)."""
    words = F.regexp_extract_all(paragraph, F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))

    def pairs(w: Column) -> Column:
        return F.transform(w, lambda x, i: _number(F.substr(F.md5(F.concat(F.coalesce(F.get(w, i - 1), F.lit("")), F.lit(" "), x)), F.lit(1), F.lit(DIGITS))))

    return F.array_distinct(let(words, pairs))


def vector(parts: Column) -> Column:
    """The sum of the vectors of an array of paragraphs."""

    def sketch(features: Column) -> Column:
        def number(j: int) -> Column:  # the bits above the topmost lane's choose the number
            own = F.filter(features, lambda x: F.shiftright(x, BITS - LANE_BITS + 1) % SKETCH == j)
            return _sum(own, lambda x: 2 * x.bitwiseAND(F.lit(_ONES)) - _ONES)

        return F.array(F.size(features).cast("long"), *map(number, range(SKETCH)))

    def equal(hashes: Column) -> Column:
        return F.array(*(_sum(hashes, lambda x, k=k, at=1 + i * DIGITS: _number(F.substr(x[k], F.lit(at), F.lit(DIGITS)))) for k in range(2) for i in range(EQUAL // 2)))

    hashes = F.transform(parts, lambda p: F.array(*(F.sha2(F.concat(F.lit(f"{k}:"), p), 256) for k in range(2))))
    return F.concat(let(F.flatten(F.transform(parts, _features)), sketch), let(hashes, equal))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (null: of the empty text, all zeros) as an array of ``WORDS`` longs."""
    return let(paragraphs(F.coalesce(text, F.lit(""))), vector)


def inserted(to: Column, parts: Column) -> Column:
    """Fingerprint ``to`` with the paragraphs ``parts`` inserted, anywhere."""
    return F.zip_with(to, let(parts, vector), lambda a, b: (a + b).bitwiseAND(F.lit(_MASK)))


def deleted(of: Column, parts: Column) -> Column:
    """Fingerprint ``of`` without the paragraphs ``parts``, each of which it must hold."""
    return F.zip_with(of, let(parts, vector), lambda a, b: (a - b).bitwiseAND(F.lit(_MASK)))


def rendered(of: Column) -> Column:
    """Lowercase hexadecimal digits, ``DIGITS`` a number."""
    return F.array_join(F.transform(of, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0")), "")


def _lanes(number: Column) -> list[Column]:
    """The sums of signs in a sketch number."""
    raised = number + _HALF * _ONES  # makes every lane positive; what runs over the top is cut off below
    return [F.shiftrightunsigned(raised, LANE_BITS * k).bitwiseAND(F.lit(2 * _HALF - 1)) - _HALF for k in range(LANES)]


def likeness(x: Column, y: Column) -> Column:
    """0 to 1: one less the (estimated) share of features that only one of two texts has; 1 for equal fingerprints, 0 if either text alone has no words."""

    def compare(a: Column, b: Column) -> Column:
        pairs = list(zip(_lanes(a), _lanes(b)))
        apart, whole = (sum((f(p, q) for p, q in pairs[1:]), f(*pairs[0])) for f in (lambda p, q: (p - q) * (p - q), lambda p, q: p * p + q * q))
        return F.struct(apart.alias("d"), whole.alias("n"))

    def mean(parts: Column) -> Column:
        middle = F.get(F.array_sort(F.transform(parts, lambda v: v["n"])), F.floor((F.size(parts) - 1) / 2).cast("int"))
        usual = let(middle, lambda m: F.filter(parts, lambda v: v["n"] <= HEAVY * m))

        def share(v: Column) -> Column:
            d, n = (F.aggregate(v, F.lit(0).cast("long"), lambda t, p: t + p[k]) for k in ("d", "n"))
            return F.greatest(F.lit(0.0), 1 - d.cast("double") / n)

        return let(usual, share)

    parts = F.filter(F.zip_with(F.slice(x, 2, SKETCH), F.slice(y, 2, SKETCH), compare), lambda v: v["n"] > 0)
    return F.when(x == y, F.lit(1.0)).otherwise(let(parts, lambda v: F.when(F.size(v) > 0, mean(v)).otherwise(F.lit(0.0))))


def _constant(value, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def _range_of(key: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` after the first are at most ``key``: by blocks of them, then within one."""
    step = isqrt(len(bounds) - 1) + 1
    kind = "struct<known:boolean,id:bigint,h:bigint,u:bigint>"
    blocks = [bounds[k : k + step] for k in range(0, len(bounds), step)]

    def below(these: Column) -> Column:
        return F.greatest(F.size(F.filter(these, lambda b: b <= key)) - 1, F.lit(0))

    firsts = _constant([b[0] for b in blocks], f"array<{kind}>")
    return let(below(firsts), lambda g: g * step + below(F.get(_constant(blocks, f"array<array<{kind}>>"), g)))


def with_next(docs: DataFrame, key: str, **columns: Column) -> DataFrame:
    """``key`` (a long) and text (never null) of ``docs``, ``columns`` made of these, and next_<name> of the text and each column: that of the next row by ``key`` (null first), then text hash; after the last comes the first.

    Ranges of the order meet in one task each. Their bounds are the least keys
    of a range shuffle of keys alone, over text hashes and row numbers too, so
    that repeated keys and rows spread as well. The first row after a range is
    put at its end, as one more row.
    """
    spark = docs.sparkSession
    rows = docs.select(key, "text").withColumns({"known": F.col(key).isNotNull(), "id": F.coalesce(key, F.lit(0)), "h": F.xxhash64("text"), "u": F.monotonically_increasing_id()})
    n_ranges = RANGES * shuffle_width(spark)
    least = rows.select(*_KEY).repartitionByRange(n_ranges, *_KEY).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*_KEY)).alias("b"))
    bounds = sorted(tuple(r["b"]) for r in least.collect())  # one row a range
    if not bounds:
        return docs.select(key, "text").withColumns(columns).select("*", *(F.col(c).alias(f"next_{c}") for c in ["text", *columns]))
    bounds = [dict(zip(_KEY, b)) for b in bounds]
    rows = rows.withColumn("range", _range_of(F.struct(*_KEY), bounds))
    heads = [{"of": (k - 1) % len(bounds), "known": b["known"], "id": b["id"], "h": b["h"]} for k, b in enumerate(bounds)]
    heads = spark.range(0, 1, 1, 1).select(F.inline(_constant(heads, "array<struct<of:int,known:boolean,id:bigint,h:bigint>>")))  # no Python worker
    wanted = F.broadcast(heads.select("known", "id", "h").distinct())  # one row a range at most
    firsts = rows.select(key, "text", "known", "id", "h").join(wanted, ["known", "id", "h"], "left_semi").dropDuplicates(["known", "id", "h"])
    firsts = firsts.join(F.broadcast(heads), ["known", "id", "h"]).withColumnRenamed("of", "range").withColumn("u", F.lit(0).cast("long"))
    both = rows.withColumn("after", F.lit(False)).unionByName(firsts.withColumn("after", F.lit(True))).withColumns(columns)
    order = Window.partitionBy("range").orderBy("after", *_KEY)
    both = both.select(key, "text", *columns, "after", *(F.lead(c).over(order).alias(f"next_{c}") for c in ["text", *columns]))
    return both.where("not after").drop("after")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    The edited text has the first code points of the next document (ascending
    doc_id, null first; repeated ids by text hash; after the last the first)
    in place of its last quarter. Its fingerprint comes from the text's own:
    the paragraphs from the cut on are deleted, the new ones inserted. Null
    texts count as empty; repeated rows are kept; other columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", own=fingerprint(F.col("text")))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")

    def edit(c: Column) -> Column:
        kept, new = F.substr(F.col("text"), F.lit(1), n - c), F.substr(F.col("next_text"), F.lit(1), c)

        def tails(line: Column) -> Column:  # the kept part of the line that is cut
            old = F.substr(F.col("text"), n - c - F.length(line) + 1)
            return F.struct(F.sha2(F.concat(kept, new), 256).alias("sha"), old.alias("old"), F.concat(line, new).alias("new"))

        return let(F.element_at(F.split(kept, "\n"), -1), tails)

    edited = let(cut, edit)
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("e"))
    rows = rows.select("doc_id", "n_chars", "own", "next_own", F.col("e.sha").alias("edited_sha256"), let(inserted(let(deleted(F.col("own"), paragraphs(F.col("e.old"))), lambda x: x), paragraphs(F.col("e.new"))), lambda x: F.struct(x.alias("own"))).alias("edited"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", rendered(F.col("own")).alias("fingerprint"), rendered(F.col("edited.own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited.own")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
