"""Personal data: fixed patterns, and terms that give protected entities away.

Patterns find emails, ip addresses, card and phone numbers. Each value found is
a protected entity; the terms of the texts that hold it (runs of letters and
digits outside base spans) may give it away. Let n different texts hold the
entity, s the term and k both. A term discloses an entity if

* they meet more often than by chance: the chance of k or more of s, given that
  they meet twice at least (a word met once or twice says nothing), if each text
  held the entity with probability n / N or BASE_RATE, whatever is more, bounded
  by Chernoff; with all pairs that meet twice as tests, the share of false
  findings is kept below FALSE_SHARE (Benjamini and Hochberg); and
* it gives away DISCLOSURE of the entity's information among POPULATION texts:

      ln((k / s) / (n / POPULATION)) >= DISCLOSURE * ln(POPULATION / n),

  where for k / s, the chance that a text with the term holds the entity, the
  lower confidence bound (Wilson, CONFIDENCE) is taken. Pairs for which the
  texts with any entity alone rule this out are not counted in all texts.

Neither depends on how many other texts there are, as long as the entity is in
less than BASE_RATE of all, so joining a corpus with unrelated texts changes no
verdict. A disclosing term is generalised wherever it stands, in texts without
any entity too: to its class (WORD, NUMBER or CODE), or where texts with that
class give the entity away, to any TERM, or where these do so too, it is removed.
Equal texts count once.

DataFrame expressions only.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import fresh, scratch, sent_if_small, staged
from strata.llm.quality_rules import let

KINDS = ("email", "ip", "card", "phone")
#: Least share of an entity's information that a term must give away.
DISCLOSURE = 0.9
#: Normal quantile of the one-sided confidence (95 %) that it does.
CONFIDENCE = 1.645
#: Texts among which a term must single out an entity, and the least chance that a text without any relation is taken to hold one.
POPULATION, BASE_RATE = 1_000_000, 0.01
#: Share of pairs found to meet more often than by chance that may be false.
FALSE_SHARE = 0.05
#: Steps of -ln(chance) that are told apart, and the largest of them.
CHANCE_STEPS, CHANCE_MOST = 16, 700
#: Pairs of entities and terms of one text that meet in one task; a text with more is dealt out to several.
TEXT_PAIRS = 1 << 16
#: Spans whose positions are added up in one go; longer lists are added up in blocks of this size.
BLOCK = 256

# The patterns as given, made possessive (nothing after a part can give characters back), and kept
# from starting inside a run they have already failed on. \G is the end of the match before.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
_NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_TERM = r"[\p{L}\p{M}\p{N}]++"
_SPANS = "array<struct<start:int,end:int>>"
_TERM_SPANS = "array<struct<start:int,end:int,label:string>>"


def positions(text: Column, pattern: str) -> Column:
    """Struct of the matches of ``pattern`` and their spans (code points, end exclusive)."""

    def add_up(lengths: Column) -> Column:
        def block(b: Column) -> Column:
            empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

            def step(acc: Column, x: Column) -> Column:
                start = acc["at"] + x["gap"]
                return F.struct((start + x["own"]).alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + x["own"]).alias("end")))).alias("out"))

            return F.aggregate(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), empty, step)

        def join_blocks(blocks: Column) -> Column:
            zero = F.array(F.lit(0))
            bases = F.aggregate(blocks, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"])))
            return let(bases, lambda base: F.flatten(F.transform(blocks, lambda x, i: F.transform(x["out"], lambda s: F.struct((s["start"] + F.get(base, i)).alias("start"), (s["end"] + F.get(base, i)).alias("end"))))))

        return let(F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), block), join_blocks)

    def spans(m: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m, lambda g, x: F.struct(F.length(g).alias("gap"), F.length(x).alias("own")))
        return F.struct(m.alias("m"), F.when(F.size(m) == 0, F.array().cast(_SPANS)).otherwise(let(lengths, add_up)).alias("s"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""

    def step(n: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return n + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), let(digits, _luhn)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text as an array of (kind, start, end, value), by kind as listed, then start."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str) -> Column:
        needed = F.contains(text, F.lit(_NEEDED[kind])) if _NEEDED[kind] else text.rlike("[0-9]")
        found = F.when(needed, let(positions(text, _PATTERNS[kind]), lambda p: F.zip_with(
            p["m"], p["s"], lambda m, s: F.when(_valid(kind, m), F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), m.alias("value")))
        )))
        return F.coalesce(F.filter(found, lambda x: x.isNotNull()), none)

    return F.concat(*map(of, KINDS))


def replaced(text: Column, spans: Column, mark) -> Column:
    """``text`` with each of the sorted ``spans`` replaced by ``mark(span, first code point not yet replaced)``; ``mark`` also sees spans that start inside an earlier one."""

    def step(acc: Column, s: Column) -> Column:
        out = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), mark(s, acc["at"]))
        inside = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, F.concat(acc["out"], mark(s, acc["at"]))).otherwise(out).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))


def visible(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of the base spans: as long as before, so positions hold."""
    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    blank = replaced(text, places, lambda s, at: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], at), F.lit(0))))
    return F.when(F.size(spans) == 0, text).otherwise(blank)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, row (unique), a hash of the text, base spans, distinct entities, and distinct terms outside base spans of every text; staged.

    Null texts count as empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.xxhash64("text").alias("text_hash"), let(base_spans(F.col("text")), lambda s: F.struct(s.alias("spans"))).alias("f"))
    entities = F.array_distinct(F.transform("f.spans", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    terms = F.array_distinct(F.transform(F.regexp_extract_all(visible(F.col("text"), F.col("f.spans")), F.lit(_TERM), F.lit(0)), F.lower))
    return staged(found.select("doc_id", F.monotonically_increasing_id().alias("row"), "text_hash", "f.spans", entities.alias("entities"), terms.alias("terms")), "base-spans")


def _lower_bound(k: Column, s: Column) -> Column:
    """Least share that ``k`` of ``s`` speaks for, at the confidence (Wilson)."""
    z2 = CONFIDENCE**2
    return (k + z2 / 2 - CONFIDENCE * F.sqrt(k * (s - k) / s + z2 / 4)) / (s + z2)


def _discloses(k: Column, s: Column, n: Column, disclosure: float) -> Column:
    """Whether ``k`` of ``s`` texts give enough of the entity's information away, without logarithms."""
    return (n < POPULATION) & (_lower_bound(k, s) >= F.pow(n / POPULATION, F.lit(1 - disclosure)))


def _chance(k: Column, s: Column, rate: Column) -> Column:
    """-ln of (an upper bound of) the chance that ``k`` or more of ``s`` hold what each holds at ``rate``, given that two do."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / y)).otherwise(0.0)

    chernoff = s * (part(k / s, rate) + part(1 - k / s, 1 - rate))
    twice = F.ln(-F.expm1(s * F.log1p(-rate)) - s * rate * F.pow(1 - rate, s - 1))
    return F.when((rate >= 1) | (k <= s * rate) | (k <= 2), 0.0).otherwise(F.greatest(F.lit(0.0), chernoff + twice))


def _significant(pairs: DataFrame, tests: int, total: int, false_share: float) -> DataFrame:
    """Those of the staged ``pairs`` (n, s, k and others) that meet more often than by chance; the other ``tests`` surely don't."""
    rate = F.greatest(F.col("n") / total, F.lit(BASE_RATE))
    step = F.least(F.floor(_chance(F.col("k"), F.col("s"), rate) * CHANCE_STEPS), F.lit(CHANCE_STEPS * CHANCE_MOST))
    tested = pairs.withColumn("step", step)
    counts = {r["step"]: r["count"] for r in tested.groupBy("step").count().collect()}  # CHANCE_STEPS * CHANCE_MOST rows at most
    passed, least = 0, None
    for at in sorted(counts, reverse=True):
        passed += counts[at]
        if -at / CHANCE_STEPS <= log(false_share * passed / tests):
            least = at
    return tested.where(F.col("step") >= least).drop("step") if least is not None else tested.where(F.lit(False)).drop("step")


def disclosing_terms(docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE, false_share: float = FALSE_SHARE) -> DataFrame:
    """(entity, term, label) for the terms that disclose an entity; label: what they are generalised to, '' where they are removed. Counts over all different texts; staged."""
    with scratch(docs.sparkSession) as scope:
        total = found.select("text_hash").distinct().count()
        texts = found.where(F.size("entities") > 0).select("text_hash", "entities", "terms").dropDuplicates(["text_hash"])
        texts = staged(texts, "entity-texts")  # the only ones whose terms can meet an entity
        places = texts.select("text_hash", F.explode("entities").alias("entity"))
        entities = staged(places.groupBy("entity").agg(F.count("*").alias("n")).where("n > 2"), "entities")  # fewer texts say nothing of chance
        places = staged(places.join(sent_if_small(entities, F.octet_length("entity")), "entity"), "entity-places")
        rows = staged(places.groupBy("text_hash").agg(F.count("*").alias("width")), "entity-rows")
        texts_of, texts = texts, texts.join(sent_if_small(rows, 24), "text_hash").select("text_hash", "terms", "width")
        pairs = _met(places, texts).groupBy("entity", "term", "n").agg(F.count("*").alias("k"))
        pairs = staged(pairs.where("k > 1"), "pairs")
        tests = pairs.count()
        often = staged(pairs.where("k > 2").select("term").distinct(), "often-terms")
        least = texts_of.select(F.explode("terms").alias("term")).join(sent_if_small(often, F.octet_length("term")), "term", "left_semi")
        least = staged(least.groupBy("term").agg(F.count("*").alias("least")), "least-counts")
        pairs = pairs.where("k > 2").join(sent_if_small(least, F.octet_length("term")), "term")  # s is this at least
        pairs = staged(pairs.where(_discloses(F.col("k"), F.col("least"), F.col("n"), disclosure)).drop("least"), "near-pairs")
        near = staged(pairs.select("term").distinct(), "near-terms")
        seen = found.select("text_hash", F.explode("terms").alias("term")).join(sent_if_small(near, F.octet_length("term")), "term", "left_semi")
        seen = staged(seen.distinct().groupBy("term").agg(F.count("*").alias("s")), "term-counts")
        pairs = pairs.join(sent_if_small(seen, F.octet_length("term")), "term").where(_discloses(F.col("k"), F.col("s"), F.col("n"), disclosure))
        told = staged(_significant(staged(pairs, "telling-pairs"), tests, total, false_share).select("entity", "term", "n"), "told")
        return scope.kept(_labelled(told, places, found, disclosure))


def _met(places: DataFrame, texts: DataFrame) -> DataFrame:
    """Every entity of ``places`` (text_hash, entity, n) with every term of its ``texts`` (text_hash, terms, width: its entities); a text with very many of both is dealt out by its terms."""
    parts = F.greatest(F.lit(1), F.ceil(F.size("terms") * F.col("width") / TEXT_PAIRS)).cast("int")
    sizes = staged(texts.select("text_hash", parts.alias("parts")).where("parts > 1"), "wide-texts")
    words = texts.select("text_hash", F.explode("terms").alias("term"))
    if sizes.isEmpty():
        return places.join(words, "text_hash")
    of = sent_if_small(sizes, 24)
    places = places.join(of, "text_hash", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    words = words.join(of, "text_hash", "left").withColumn("part", F.pmod(F.xxhash64("term"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    return places.join(words, ["text_hash", "part"])


def _class(term: Column) -> Column:
    return F.when(term.rlike(r"^\p{N}+$"), "NUMBER").when(term.rlike(r"\p{N}"), "CODE").otherwise("WORD")


def _labelled(told: DataFrame, places: DataFrame, found: DataFrame, disclosure: float) -> DataFrame:
    """``told`` (entity, term, n) with the first label of each term that discloses none of its entities: its class, TERM, or ''; staged."""
    if told.isEmpty():
        return staged(told.select("entity", "term", F.lit("").alias("label")), "disclosed")
    labels = F.concat(F.array_distinct(F.transform("terms", _class)), F.array(F.lit("TERM")))
    classes = found.where(F.size("terms") > 0).select("text_hash", F.explode(labels).alias("label")).distinct()
    classes = staged(classes, "text-classes")
    sizes = classes.groupBy("label").agg(F.count("*").alias("s"))  # four rows
    own = staged(told.select("entity").distinct(), "told-entities")
    held = places.join(sent_if_small(own, F.octet_length("entity")), "entity", "left_semi").join(classes, "text_hash").groupBy("entity", "n", "label").agg(F.count("*").alias("k"))
    open_ = staged(held.join(F.broadcast(sizes), "label").where(_discloses(F.col("k"), F.col("s"), F.col("n"), disclosure)).select("entity", "label"), "telling-classes")
    steps = told.select("entity", "term", F.posexplode(F.array(_class(F.col("term")), F.lit("TERM"))).alias("at", "label"))
    bad = steps.join(sent_if_small(open_, F.octet_length("entity")), ["entity", "label"], "left_semi").groupBy("term").agg(F.collect_set("at").alias("bad"))
    bad = sent_if_small(staged(bad, "given-up-classes"), F.octet_length("term"))
    label = F.when(F.col("bad").isNull() | ~F.array_contains("bad", 0), _class(F.col("term"))).when(~F.array_contains("bad", 1), "TERM").otherwise("")
    return staged(told.select("entity", "term").join(bad, "term", "left").select("entity", "term", label.alias("label")), "disclosed")


def term_spans(docs: DataFrame, found: DataFrame, disclosed: DataFrame) -> DataFrame:
    """text_hash and the spans (start, end, label) of all disclosing terms outside base spans, for every text that holds any; staged."""
    with scratch(docs.sparkSession) as scope:
        telling = staged(disclosed.groupBy("term").agg(F.min("label").alias("label")), "telling")
        places = found.select("text_hash", "row", F.explode("terms").alias("term"))
        hits = places.join(sent_if_small(telling, F.octet_length("term")), "term").groupBy("text_hash", "row").agg(F.map_from_entries(F.collect_list(F.struct("term", "label"))).alias("own"))
        firsts = hits.groupBy("text_hash").agg(F.min("row").alias("row"))
        hits = hits.join(firsts, ["text_hash", "row"]).join(found.select("row", "spans"), "row").select("text_hash", "own", "spans")
        hits = staged(hits, "term-texts")
        sizes = F.size("own") * 64 + F.size("spans") * 64 + F.aggregate(F.map_keys("own"), F.lit(0), lambda n, x: n + F.octet_length(x)) + F.aggregate("spans", F.lit(0), lambda n, x: n + F.octet_length(x["value"]))
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        texts = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text")).join(sent_if_small(hits, sizes), "text_hash").dropDuplicates(["text_hash"])

        def own(p: Column) -> Column:
            spans = F.zip_with(p["m"], p["s"], lambda m, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.try_element_at(F.col("own"), F.lower(m)).alias("label")))
            return F.filter(spans, lambda s: s["label"].isNotNull())

        spans = let(positions(visible(F.col("text"), F.col("spans")), _TERM), own)
        return scope.kept(staged(texts.select("text_hash", spans.alias("terms")), "term-spans"))


def find_private(docs: DataFrame, disclosure: float = DISCLOSURE, false_share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, text_hash, base spans (kind, start, end, value) and spans of disclosing terms (start, end, label) of every text; staged.

    Null texts count as empty; null and repeated keys are kept, each with its
    own text's spans; other columns are ignored; an empty table gives none.
    """
    with scratch(docs.sparkSession) as scope:
        found = find(docs)
        terms = term_spans(docs, found, disclosing_terms(docs, found, disclosure, false_share))
        rows = found.select("doc_id", "text_hash", "spans").join(sent_if_small(terms, F.size("terms") * 64), "text_hash", "left")
        return scope.kept(staged(rows.select("doc_id", "text_hash", "spans", F.coalesce("terms", F.array().cast(_TERM_SPANS)).alias("terms")), "private"))


def render(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, false_share: float = FALSE_SHARE) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind or class in brackets, or by nothing; overlapping spans become one.

    Null texts stay null, all columns are kept; rows with nothing private keep
    their text unchanged.
    """
    private = find_private(docs, disclosure, false_share).where((F.size("spans") > 0) | (F.size("terms") > 0))
    mark = lambda kind: F.concat(F.lit("["), F.upper(kind), F.lit("]"))
    tagged = F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark(s["kind"]).alias("mark"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["label"] == "", "").otherwise(mark(s["label"])).alias("mark"))),
    )
    key, text_hash, spans = (fresh(c, docs.columns) for c in ("p_id", "p_hash", "p_spans"))
    private = private.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.sort_array(tagged).alias(spans))
    private = sent_if_small(staged(private.dropDuplicates([key, text_hash]), "private-texts"), F.size(spans) * 64)
    text = F.col("text").cast("string")
    rows = docs.join(private, F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(text_hash)), "left")

    clean = replaced(text, F.col(spans), lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(s["mark"]))
    return rows.select(*(F.when(F.col(spans).isNotNull(), clean).otherwise(text).alias("text") if c == "text" else F.col(c) for c in docs.columns))
