import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import multiset_hash as m

MASK = (1 << m.BITS) - 1


def vector(parts):
    out, n = [0] * m.WORDS, 0
    for p in parts:
        words = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % m.PIECE, p)
        for h in {int(hashlib.md5(f"{a} {b}".encode()).hexdigest()[:15], 16) for a, b in zip(["", *words], words)}:
            n += 1
            out[1 + (h >> 46) % m.SKETCH] += 2 * (h & m._ONES) - m._ONES
        for k in range(2):
            digits = hashlib.sha256(f"{k}:{p}".encode()).hexdigest()
            for i in range(4):
                out[1 + m.SKETCH + 4 * k + i] += int(digits[15 * i : 15 * i + 15], 16)
    return [n, *(x & MASK for x in out[1:])]


def of(text):
    return vector([p for p in text.split("\n") if p])


def rendered(v):
    return "".join(f"{x:015x}" for x in v)


def lanes(v):
    raised = v + m._HALF * m._ONES
    return [((raised >> (15 * k)) & 32767) - 16384 for k in range(4)]


def likeness(a, b):
    if a == b:
        return 1.0
    parts = []
    for x, y in zip(a[1 : 1 + m.SKETCH], b[1 : 1 + m.SKETCH]):
        pairs = list(zip(lanes(x), lanes(y)))
        parts.append((sum((p - q) ** 2 for p, q in pairs), sum(p * p + q * q for p, q in pairs)))
    parts = [p for p in parts if p[1]]
    if not parts:
        return 0.0
    middle = sorted(p[1] for p in parts)[(len(parts) - 1) // 2]
    parts = [p for p in parts if p[1] <= m.HEAVY * middle]
    return max(0.0, 1 - sum(p[0] for p in parts) / sum(p[1] for p in parts))


def brute(rows):
    """``rows``: (doc_id, text) in document order."""
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        c = len(text) // 4
        edited = text[: len(text) - c] + after[:c]
        a, b = of(text), of(edited)
        out.append((repr(key), len(text), hashlib.sha256(edited.encode()).hexdigest(), rendered(a), rendered(b), likeness(a, b), likeness(a, of(after))))
    return sorted(out)


def got(df):
    return sorted((repr(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect())


def some_texts(seed, n):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdé日😀") for _ in range(pick.choice([1, 3, 6, 60])))
    return [(k, "".join(word() + pick.choice(["\n", " ", "  ", "\t", "\n\n"]) for _ in range(pick.randint(0, 40)))) for k in range(n)]


def test_same_as_brute_force(spark):
    rows = some_texts(1, 150)
    shuffled = random.Random(2).sample(rows, len(rows))
    df = spark.createDataFrame([(*r, True, 1, 2) for r in shuffled], "doc_id long, text string, after boolean, range int, u long")
    assert got(m.fingerprint_edits(df.repartition(7))) == brute(rows)


def test_few_rows(spark, no_docs):
    assert m.fingerprint_edits(no_docs).count() == 0
    for rows in ([(3, "one two three four\nfive")], [(1, None), (2, "")], [(None, "a b"), (4, None)]):
        assert got(m.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_edge_rows(edge_docs, edge_rows):
    rows = got(m.fingerprint_edits(edge_docs))
    assert len(rows) == len(edge_rows)
    assert sorted((r[0], r[1], r[3]) for r in rows) == sorted((repr(k), len(t or ""), rendered(of(t or ""))) for k, t, *_ in edge_rows)


def test_repeated_keys_and_rows_spread_and_follow_each_other(spark):
    rows = [(5, "same text here\nand there")] * 300 + [(5, f"other text {k}") for k in range(100)] + [(k, f"text of {k}") for k in range(6, 90)] + [(None, None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    followed = m.with_next(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("h")), "doc_id")
    nexts = {}
    for r in followed.collect():
        nexts.setdefault((r.doc_id, r.text), []).append(r.next_text)
    assert sum(map(len, nexts.values())) == len(rows)
    assert nexts[5, rows[0][1]].count(rows[0][1]) == 299 and nexts[None, ""].count("") == 39
    chain = [(k, f"text of {k}") for k in range(6, 90)]
    assert [nexts[x] for x in chain] == [[t] for _, t in chain[1:]] + [[""]]


def test_paragraphs_in_any_order_and_edits_without_the_rest(spark):
    parts = ["first line of all", "second one", "second one", "third", "  "]
    df = spark.createDataFrame([("\n".join(parts), "\n\n".join(reversed(parts)), "\n".join([parts[0], *parts[2:], "new words"]))], "a string, b string, c string")
    a, b, c = (m.fingerprint(F.col(x)) for x in "abc")
    one = lambda t: F.array(F.lit(t))
    r = df.select(a.alias("a"), b.alias("b"), c.alias("c"), m.inserted(m.deleted(a, one("second one")), one("new words")).alias("edited"), m.likeness(a, c).alias("near")).first()
    assert r.a == r.b == of("\n".join(parts)) and r.c == r.edited != r.a and 0 < r.near < 1


def test_likeness_follows_what_texts_share(spark):
    pick = random.Random(7)
    words = [f"w{pick.randrange(10**6)}" for _ in range(4000)]
    text = lambda ws: "\n".join(" ".join(ws[k : k + 20]) for k in range(0, len(ws), 20))
    rows = [(text(words[:2000]), text(words[k : 2000 + k]), 1 - k / 2000) for k in (0, 200, 500, 1000, 2000)]
    df = spark.createDataFrame(rows, "x string, y string, share double")
    for r in df.select(m.likeness(m.fingerprint(F.col("x")), m.fingerprint(F.col("y"))).alias("near"), "share").collect():
        assert abs(r.near - r.share) < 0.3
