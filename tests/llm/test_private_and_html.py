import hashlib
import math
import random
import re
from collections import Counter

from strata.llm import registry
from strata.llm.html_main import best_container, extract_main_text, host_of, parse, text_of
from strata.llm.pii import disclosing_terms, find, find_private, sanitise

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or 0) <= 255 for p in match.split("."))
    return {"email": True, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def found(df):
    return sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in find_private(df).collect()), key=str)


def test_base_spans_of_edge_rows(edge_docs, edge_rows, no_docs):
    assert found(edge_docs) == sorted(((r[0], base(r[1])) for r in edge_rows), key=str)
    assert find_private(no_docs).count() == 0 and sanitise(no_docs).count() == 0


def test_base_spans_of_awkward_texts(spark):
    texts = [
        "a@b.c@d.e x@y a@b..c a@b.c.", "_%+-@a-b.c-d.e", "é😀 a@b.co 1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111-4111111111111111",
        "4111111111111111 4111  1111 1111 1111", "4111111111111111 and 4222222222222", "+1 (202) 555-0199, +12 and +1-2-3-4-5-6-7-8-9-0 +", "+49 30 1234 5678 90 12 34 56 78", "1" * 5000 + ".2.3.4",
        "mail a.b@c.de,f@g.hi;+1 234 567 8901" * 300, "", "@.@", "9" * 16 + " " + "0" * 16,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(df) == sorted(((i, base(t)) for i, t in enumerate(texts)), key=str)


def test_query_digest(spark):
    rows = {r.doc_id: r for r in registry.op5_disclosure(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in base(d.text))
        r = rows[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and (r.spans == spans or r.spans.startswith(spans))
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in base(d.text)) for k in PATTERNS]


def test_a_term_that_gives_an_entity_away_is_generalised(spark):
    filler = [(i, " ".join(f"common{(i * 7 + j) % 40} thing{(i + j) % 23}" for j in range(30))) for i in range(60)]
    telling = [(100 + i, f"note{i} word{i} from Kowalczyk writes common{i} bob@corp.example says thing{i} extra{i}") for i in range(5)]
    other = [(200 + i, f"common{i} thing{i} some{i} ann@corp.example common{i + 3} thing{i + 5}") for i in range(5)]
    copies = [(300 + i, "Unusual phrase near eve@corp.example in a copied passage") for i in range(9)]
    df = spark.createDataFrame(filler + telling + other + copies, "doc_id long, text string")
    terms = {(r.entity, r.term) for r in disclosing_terms(df, find(df)).collect()}
    assert ("email:bob@corp.example", "kowalczyk") in terms
    assert not any(t.startswith(("common", "thing")) for _, t in terms) and not any(e == "email:eve@corp.example" for e, _ in terms)
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert "Kowalczyk" not in clean[100] and "[TERM]" in clean[100] and "[EMAIL]" in clean[100]
    assert clean[3] == filler[3][1] and clean[300] == "Unusual phrase near [EMAIL] in a copied passage"


def test_a_disclosing_term_goes_wherever_it_stands(spark):
    filler = [(i, " ".join(f"common{(i * 7 + j) % 40} thing{(i + j) % 23}" for j in range(30))) for i in range(400)]
    telling = [(1000 + i, f"from Kowalczyk writes common{i} bob@corp.example says thing{i}") for i in range(12)]
    far = [(2000, "common thing " * 20 + "KOWALCZYK, thing"), (2001, "Kowalczyk says " + "common thing " * 20 + "bob@corp.example"), (2002, None), (None, "kowalczyk common"), (None, "kowalczyk common")]
    clean = [(r.doc_id, r.text) for r in sanitise(spark.createDataFrame(filler + telling + far, "doc_id long, text string")).collect()]
    texts = dict(clean)
    assert len(clean) == len(filler + telling + far) and not any("kowalczyk" in (t or "").lower() for _, t in clean)
    assert texts[2000] == "common thing " * 20 + "[TERM], thing" and texts[2001].startswith("[TERM] ") and texts[2001].endswith("[EMAIL]")
    assert texts[None] == "[TERM] common" and texts[2002] is None and texts[3] == filler[3][1]


def brute_disclosed(texts, disclosure=0.9, false_share=0.05):
    """(entity, term) by the stated rules, over all pairs of different ``texts``."""
    texts = sorted({t or "" for t in texts})
    held, terms = [], []
    for t in texts:
        spans = base(t)
        held.append({f"{k}:{t[a:b].lower()}" for k, a, b in spans})
        chars = list(t)
        for _, a, b in spans:
            chars[a:b] = " " * (b - a)
        terms.append(set(re.findall(r"[^\W_]+", "".join(chars).lower())))
    n, s, k = Counter(e for x in held for e in x), Counter(w for x in terms for w in x), Counter((e, w) for x, y in zip(held, terms) for e in x for w in y)
    pairs = {(e, w): (n[e], s[w], c) for (e, w), c in k.items() if n[e] > 2 and c > 1}

    def chance(n, s, k):
        rate = max(n / len(texts), 0.01)
        if rate >= 1 or k <= s * rate or k <= 2:
            return 0
        part = lambda x, y: x * math.log(x / y) if x else 0
        return math.floor(min(700, max(0, s * (part(k / s, rate) + part(1 - k / s, 1 - rate)) + math.log(-math.expm1(s * math.log1p(-rate)) - s * rate * (1 - rate) ** (s - 1)))) * 16)

    z = 1.645

    def low(k, s):
        return (k + z * z / 2 - z * math.sqrt(k * (s - k) / s + z * z / 4)) / (s + z * z)

    told = {p: chance(*x) for p, x in pairs.items() if x[2] > 2 and low(x[2], x[1]) >= (x[0] / 1e6) ** (1 - disclosure)}
    least = min((x for x in set(told.values()) if -x / 16 <= math.log(false_share * sum(y >= x for y in told.values()) / len(pairs))), default=None)
    return {p for p, x in told.items() if least is not None and x >= least}


def disclosed(df):
    return {(r.entity, r.term) for r in disclosing_terms(df, find(df)).collect()}


def corpus(seed, n=400):
    """Texts with recurring entities, words that go with some of them, and words that occur once."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{pick.randrange(150)}" for _ in range(12)] + [f"once{i}"]
        if i % 9 == 0:
            e = pick.randrange(6)
            words += [f"user{e}@corp.example"] + [f"tell{e}{c}" for c in "abc" if pick.random() < 0.7] + ([f"10.0.0.{e % 3}"] if i % 2 else [])
        elif i % 31 == 0:
            words += [f"tell{pick.randrange(6)}a"]
        pick.shuffle(words)
        out.append((i, " ".join(words)))
    return out


def test_disclosure_against_brute_force_over_a_corpus(spark):
    rows = corpus(1)
    want = brute_disclosed([t for _, t in rows])
    assert len(want) > 5 and any(w.startswith("tell") for _, w in want)
    assert disclosed(spark.createDataFrame(rows + rows[:50], "doc_id long, text string")) == want


def test_a_term_met_once_says_nothing_and_unrelated_texts_change_no_verdict(spark):
    filler = [(i, " ".join(f"common{(i * 7 + j) % 40} thing{(i + j) % 23}" for j in range(30))) for i in range(1500)]
    once = [(2000, "common1 Li has badge 4711 and key ab12cd " + "thing1 common2 " * 30 + "once@corp.example")]
    often = [(2001 + i, f"Zork common{i} met{i} " + "thing2 common3 " * 30 + "1.2.3.4") for i in range(8)]
    alone = [(3000, "badge of Zork and thing1")]
    rows = filler + once * 3 + often + alone
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = disclosed(df)
    assert terms == {("ip:1.2.3.4", "zork")} == brute_disclosed([t for _, t in rows])
    unrelated = [(5000 + i, f"other{i % 50} words{i % 70} of{i} nothing") for i in range(4000)]
    assert disclosed(df.union(spark.createDataFrame(unrelated, "doc_id long, text string"))) == terms
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert clean[3000] == "badge of [TERM] and thing1"  # only these texts have plain words
    assert clean[2000] == once[0][1].replace("once@corp.example", "[EMAIL]") and clean[5] == filler[5][1]


def test_a_text_of_very_many_entities_is_dealt_out(spark, monkeypatch):
    from strata.llm import pii

    rows = corpus(2) + [(9000, " ".join(f"user{e}@corp.example tell{e}a w{e}" for e in range(6))), (9001, " ".join(f"user{e}@corp.example w{e}" for e in range(6)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = disclosed(df)
    monkeypatch.setattr(pii, "TEXT_PAIRS", 4)
    assert disclosed(df) == want == brute_disclosed([t for _, t in rows])


def test_classes_that_give_an_entity_away_are_given_up(spark):
    filler = [(i, f"plain{'abcdefgh'[i % 8]} words only here {'xyz'[i % 3]}") for i in range(300)]
    telling = [(1000 + i, f"code 77x{chr(97 + i)} and badge 4711 of bob@corp.example") for i in range(10)]
    clean = {r.doc_id: r.text for r in sanitise(spark.createDataFrame(filler + telling, "doc_id long, text string")).collect()}
    assert "4711" not in clean[1000] and "[NUMBER]" not in clean[1000]  # only such texts have numbers
    assert clean[7] == filler[7][1]


def test_sanitise_keeps_columns_rows_and_clean_texts(edge_docs, edge_rows):
    rows = sanitise(edge_docs)
    assert rows.columns == edge_docs.columns
    got = sorted(((r.doc_id, r.text) for r in rows.collect()), key=str)
    assert len(got) == len(edge_rows)
    for key, text in got:
        if not any(k == key and base(t) for k, t, *_ in edge_rows):
            assert (key, text) in [(r[0], r[1]) for r in edge_rows]
    masked = next(t for k, t in got if k == 14)
    assert masked == "mail me: [EMAIL][EMAIL], ip [IP].[IP] or 300.1.1.1; card [CARD], [PHONE]."


def test_main_text_of_all_pages(spark):
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in registry.op7_host_paths(spark, SF).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S)
        raw = re.sub(r"<[^>]*(?:>|\Z)", " ", re.sub(r"</?(?:b|a)>", "", inside[1] if inside else ""))
        assert r.text == " ".join(html.unescape(raw).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_consensus_overrules_an_odd_page(spark):
    page = '<body><div class="nav">menu</div><div class="story-{i}"><h1>Title {i}</h1><p>Body &amp; text {i}, with <b>bo</b>ld words in it.<p>More.</div><div class="extra"><p>{x}</p></div><footer>f</footer></body>'
    rows = [(i, "http://Host.example:80/a", page.format(i=i, x="short"), 1, "p") for i in range(8)] + [(8, "https://host.example/b", page.format(i=8, x="long promo text " * 20), 1, "p")]
    rows += [(9, None, None, 1, "p"), (10, "no host", "<p>lone <i>te</i>xt", 1, "p"), (10, "no host", "<p>lone <i>te</i>xt", 1, "p"), (None, "http://h/", "", 1, "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int, path string")
    got = extract_main_text(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and text[8] == "Title 8 Body & text 8, with bold words in it. More." and text[3].startswith("Title 3")
    assert text[9] == "" and text[10] == "lone text" and text[None] == ""
    assert extract_main_text(df.where("page_id < 0")).count() == 0


def test_parser_survives_broken_markup():
    def main(html):
        root, pieces = parse(html)
        return text_of(best_container(root), pieces)

    assert main("<p>a<b") == "a" and main("x < y &lt; z &copy") == "x < y < z ©"
    assert main("<script>var x='<p>no'") == "" and main("<p title='a>b'>yes</p>") == "yes"
    assert main("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a b c d"
    assert main("<article>t<div class='comments'>bad</div><aside>bad</aside><form>bad</form></article>") == "t"
    assert main('<p "unclosed>text') in ("text", "") and main("<" * 3000 + "a'" * 3000) is not None


def test_names_only_drop_what_is_wholly_named_so():
    def main(html):
        root, pieces = parse(html)
        return text_of(best_container(root), pieces)

    assert main("<body><div id='page' class='has-sidebar'><h1 class='post-header'>T</h1><p class='notice-period'>one</p><h2 id='related'>R</h2><section id='social-effects'>two</section></div></body>") == "T one R two"
    assert main("<main class='no-sidebar'><p id='notice'>text</p><figure><figcaption>cap</figcaption></figure></main>") == "text cap"
    assert main("<body><div class='content sidebar'><p>all of the text</p></div><div class='ad x'>buy</div></body>") == "all of the text"
    assert main("<div class='widget'><article>the article</article><div class='ads'>buy now</div></div><p>x</p>") in ("the article", "the article x")
    assert main("<article>body of it<div class='related'><article>teaser</article></div></article>") == "body of it"
    assert main("<div>short post</div><div class='comments'>a very much longer thread of comments</div>") == "short post"
    assert main("<div class='ad'>" * 300 + "deep" + "</div>" * 300) == "deep"


def test_whole_articles_stay_and_other_templates_keep_their_own(spark):
    long = "many words of a list " * 10
    rows = [(0, "http://a/0", f"<body><div class='nav'>n</div><article><h1>Title</h1><p>Intro.</p><ul><li>{long}</ul><section><p>{long}{long}</p></section><p>End.</article></body>")]
    rows.append((1, "http://b/0", f"<body><main><h1>Title</h1><table><tr><td>{long}{long}</table><p>Rest.</p></main></body>"))
    rows.append((2, "http://c/0", f"<body><h1>Title</h1><p>Intro of some length here.</p><article>{long[:60]}</article><div><p>{long}</p></div></body>"))
    rows += [(10 + i, f"http://d/{i}", f"<body><div class='story'><p>{long}{i}</p></div></body>") for i in range(5)]
    rows += [(20 + i, f"http://d/x{i}", f"<body><div class='story'>By me</div><div class='text'><p>other {long}</p></div></body>") for i in range(2)]
    text = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert text[0].startswith("Title Intro. many words") and text[0].endswith("End.")
    assert text[1].startswith("Title many") and text[1].endswith("Rest.")
    assert text[2].startswith("Title Intro") and text[2].endswith("of a list")
    assert text[10] == f"{long}0" and "other many words" in text[20] and "other many words" in text[21]


def test_hosts(spark):
    urls = ["//u:p@A.b:8/x", None, "no host", "https://Host.example/a//b", "\u00a0 http://h:1", " \thttp://x.y?q", "mailto:a@b"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, url string")
    assert [r.h for r in df.select("i", host_of(df.url).alias("h")).orderBy("i").collect()] == ["a.b", "", "", "host.example", "", "x.y", ""]
