"""DuckDB SQL of the queries that SQL can express, over the views of the given tables."""

from __future__ import annotations

from strata.llm import jaccard_join, multiset_hash, quality_rules, spelling

SEARCH_SQL = """
with v as (
    select vec_id, min(list_transform(embedding, lambda x: cast(floor(cast(x as double) * 256) as bigint))) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
    group by vec_id
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES_SQL = f"""
with recursive words as (
    select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} as w from documents
), places as (
    select doc_id, w, unnest(range(1, greatest(len(w) - {jaccard_join.WORDS - 1}, 1) + 1)) as i from words where len(w) > 0
), shingles as (
    select distinct doc_id, array_to_string(w[i : i + {jaccard_join.WORDS - 1}], ' ') as s from places
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as common from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * common >= {jaccard_join.PERCENT} * (x.n + y.n - common)
), both_ways as (
    select a, b from links union select b, a from links
), reach as (
    select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a
)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(smallest, d.doc_id)) as component_id
from documents d left join sizes using (doc_id) left join (select a as doc_id, min(b) as smallest from reach group by a) using (doc_id)
"""

_Q = quality_rules
_RULES = " union all ".join(f"select stratum, quality, '{name}' as rule, {part} as part, {whole} as whole from labelled" for name, (part, whole) in _Q.RULES.items())
_REJECTED = " or ".join(f"coalesce(1000 * {part} > cutoffs['{name}'] * {whole}, false)" for name, (part, whole) in _Q.RULES.items())

RULES_SQL = rf"""
with words as (
    select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text, {_WORDS.format("coalesce(text, '')")} as w from documents
), windows as (
    select doc_id, i, array_to_string(w[i : i + {_Q.WINDOW - 1}], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - {_Q.WINDOW - 2})) as i from words where len(w) >= {_Q.WINDOW})
), covered as (
    select doc_id, count(distinct i + k) as n from (
        select doc_id, i, unnest(range({_Q.WINDOW})) as k from (select *, count(*) over (partition by doc_id, s) as times from windows) where times > 1
    ) group by doc_id
), lines as (
    select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from words
), measured as (
    select doc_id, stratum, cast(len(w) as bigint) as n_words,
        cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
        cast(length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) as bigint) as n_capitals,
        cast(len(list_filter(w, lambda x, i: x = w[i + 1])) as bigint) as n_same_next,
        cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
        coalesce(n, 0) as n_repeat_words
    from words join lines using (doc_id) left join covered using (doc_id)
), labelled as (
    select * from measured join (select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id) using (doc_id)
), strata as (
    select distinct stratum from labelled
), over_cutoffs as (
    select stratum, rule, cutoff, pos,
        count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and 1000 * part > cutoff * whole) as good,
        count(*) filter (quality <> 1 and 1000 * part > cutoff * whole) as bad
    from ({_RULES}), (select unnest({list(_Q.CUTOFFS)}) as cutoff, generate_subscripts({list(_Q.CUTOFFS)}, 1) as pos)
    where stratum in (select stratum from strata) group by all
), tested as (
    select *, n > 0 and list_sum(list_transform(range(good + 1), lambda i: exp(lgamma(n + 1) - case when i = 0 then 0 else lgamma(i + 1) end
        - case when i = n then 0 else lgamma(n - i + 1) end + i * ln({_Q.RISK / len(_Q.RULES)!r}) + (n - i) * ln(1 - {_Q.RISK / len(_Q.RULES)!r}))))
        <= {_Q.LEVEL!r} / ((select count(*) from strata) * {len(_Q.RULES)}) as passed
    from over_cutoffs
), certified as (
    select * from (select *, bool_and(passed) over (partition by stratum, rule order by pos) as certain from tested) where certain
), chosen as (
    select stratum, rule, max(cutoff) as cutoff
    from (select *, max(bad) over (partition by stratum, rule) as most from certified) where bad >= {_Q.CATCH!r} * most group by stratum, rule
), by_stratum as (
    select stratum, map_from_entries(list((rule, cutoff))) as cutoffs from chosen group by stratum
), judged as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured left join by_stratum using (stratum)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({_REJECTED}) as kept
from judged
"""

_CLUSTER_DIMS, _CLUSTER_SCALE, _CLUSTERS, _SEED, _ROUNDS = 64, 1024, 8, 3, 10


def _assigned(centroids: str) -> str:
    """Every vector with its nearest centroid (ties: the smaller number) and the squared distance to it."""
    distance = "list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""select row, vec_id, v, j, d from (
        select v.*, c.j, cast({distance} as bigint) as d, row_number() over (partition by row order by {distance}, c.j) as nth from vectors v cross join {centroids} c
    ) where nth = 1"""


def _moved(k: int) -> str:
    """Centroids after round ``k``: floor(sum / count) by component; an empty one stays."""
    return f"""a{k} as materialized ({_assigned(f"c{k}")}), c{k + 1} as materialized (
    select c.j, coalesce(m.c, c.c) as c from c{k} c left join (
        select j, list((s - ((s % n) + n) % n) // n order by i) as c from (
            select j, i, cast(sum(x) as bigint) as s, count(*) as n from (select j, unnest(v) as x, generate_subscripts(v, 1) as i from a{k}) group by j, i
        ) group by j
    ) m using (j))"""


CLUSTERS_SQL = f"""
with vectors as materialized (
    select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * {_CLUSTER_SCALE}) as bigint)) as v from embeddings
    where len(embedding) = {_CLUSTER_DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), c0 as materialized (
    select cast(row_number() over (order by h, v) - 1 as integer) as j, v as c from (select sha256('{_SEED}:' || coalesce(cast(vec_id as varchar), '')) as h, v from vectors) order by h, v limit {_CLUSTERS}
), {", ".join(map(_moved, range(_ROUNDS)))}, last as materialized ({_assigned(f"c{_ROUNDS}")})
select vec_id, j as cluster, d as distance, cast(sum(d) over (partition by j) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
    sha256(array_to_string(c, ',')) as centroid_sha256
from last join c{_ROUNDS} using (j)
"""

_S = spelling
#: crc32 (the zlib polynomial) of a blob's hexadecimal digits, byte by byte from a given state.
_CRC = "xor(list_reduce(list_prepend({seed}, list_transform(range(len({hex}) // 2), lambda i: cast('0x' || substr({hex}, 2 * i + 1, 2) as bigint))), lambda s, b: xor(s >> 8, crc_table[xor(s & 255, b) + 1])), 4294967295)"
_CRC_STEP = "list_reduce(list_prepend(x, range(8)), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"

SPELLING_SQL = rf"""
with recursive runs as (
    select doc_id, translate(r, '{_UPPER}', '{_LOWER}') as r, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as r from documents) group by all
), hashed as (
    select r, n, {_CRC.format(seed=4294967295, hex="bytes")} as h
    from (select r, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || r)) as bytes from runs), (select list_transform(range(256), lambda x: {_CRC_STEP}) as crc_table)
), words as materialized (
    select word, cast(sum(n) as bigint) as n
    from (select n, case when h % {_S.ALTERED} = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end as word from hashed)
    where length(word) >= {_S.LEAST_LENGTH} group by word having sum(n) >= {_S.LEAST_COUNT}
), less as materialized (
    select distinct word, length(word) as size, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as materialized (
    select a.word, b.word as other from less a join less b on a.rest = b.rest and a.i = b.i and a.size = b.size and a.word <> b.word
    union select word, rest from less semi join words w on less.rest = w.word
    union select rest, word from less semi join words w on less.rest = w.word
), best as (
    select near.word, count(*) as n_near, max(n) as top, min_by(other, (-n, other)) as form from near join words o on near.other = o.word group by near.word
), forms as materialized (
    select word, n, coalesce(n_near, 0) as n_near, case when top >= {_S.FORM_TIMES} * n then form end as form, case when top >= {_S.FORM_TIMES} * n then top end as form_n
    from words left join best using (word)
), paths as (
    select word, word as root, form as next from forms
    union all select p.word, f.word, f.form from paths p join forms f on p.next = f.word
)
select f.word, f.form, p.root, f.n, f.n_near, f.form_n from forms f join paths p on p.word = f.word and p.next is null
"""

_M = multiset_hash
_LANES = "[" + ", ".join(f"(((v + {_M._HALF * _M._ONES}) >> {_M.LANE_BITS * k}) & {2 * _M._HALF - 1}) - {_M._HALF}" for k in range(_M.LANES)) + "]"


def _likeness(other: str, name: str) -> str:
    return f"""{name} as (
    select doc_id, case when bool_and(a = b) then 1.0 else coalesce(greatest(0.0, 1 - cast(sum(d) filter (n > 0 and n <= {_M.HEAVY} * middle) as double) / sum(n) filter (n > 0 and n <= {_M.HEAVY} * middle)), 0.0) end as {name}
    from (select *, list_sort(list(n) filter (n > 0) over (partition by doc_id))[(count(*) filter (n > 0) over (partition by doc_id) + 1) // 2] as middle from (
        select x.doc_id, x.pos, x.v as a, y.v as b, case when x.pos between 1 and {_M.SKETCH} then list_sum(list_transform(list_zip(x.lanes, y.lanes), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) else 0 end as d,
            case when x.pos between 1 and {_M.SKETCH} then list_sum(list_transform(list_zip(x.lanes, y.lanes), lambda p: p[1] * p[1] + p[2] * p[2])) else 0 end as n
        from lanes x join {other} where x.kind = 0 and x.pos = y.pos
    )) group by doc_id)"""


MULTISET_SQL = rf"""
with docs as materialized (
    select doc_id, text, length(text) as n, coalesce(lead(doc_id) over (order by doc_id), first(doc_id) over (order by doc_id)) as next_id
    from (select doc_id, coalesce(text, '') as text from documents)
), texts as materialized (
    select doc_id, 0 as kind, text from docs
    union all select d.doc_id, 1, substr(d.text, 1, d.n - d.n // 4) || substr(e.text, 1, d.n // 4) from docs d join docs e on e.doc_id = d.next_id
), parts as materialized (
    select doc_id, kind, generate_subscripts(ps, 1) as nth, unnest(ps) as p from (select doc_id, kind, list_filter(string_split(text, chr(10)), lambda x: x <> '') as ps from texts)
), features as materialized (
    select doc_id, kind, h from (
        select distinct doc_id, kind, nth, cast('0x' || substr(md5(coalesce(w[i - 1], '') || ' ' || w[i]), 1, {_M.DIGITS}) as bigint) as h
        from (select *, unnest(range(1, len(w) + 1)) as i from (select doc_id, kind, nth, regexp_extract_all(p, '[^\x20\x09-\x0D]{{1,{_M.PIECE}}}') as w from parts))
    )
), numbers as (
    select doc_id, kind, 0 as pos, count(*) as s from features group by all
    union all select doc_id, kind, 1 + (h >> {_M.BITS - _M.LANE_BITS + 1}) % {_M.SKETCH}, sum(2 * (h & {_M._ONES}) - {_M._ONES}) from features group by all
    union all select doc_id, kind, {1 + _M.SKETCH} + 4 * k + i, sum(cast('0x' || substr(sha256(k || ':' || p), 1 + i * {_M.DIGITS}, {_M.DIGITS}) as bigint))
        from parts, (select unnest(range(2)) as k), (select unnest(range({_M.EQUAL // 2})) as i) group by all
), lanes as materialized (
    select doc_id, kind, pos, v, {_LANES} as lanes from (
        select t.doc_id, t.kind, p.pos, cast(coalesce(((s % {1 << _M.BITS}) + {1 << _M.BITS}) % {1 << _M.BITS}, 0) as bigint) as v
        from texts t cross join (select unnest(range({_M.WORDS})) as pos) p left join numbers m on m.doc_id = t.doc_id and m.kind = t.kind and m.pos = p.pos
    )
), rendered as (
    select doc_id, kind, string_agg(lpad(lower(to_hex(v)), {_M.DIGITS}, '0'), '' order by pos) as f from lanes group by all
), {_likeness("lanes y on y.doc_id = x.doc_id and y.kind = 1", "near_edited")}, {_likeness("docs s on s.doc_id = x.doc_id join lanes y on y.doc_id = s.next_id and y.kind = 0", "near_next")}
select d.doc_id, d.n as n_chars, sha256(t.text) as edited_sha256, a.f as fingerprint, b.f as edited_fingerprint, near_edited, near_next
from docs d join texts t on t.doc_id = d.doc_id and t.kind = 1 join rendered a on a.doc_id = d.doc_id and a.kind = 0 join rendered b on b.doc_id = d.doc_id and b.kind = 1
join near_edited e on e.doc_id = d.doc_id join near_next f on f.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_impact_search": SEARCH_SQL, "op4_risk_rules": RULES_SQL, "op9_adaptive_prefixes": NEAR_DUPLICATES_SQL,
            "op11_sphere_clusters": CLUSTERS_SQL, "op12_spelling_variants": SPELLING_SQL, "op13_multiset_hash": MULTISET_SQL}
