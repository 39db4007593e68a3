"""DuckDB SQL for the registered queries that SQL can express.

Not here: bytes' windows (op3) and 64-bit hashes (op5) are too slow or absent in SQL, tokenizers
(op4, op8), trained models (op7, op10) and the cheapest edits (op12) can't be expressed. These have brute-force tests.
"""

from __future__ import annotations

from linkloom.llm.licenses import LEAST_DICE, TEMPLATES, template_bigrams
from linkloom.llm.phrases import LEAST, SHARE, TOP
from linkloom.llm.quality import BUCKETS, LEAST_RATE, LEAST_WORDS, MOST_REPEATED, PSEUDO, WINDOW
from linkloom.llm.sharding import BASE, CHUNKS, Tree, standard_tree

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _draw(prefix: str, weight: float) -> str:
    return f"-ln((cast(('0x' || substr(md5('{prefix}:' || k), 1, 13)) as bigint) + 1) / (pow(2, 52) + 1)) / {weight}"


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def _descend(node: Tree | dict, prefix: str = "") -> str:
    below = [(_descend(v, f"{prefix}/{k}") if isinstance(v, dict) else str(k), _draw(f"{prefix}/{k}", _weight(v))) for k, v in node.items()]
    if len(below) == 1:
        return below[0][0]
    draws = [d for _, d in below]
    cases = " ".join(f"when {d} = least({', '.join(draws)}) then {shard}" for shard, d in below)
    return f"(case {cases} end)"


def _crc_table() -> list[int]:
    made = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        made.append(c)
    return made


_SHARDS = f"""
with keyed as (
  select doc_id, coalesce(cast(doc_id as varchar), '') as k, octet_length(encode(coalesce(text, ''))) + 1 as size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: cast('0x' || x as bigint)) as bytes,
    cast({_crc_table()} as bigint[]) as crcs
  from documents
),
summed as (
  select doc_id, k, size, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, b:
    xor(c >> 8, list_extract(crcs, cast(xor(c, b) & 255 as bigint) + 1)))) as text_crc32
  from keyed
),
placed as (
  select *, {_descend(standard_tree(BASE))} as shard, {_descend(standard_tree(BASE + 1))} as grown_shard,
    cast('0x' || substr(md5('slot:' || k), 1, 8) as bigint) % {CHUNKS} as chunk
  from summed
)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'key' as law, cast(shard as int) as shard,
  cast(row_number() over (partition by shard order by chunk, doc_id nulls first, text_crc32, size) - 1 as bigint) as slot,
  cast(grown_shard as int) as grown_shard
from placed
"""

_QUALITY = f"""
with worded as (select doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
each as (select doc_id, unnest(words) as w, unnest(generate_series(1, len(words))) as i from worded),
hashed as (
  select *, cast('0x' || substr(md5(w), 1, 8) as bigint) as h from each
),
grams as (
  select doc_id, h % {BUCKETS} as b from hashed
  union all
  select doc_id, (h * 31 + next) % {BUCKETS} from (select doc_id, h, lead(h) over (partition by doc_id order by i) as next from hashed) where next is not null
),
counted as (
  select b, count(*) as raw, count(*) filter (doc_id in (select doc_id from labels where quality = 1)) as target from grams group by b
),
shared as (select sum(target) / sum(raw) as share from counted),
ratios as (
  select b, case when share > 0 then ln((target / share + {PSEUDO}) / (raw + {PSEUDO})) else 0 end as ratio from counted, shared
),
rates as (select doc_id, avg(ratio) as rate from grams join ratios using (b) group by doc_id),
windows as (
  select doc_id, i, array_to_string([w, {', '.join(f"lead(w, {k}) over ahead" for k in range(1, WINDOW))}], ' ') as window_text,
    lead(w, {WINDOW - 1}) over ahead as last
  from each window ahead as (partition by doc_id order by i)
),
twice as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, window_text) as n from windows where last is not null) where n > 1
),
repeats as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest(range({WINDOW})) as k) group by doc_id
),
lines as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from worded) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
),
base as (
  select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, coalesce(rate, 0) as rate
  from worded left join lines using (doc_id) left join repeats using (doc_id) left join rates using (doc_id)
)
select * exclude (rate), n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed,
  not (n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words) and rate >= {LEAST_RATE} as kept
from base
"""


def _templates() -> str:
    rows = (f"({i}, '{name}', {[f'{a} {b}' for a, b in template_bigrams(text)]})" for i, (name, text) in enumerate(TEMPLATES))
    return f"(values {', '.join(rows)}) t(i, name, pairs)"


_LICENSES = f"""
with plain as (
  select doc_id, row_number() over () as r,
    regexp_replace(regexp_replace(lower(coalesce(text, '')), '[.!?]+(\\s|$)', chr(9) || '\\1', 'g'), '[^a-z0-9\\n\\t]+', ' ', 'g') as body
  from documents
),
units as (
  select r, 1 as o, 'sentence' as kind, unnest(regexp_split_to_array(body, '[\\t\\n]+')) as u from plain
  union all select r, 2, 'line', u from (select r, unnest(string_split(body, chr(10))) as u from plain) where regexp_matches(u, '\\t *[a-z0-9]')
  union all select r, 3, 'paragraph', u
    from (select r, unnest(regexp_split_to_array(body, '\\n\\s*\\n')) as u from plain where regexp_matches(body, '\\n\\s*\\n')) where contains(u, chr(10))
  union all select r, 4, 'text', body from plain where contains(body, chr(10))
),
split as (select r, o, kind, row_number() over () as id, regexp_extract_all(u, '[a-z0-9]+') as w from units),
paired as (
  select r, o, kind, id, list_distinct(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) as pairs from split where len(w) > 1
),
rated as (
  select r, o, kind, id, name, len(t.pairs) as size, 2.0::double * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + len(t.pairs)) as dice
  from paired p, {_templates()} where len(p.pairs) between len(t.pairs) * 0.6 and len(t.pairs) * 1.6
),
best as (
  select * from rated where dice >= {LEAST_DICE} qualify row_number() over (partition by id order by dice desc, name) = 1
),
summed as (
  select r, cast(count(*) as int) as n_matches, array_to_string(list_sort(list_distinct(list(name))), ',') as licenses from best group by r
),
first as (select * from best qualify row_number() over (partition by r order by dice desc, name, o, id) = 1)
select doc_id, f.name as license, coalesce(f.dice, 0.0::double) as dice, f.kind as unit, cast(f.size as int) as template_size,
  coalesce(n_matches, 0) as n_matches, coalesce(licenses, '') as licenses
from plain left join first f using (r) left join summed using (r)
"""

_LINKS = """
with recursive given as (select vec_id, embedding::double[] as e from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from given a join given b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95
),
reach(a, b) as (select vec_id, vec_id from given union select r.a, l.b from reach r join links l on r.b = l.a),
least_id as (select a, min(b) as component_id from reach group by a)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
from given join least_id on a = vec_id left join (select a as vec_id, count(*) as n from links group by a) using (vec_id)
"""

_EXACT = r"""
with plain as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id is not distinct from min(doc_id) over same as kept, sha256(body) as text_sha256
from plain window same as (partition by body)
"""

_PHRASES = rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents
),
pieces as (
  select r, lang, unnest(list) as piece, generate_subscripts(list, 1) as p
  from (select r, lang, string_split_regex(body, '[.,;:!?\x0A-\x0D]') as list from docs)
),
words as (
  select r, lang, p, unnest(list) as w, generate_subscripts(list, 1) as i
  from (select r, lang, p, regexp_extract_all(piece, '[^\x20\x09]+') as list from pieces)
),
near as materialized (
  select lang, w, lead(w) over here as w2, lead(w, 2) over here as w3 from words window here as (partition by r, p order by i)
),
f as materialized (
  select lang, 1 as size, w as phrase, count(*) as n from near group by all
  union all select lang, 2, w || ' ' || w2, count(*) from near where w2 is not null group by all
  union all select lang, 3, w || ' ' || w2 || ' ' || w3, count(*) from near where w3 is not null group by all
),
candidates as materialized (select lang, size, phrase, n as a, string_split(phrase, ' ') as ws from f where size > 1 and n >= {LEAST}),
ks as (select *, unnest(generate_series(1, size - 1)) as k from candidates),
cuts as materialized (select *, array_to_string(ws[1:k], ' ') as lp, array_to_string(ws[k + 1:], ' ') as rp from ks),
scored as (
  select c.lang, c.size, c.phrase, c.a, k, x.n as l, y.n as r,
    cast(c.a as hugeint) * c.a * 1000000 // (cast(x.n as hugeint) * y.n) as score
  from cuts c
  join f x on x.lang = c.lang and x.phrase = c.lp
  join f y on y.lang = c.lang and y.phrase = c.rp
),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as materialized (
  select lang, phrase, max(a) as a from (
    select lang, array_to_string(ws[1:2], ' ') as phrase, a from candidates where size = 3
    union all select lang, array_to_string(ws[2:3], ' '), a from candidates where size = 3
  ) group by all
),
kept as (
  select b.* from best b left join around o using (lang, phrase)
  where b.size = 3 or o.a is null or 100 * o.a < {SHARE} * b.a
),
totals as (select lang, cast(sum(n) as bigint) as n from f where size = 1 group by all)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, t.n as n,
  cast(score as bigint) as score
from kept join totals t using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= {TOP}
"""

ORACLES: dict[str, str] = {
    "op1_embedding_neardup": _LINKS,
    "op2_sharding": _SHARDS,
    "op6_license_scan": _LICENSES,
    "op9_quality": _QUALITY,
    "op11_phrases": _PHRASES,
    "op13_exact_dedup": _EXACT,
}
