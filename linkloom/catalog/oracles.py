"""The registered queries as SQL over the given tables.

Written apart from the Spark plans: joins are plain joins, offsets are sums over list slices,
templates go by repeated innermost replacement (the derived wikitext nests them evenly), redirect
chains by a recursive query with a depth bound.
"""

from collections.abc import Callable

from linkloom.catalog.inputs import (
    PLAIN_TEXT,
    SITE_TITLE,
    STRAY,
    TITLE,
    WIKI_PAGES,
    WIKITEXT,
    select_list,
)
from linkloom.functions.meta import DISAMBIGUATION_TEMPLATES
from linkloom.functions.predicates import LINK_NAMESPACES, SPECIAL_PREFIXES

BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def _wikilink(x: str) -> str:
    # The engine maps a sharp s to one capital letter, Java and Spark to two.
    return (
        f"replace((case when substr({x}, 1, 1) = 'ß' then 'SS' else upper(substr({x}, 1, 1)) end)"
        f" || substr({x}, 2), '_', ' ')"
    )


def _normalize(x: str) -> str:
    x = _strip(x)
    return (
        f"replace((case when substr({x}, 1, 1) = 'ß' then 'ß' else upper(substr({x}, 1, 1)) end)"
        f" || substr({x}, 2), '_', ' ')"
    )


def _in(x: str, names: list[str]) -> str:
    return f"{x} in ({', '.join(repr(name) for name in names)})"


def _array(x: str) -> str:
    """A list of strings as an array literal."""
    quoted = (
        f"list_transform({x}, lambda e: '\"' || replace(replace(e, chr(92), chr(92) || chr(92)),"
        " '\"', chr(92) || '\"') || '\"')"
    )
    return f"'{{' || coalesce(array_to_string({quoted}, ','), '') || '}}'"


def _int_array(x: str) -> str:
    return f"'{{' || array_to_string({x}, ',') || '}}'"


# Web pages

_ANCHORS = f"""
anchor_lists as (
  select page_id,
    string_split_regex(html, '<a href="/([^"]*)">([^<]*)</a>') as gaps,
    regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1) as hrefs,
    regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2) as texts
  from pages
),
anchor_rows as (
  select page_id, gaps, hrefs, texts, unnest(generate_series(1, len(hrefs))) as i
  from anchor_lists
),
anchors as (
  select page_id, hrefs[i] as href, texts[i] as surface,
    cast(coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
      + coalesce(list_sum(list_transform(hrefs[1:i], lambda h: length(h))), 0)
      + coalesce(list_sum(list_transform(texts[1:i-1], lambda t: length(t))), 0)
      + 12 * i + 4 * (i - 1) as int) as char_start
  from anchor_rows
),
links as (
  select page_id, char_start, cast(char_start + length(surface) as int) as char_end, surface,
    {_wikilink("href")} as title
  from anchors
),
redirects as (
  select distinct title, regexp_replace(title, '[,.]+$', '') as target from links
  where title <> regexp_replace(title, '[,.]+$', '')
),
web_pages as (
  select page_id, {_wikilink(f"regexp_extract(html, '{TITLE}', 1)")} as title, html as content,
    false as disamb
  from pages
),
entities as (
  select title, page_id from web_pages union select string_split(title, ' ')[1], page_id from web_pages
)
"""


def _normalized(links: str, redirects: str, pages: str, key: str = "l.title") -> str:
    return f"""
  select l.page_id, l.char_start, l.char_end, l.surface, coalesce(r.target, l.title) as link,
    coalesce(p.page_id, -1) as link_id
  from {links} l left join {redirects} r on l.title = r.title left join {pages} p on p.title = {key}
"""


_BEHIND = "coalesce(r.target, l.title)"

_COUNTS = """
  select surface, link as title, cast(count(surface) as bigint) as n
  from normalized group by surface, link
"""


def _aggregated(pages: str, categories: str) -> str:
    order = "order by n.char_start, n.char_end, n.link, n.link_id"
    return f"""
  select p.page_id, p.title, p.content, p.disamb, {categories} as categories,
    {_int_array(f"array_agg(n.char_start {order})")} as char_starts,
    {_int_array(f"array_agg(n.char_end {order})")} as char_ends,
    {_array(f"array_agg(n.link {order})")} as links,
    {_int_array(f"array_agg(n.link_id {order})")} as link_ids
  from {pages} p join normalized n on p.page_id = n.page_id
  group by all
"""


# Wikitext

_DUMP = f"dump as (select {', '.join(select_list(WIKITEXT))} from documents)"

_BODY = r"regexp_extract(text, '(?s)\[\[(.*?)\]\]', 1)"
_NAMES = "|".join(
    form for name in DISAMBIGUATION_TEMPLATES for form in (name, name[0].lower() + name[1:])
)
_FIRST_PARTS = (
    "list_filter(list_transform({found}, lambda b: regexp_extract(b, '[^|]+')), lambda p: p <> '')"
)
_CATEGORIES = _FIRST_PARTS.format(
    found=r"regexp_extract_all(coalesce(text, ''), '\[\[Category:(.*?)\]\]', 1)"
)
_RAW_LINKS = (
    "list_filter("
    + _FIRST_PARTS.format(found=r"regexp_extract_all(coalesce(text, ''), '\[\[(.*?)\]\]', 1)")
    + ", lambda t: not contains(t, ':'))"
)

_META = rf"""{_DUMP},
meta as (
  select id, ns, title, text,
    coalesce(upper(substr(text, 1, 9)) = '#REDIRECT' and {_BODY} <> '', false) as is_redirect,
    coalesce(contains(text, '-stub}}}}'), false) as is_stub,
    coalesce(text is not null and (ends_with(title, '(disambiguation)')
      or regexp_matches(text, '[{{][{{]({_NAMES})[|}}]')), false) as disamb,
    {_CATEGORIES} as categories
  from dump
),
page_meta as (
  select *, case when is_redirect then {_wikilink(_BODY)} end as redirect_target from meta
)
"""


def _replaced(x: str, steps: list[tuple[str, str, str]]) -> str:
    for pattern, replacement, flags in steps:
        x = f"regexp_replace({x}, '{pattern}', {replacement}, '{flags}')"
    return x


_PLAIN_STEPS = [
    ("&gt;", "'>'", "g"),
    ("&lt;", "'<'", "g"),
    ("<ref>.*?</ref>", "' '", "g"),
    ("</?.*?>", "' '", "g"),
    (r"\{\{.*?\}\}", "' '", "g"),
    (r"\[\[.*?:.*?\]\]", "' '", "g"),
    (r"\[\[(.*?)\]\]", r"'\1'", "g"),
    (r"\s(.*?)\|(\w+\s)", r"' \2'", "g"),
    (r"\[.*?\]", "' '", "g"),
    ("''+", "''", "g"),
]

_MEDIA = (
    r"\[\[\s*(?:File|Image|Category)\s*:[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]"
)
_HEADING = r"(?m)^=+[ \t]*([^\n]*[^=\s])[ \t]*=+[ \t]*$"
_TEMPLATE = (r"\{\{[^{}]*\}\}", "''", "g")
_RENDER_STEPS = [
    (r"(?s)<!--.*?-->", "''", "g"),
    (r"\|\s*\{\{transl\}\}\s*\]\]", "'|' || chr(3) || ']]'", "g"),
    _TEMPLATE,
    _TEMPLATE,
    _TEMPLATE,
    (r"<ref(?:\s[^>]*)?/>|<ref(?:\s[^>]*)?>.*?</ref\s*>", "''", "gis"),
    (r"\[(?:https?:|ftp:)?//[^\s\[\]]+[ \t]*([^\[\]\n]*)\]", r"'\1'", "g"),
    (_MEDIA, "''", "gi"),
    (r"</?(?:br|hr)(?:\s[^<>]*)?/?>", "chr(10) || chr(10)", "gi"),
    ("</?[a-zA-Z][^<>]*>", "''", "g"),
    (_HEADING, r"'\1'", "g"),
    (r"(?m)^(?:\{\|[^\n]*|\|[-}][^\n]*|[|!])", "''", "g"),
    (r"(?m)^[*#:;]+[ \t]*", "''", "g"),
    (r"''{2,}", "''", "g"),
]


def _entities(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&#233;", "é"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_PREFIX = "string_split(title, ':')[1]"
_SPECIAL = f"(contains(title, ':') and {_in(_PREFIX, SPECIAL_PREFIXES)})"


def _entity_link(x: str) -> str:
    prefix = f"replace(string_split({x}, ':')[1], '_', ' ')"
    return f"(not contains({x}, ':') or not {_in(prefix, LINK_NAMESPACES)})"


_LINK_TITLE = _strip("string_split(string_split(b, '|')[1], '#')[1]")
_SHOWN = _strip("case when strpos(b, '|') > 0 then substr(b, strpos(b, '|') + 1) else b end")



def _extraction(heading: str, wanted: Callable[[str], str]) -> str:
    steps = [(p, heading if p == _HEADING else r, flags) for p, r, flags in _RENDER_STEPS]
    return rf"""{_META},
rendered as (
  select *, {_entities(_replaced(
      f"case when ns = 0 and length(text) > 0 and not is_redirect and not {_SPECIAL} then text "
      "else '''' end".replace("''''", "''"), steps))} as flat
  from page_meta
),
bodies as (
  select *, string_split_regex(flat, '\[\[[^\[\]]+\]\]') as gaps,
    list_transform(regexp_extract_all(flat, '\[\[([^\[\]]+)\]\]', 1),
      lambda b: regexp_replace(b, '^\s*:', '')) as raw
  from rendered
),
parts as (
  select *, list_transform(raw, lambda b: {_LINK_TITLE}) as hrefs,
    list_transform(raw, lambda b: {_SHOWN}) as texts
  from bodies
),
shown as (
  select *, list_transform(texts, lambda t, i:
    case when t = chr(3) then replace(hrefs[i], '_', ' ') else t end) as surfaces
  from parts
),
outs as (
  select *, list_transform(surfaces, lambda s, i:
    case when {wanted(_wikilink("hrefs[i]"))} then ' ' || s || ' ' else s end) as outs
  from shown
),
annotated as (
  select id as page_id, {_wikilink("title")} as title, is_redirect, redirect_target, disamb,
    categories, gaps, hrefs, surfaces, outs,
    array_to_string(list_transform(gaps, lambda g, i: g || coalesce(outs[i], '')), '') as content
  from outs
),
wiki_pages_rel as (
  select page_id, title, content, disamb, {_array("categories")} as categories
  from annotated where not is_redirect
),
link_rows as (
  select *, unnest(generate_series(1, len(outs))) as i from annotated where not is_redirect
),
link_starts as (
  select page_id, hrefs[i] as href, surfaces[i] as surface, i,
    cast(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(outs[1:i-1], lambda o: length(o))), 0) + 1 as int)
      as char_start
  from link_rows
),
wiki_links as (
  select page_id, char_start, cast(char_start + length(surface) as int) as char_end, surface,
    {_wikilink("href")} as title, i
  from link_starts where {wanted(_wikilink("href"))} and {_strip("surface")} <> ''
),
wiki_redirects as (
  select title, redirect_target as target from annotated where is_redirect
)
"""


_EXTRACT = _extraction(r"'\1'", _entity_link)
_NO_HEADINGS = _extraction("''", _entity_link)
_NUMBERED = _extraction(r"'\1'", lambda x: f"regexp_matches({x}, '^Page [0-9]+$')")

_LINK_COLUMNS = "page_id, char_start, char_end, surface, title"


def _first_two(x: str) -> str:
    return _array(f"({x})[1:2]")


_PREVIEW_TEXT = _strip("content")

_WIKI_PAGES = f"{_DUMP}, wiki_pages as (select {', '.join(select_list(WIKI_PAGES))} from dump)"
_TARGETS = rf"""{_WIKI_PAGES},
title_map as (
  select {_normalize("title")} as title, min(id) as id from wiki_pages group by 1
),
targets as (
  select w.id as src, w.target as title, m.id as dst
  from (
    select id, {_normalize(r"regexp_extract(mediawiki, '\[\[([^\]]+)\]\]', 1)")} as target
    from wiki_pages
    where html is null and lower(mediawiki) like '#redirect%'
      and regexp_extract(mediawiki, '\[\[([^\]]+)\]\]', 1) <> ''
  ) w left join title_map m on w.target = m.title
),
edges as (select src, dst from targets where dst is not null)
"""
_PART_EDGES = """
edges as (
  select p_partkey as src,
    case when p_partkey % 100 = 1 then p_partkey + 1 else p_partkey - 1 end as dst
  from part where p_partkey % 20 <> 0
)
"""
_WALK = """
walk(src, dst, depth) as (
  select src, dst, 1 from edges
  union all
  select w.src, e.dst, w.depth + 1 from walk w join edges e on w.dst = e.src where w.depth < 64
),
resolved as (select src, dst from walk where dst not in (select src from edges))
"""
_LOOPING = "select src from edges where src not in (select src from resolved)"

ORACLES = {
    "normalized_links": f"with {_ANCHORS} {_normalized('links', 'redirects', 'entities')}",
    "normalized_links_resolved": (
        f"with {_ANCHORS} {_normalized('links', 'redirects', 'entities', _BEHIND)}"
    ),
    "link_counts": (
        f"with {_ANCHORS}, normalized as ({_normalized('links', 'redirects', 'entities')}) {_COUNTS}"
    ),
    "aggregate_pages": (
        f"with {_ANCHORS}, normalized as ({_normalized('links', 'redirects', 'entities')})"
        f" {_aggregated('web_pages', repr('{}'))}"
    ),
    "normalized_titles": (
        f"with {_ANCHORS} select page_id, char_start, href, {_wikilink('href')} as wikilink,"
        f" {_normalize('href')} as normalized from anchors"
    ),
    "page_meta": (
        f"with {_META} select id, is_redirect, redirect_target, is_stub, disamb from page_meta"
    ),
    "redirect_targets_no_fragment": (
        f"with {_META} select id, string_split(redirect_target, '#')[1] as redirect_target"
        " from page_meta where is_redirect"
    ),
    "page_categories": (
        f"with {_DUMP}, c as (select id, {_CATEGORIES} as items from dump)"
        " select id, cast(i - 1 as int) as pos, items[i] as category"
        " from (select *, unnest(generate_series(1, len(items))) as i from c)"
    ),
    "page_raw_links": (
        f"with {_DUMP}, c as (select id, {_RAW_LINKS} as items from dump)"
        " select id, cast(i - 1 as int) as pos, items[i] as link"
        " from (select *, unnest(generate_series(1, len(items))) as i from c)"
    ),
    "page_plain_text_regex": (
        f"with {_DUMP} select id, {_replaced('''coalesce(text, '')''', _PLAIN_STEPS)} as plain"
        " from dump"
    ),
    "translated_titles": (
        f"with {_DUMP} select id, "
        + ", ".join(
            rf"case when regexp_matches(text, '(?m)^\[\[{lang}:(.*?)\]\]$') then"
            rf" regexp_extract(text, '(?m)^\[\[{lang}:(.*?)\]\]$', 1) end as {lang}"
            for lang in ("fr", "de")
        )
        + " from dump"
    ),
    "page_filters": (
        f"with {_META} select id, ns = 0 as is_main, coalesce(length(text), 0) > 0 as has_text,"
        f" {_SPECIAL} as is_special, ns in (0, 14) and coalesce(length(text), 0) > 0 as is_content,"
        " ns <> 0 or text is null or disamb or is_redirect as is_noncontent,"
        f" {_entity_link('title')} as is_entity_link from page_meta"
    ),
    "extract_pages": f"with {_EXTRACT} select * from wiki_pages_rel",
    "extract_links": f"with {_EXTRACT} select {_LINK_COLUMNS} from wiki_links",
    "extract_links_by_own_filter": f"with {_NUMBERED} select {_LINK_COLUMNS} from wiki_links",
    "extract_pages_without_headings": (
        f"with {_NO_HEADINGS} select p.* from wiki_pages_rel p join dump d on p.page_id = d.id"
        " where d.ns = 0"
    ),
    "extract_redirects": f"with {_EXTRACT} select * from wiki_redirects",
    "page_preview": (
        f"with {_EXTRACT}, spans as ("
        "select page_id, array_agg(surface order by i) as surfaces from wiki_links group by page_id"
        ") select a.page_id, a.title, a.redirect_target as redirect,"
        f" case when not is_redirect then case when length({_PREVIEW_TEXT}) > 100"
        f" then substr({_PREVIEW_TEXT}, 1, 97) || '...' else {_PREVIEW_TEXT} end end as text,"
        f" case when not is_redirect then"
        f" coalesce({_first_two('s.surfaces')}, '{{}}') end as surfaces,"
        f" case when not is_redirect then {_first_two('a.categories')} end as categories"
        " from annotated a left join spans s on a.page_id = s.page_id"
    ),
    "wiki_normalized_links": (
        f"with {_EXTRACT} {_normalized('wiki_links', 'wiki_redirects', 'wiki_pages_rel', _BEHIND)}"
    ),
    "wiki_link_counts": (
        f"with {_EXTRACT}, normalized as ("
        f"{_normalized('wiki_links', 'wiki_redirects', 'wiki_pages_rel')}) {_COUNTS}"
    ),
    "wiki_aggregate_pages": (
        f"with {_EXTRACT}, normalized as ("
        f"{_normalized('wiki_links', 'wiki_redirects', 'wiki_pages_rel')})"
        f" {_aggregated('wiki_pages_rel', 'p.categories')}"
    ),
    "wiki_pages": (
        f"with {_DUMP} select id, title, cast(null as varchar) as html, text as mediawiki"
        " from dump where ns in (0, 14) and length(text) > 0"
    ),
    "title_map": f"with {_TARGETS} select title, id from title_map",
    "article_count": f"with {_TARGETS} select count(*) as articles from title_map",
    "redirect_edges": f"with {_TARGETS} select src, dst from edges",
    "unresolved_redirects": (
        f"with {_TARGETS} select src, title from targets"
        " where dst is null and not regexp_matches(title, '[#:]')"
    ),
    "resolved_redirects": f"with recursive {_TARGETS}, {_WALK} select src, dst from resolved",
    "redirect_loops": (
        f"with recursive {_TARGETS}, {_WALK}"
        f" select l.src, {_normalize('w.title')} as title from ({_LOOPING}) l"
        " left join wiki_pages w on l.src = w.id"
    ),
    "redirect_stats": (
        f"with recursive {_TARGETS}, {_WALK}"
        " select 'articles' as part, count(*) as n from title_map"
        " union all select 'redirects', count(*) from resolved"
        f" union all select 'loops', count(*) from ({_LOOPING})"
        " union all select 'unresolved', count(*) from targets"
        " where dst is null and not regexp_matches(title, '[#:]')"
    ),
    "resolved_part_chains": (
        f"with recursive {_PART_EDGES}, {_WALK} select src, dst from resolved"
    ),
    "looping_part_chains": f"with recursive {_PART_EDGES}, {_WALK} {_LOOPING}",
    "dump_scan": f"with {_DUMP} select id, ns, title, coalesce(text, '') as text from dump",
    "dump_count": f"with {_DUMP} select count(*) as pages, cast(0 as bigint) as corrupt from dump",
}
ORACLES["dump_count_with_broken_pages"] = (
    f"with {_DUMP} select count(*) filter (id % 9 <> 4) as pages,"
    " count(*) filter (id % 9 = 4) as corrupt from dump"
)
ORACLES["dump_wiki_pages"] = ORACLES["wiki_pages_parquet"] = ORACLES["wiki_pages"]
ORACLES["csv_links_in_ten_files"] = ORACLES["extract_links"]
ORACLES["extract_pages_without_links"] = (
    f"with {_EXTRACT} select page_id, content, cast(0 as int) as n_links from wiki_pages_rel"
)
# Worked out by hand: the image and the category render nothing, pages in the site's own namespaces
# have no text.
ORACLES["extract_links_site_names"] = """
  select doc_id as page_id, cast(3 as int) as char_start, cast(4 as int) as char_end, 'b' as surface,
    'B' as title
  from documents where doc_id % 5 <> 0
"""
ORACLES["namespace_scan"] = """
  select * from (values (0, null), (6, 'Datei'), (14, 'Kategorie')) as t(ns, name)
  union all select distinct cast(ascii(coalesce(lang, 'x')) * 256 + ascii(substr(coalesce(lang, 'x'), 2)) as int),
    concat('Raum ', coalesce(lang, 'x')) from documents
"""
ORACLES["special_titles_of_site"] = (
    f"select doc_id as id, {SITE_TITLE} as title, doc_id % 5 = 0 as is_special from documents"
)
# Worked out by hand: the image link is gone, one bracket on each side stays; of the three blank
# surfaces only the no-break space is a link.
ORACLES["odd_markup"] = """
  select doc_id as id,
    'x[]y ' || chr(8704) || chr(233) || chr(233) || chr(977) || '  ' || chr(12288) || '  ' || chr(8195) || '  '
      || chr(160) || '  ' || {plain} as content,
    cast(17 as int) as char_start, cast(18 as int) as char_end, chr(160) as surface, 'd' as link
  from documents
""".format(plain=PLAIN_TEXT)
ORACLES["link_counts_after_join"] = ORACLES["link_counts"]
ORACLES["csv_pages"] = ORACLES["extract_pages"]
ORACLES["csv_links"] = ORACLES["extract_links"]
ORACLES["csv_redirects"] = ORACLES["extract_redirects"]
ORACLES["csv_links_one_file"] = ORACLES["extract_links"]
ORACLES["csv_pages_foreign"] = ORACLES["extract_pages"]

# Walks of 64 steps from a source that runs into a loop end on it; a member comes back to itself.
_LOOPS = f"""
looping as ({_LOOPING}),
ends as (select src, dst from walk where depth = 64 and src in (select src from looping)),
back as (select src, min(depth) as size from walk where src = dst group by src),
hops as (select w.src, w.dst, w.depth from walk w join back b on w.src = b.src where w.depth <= b.size),
members as (
  select src, min(dst) as loop_id from hops group by src
),
placed as (
  select m.src, m.loop_id, case when m.src = m.loop_id then 0 else h.depth end as place
  from members m left join hops h on h.src = m.loop_id and h.dst = m.src
),
labels as (
  select e.src, p.loop_id, own.src is not null as on_loop, cast(own.place as bigint) as place
  from ends e join placed p on p.src = e.dst left join placed own on own.src = e.src
)
"""
ORACLES["looping_part_labels"] = f"with recursive {_PART_EDGES}, {_WALK}, {_LOOPS} select * from labels"
ORACLES["redirect_loop_titles"] = (
    f"with recursive {_TARGETS}, {_WALK}, {_LOOPS}, reports as ("
    f"select l.loop_id, array_agg({_normalize('w.title')} order by l.place) as titles"
    " from labels l join wiki_pages w on w.id = l.src where l.on_loop group by l.loop_id)"
    f" select src, loop_id, on_loop, {_array('titles')} as loop_titles from labels join reports using (loop_id)"
)

ORACLES["dump_counts_while_extracting"] = ORACLES["dump_count_with_broken_pages"]
_NUMBER = "row_number() over (order by id) - 1"
ORACLES["page_numbers"] = (
    f"with {_DUMP} select id, {_NUMBER} as number, cast(({_NUMBER}) % 10 as int) as chunk from dump"
)
ORACLES["csv_links_in_chunks"] = (
    f"with {_EXTRACT}, numbers as (select id, {_NUMBER} as number from dump)"
    f" select {_LINK_COLUMNS}, cast(number % 10 as int) as chunk from wiki_links join numbers on id = page_id"
)
ORACLES["pages_by_callback"] = (
    f"with {_EXTRACT}, numbers as (select id, {_NUMBER} as number from dump),"
    " sizes as (select page_id, count(*) as n from wiki_links group by page_id)"
    " select number, a.page_id, cast(coalesce(n, 0) as int) as n_links,"
    " cast(length(content) as int) as n_chars"
    " from annotated a join numbers on id = a.page_id left join sizes s on s.page_id = a.page_id"
)
# Behind a closing mark too many the depth is -1 outside of templates and 0 inside: text goes, and what
# stands in a template stays, but for the templates in it.
_INSIDE = r"\{\{((?:[^{}]|\{\{[^{}]*\}\})*)\}\}"
_STRICT = (
    rf"'a ' || array_to_string(list_transform(regexp_extract_all("
    rf"regexp_replace(text, '\|\s*\{{\{{transl\}}\}}\s*\]\]', '|]]', 'g'), '{_INSIDE}', 1),"
    rf" lambda b: regexp_replace(b, '{_TEMPLATE[0]}', '', 'g')), '')"
)
ORACLES["extract_pages_strict_depth"] = "with {} select * from wiki_pages_rel".format(
    _EXTRACT.replace("dump as (select", "raw as (select", 1)
    .replace(" from documents)", f" from documents), dump as (select * replace ({STRAY} as text) from raw)", 1)
    .replace(" then text else ''", f" then case when id % 4 = 1 then {_STRICT} else text end else ''", 1)
)
ORACLES["aggregate_pages_bucketed"] = ORACLES["wiki_aggregate_pages"]
ORACLES["first_wiki_pages"] = f"{ORACLES['wiki_pages']} order by id limit 5"
ORACLES["redirect_stats_rows"] = (
    f"with recursive {_TARGETS}, {_WALK}"
    " select 'titles' as part, id, cast(null as bigint) as other, title from title_map"
    " union all select 'redirects', src, dst, null from resolved"
    f" union all select 'loops', l.src, null, {_normalize('w.title')} from ({_LOOPING}) l"
    " left join wiki_pages w on l.src = w.id"
    " union all select 'unresolved', src, null, title from targets"
    " where dst is null and not regexp_matches(title, '[#:]')"
)
