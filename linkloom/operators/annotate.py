"""Wikitext to plain text with link spans, inside the row: no shuffle, no Python UDF.

`annotate_links` takes dump pages and adds `content` and `links`, an array of
`(char_start, char_end, surface, link)`. Offsets count code points, start at 0 and end before
`char_end`, so `substring(content, char_start + 1, char_end - char_start) = surface`.

The rules, in their order:

1. comments go; a `{{transl}}` shown in a link stands for the link's own title;
2. templates go, by a depth counter over `{{` and `}}`;
3. references go, with what is in them;
4. external links keep their text; image and category links go whole, nested links included;
5. `<br>` and `<hr>` become a blank line; headings, list items and table cells keep their text;
   runs of two or more apostrophes and every other tag go, the text inside a tag stays;
6. entities are decoded;
7. a link `[[topic#section|text]]` shows its text between two spaces and is a span from the
   first to the last character of it; a link the filter rejects shows its text alone.

Every step names the text before it once, binding it with `let` where it needs it more often, so the
whole is one expression of linear size. It is evaluated once per page, behind a generator.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.entities import decode_entities
from linkloom.functions.predicates import (
    LinkFilter,
    has_text,
    is_blank,
    is_entity_link,
    is_main,
    is_special_title,
)
from linkloom.functions.scan import holds, let, replace_closed, replace_marked, running_total, scan
from linkloom.functions.titles import strip, wikilink_title
from linkloom.operators.once import with_fields

# Control characters no XML text can hold; they mark places in the text between two steps.
MARK = "\u0001"
OPENED = "\u0002"
TRANSL = "\u0003"
GONE = "\u0004"

SPAN_TYPE = "array<struct<char_start:int,char_end:int,surface:string,link:string>>"

IMAGE_NAMES = ("File", "Image")
CATEGORY_NAMES = ("Category",)

# `<ref .../>` first: then every opening mark before the last closing one has one behind it.
_EMPTY_REF = r"(?i)<ref(?:\s[^<>]*+)?+(?<=/)>"
_REF = r"(?is)<ref(?:\s[^<>]*+)?+>.*?</ref\s*>"
# Possessive where giving back cannot help, so that a mark left open costs one look and no more.
_EXTERNAL = r"\[(?:https?:|ftp:)?//[^\s\[\]]++[ \t]*+([^\[\]\n]*+)\]"
_BREAK = r"(?i)</?(?:br|hr)(?:\s[^<>]*)?/?>"
_TAG = r"</?[a-zA-Z][^<>]*>"
_HEADING = r"(?m)^=++[ \t]*+([^\n]*[^=\s])[ \t]*+=++[ \t]*+$"
_TABLE_LINE = r"(?m)^(?:\{\|[^\n]*|\|[-}][^\n]*|[|!])"
_LIST_MARK = r"(?m)^[*#:;]+[ \t]*"
_LINK = r"\[\[[^\[\]]+\]\]"
_LINK_BODY = r"\[\[([^\[\]]+)\]\]"


def _pieces(text: Column, delimiter: str) -> Column:
    """Cut in front of every delimiter; each piece but the first starts with one."""
    return F.split(F.regexp_replace(text, delimiter, MARK + "$0"), MARK, -1)


def drop_templates(text: Column, strict_depth: bool = False) -> Column:
    """Keep the text at template depth 0.

    A closing mark without an opening one leaves the depth at 0. With `strict_depth` it takes it
    to -1, and text is dropped until the next opening mark.
    """
    opens = lambda x: F.startswith(x, F.lit("{{"))
    closes = lambda x: F.startswith(x, F.lit("}}"))

    def depth(state: Column, x: Column) -> Column:
        down = state - 1 if strict_depth else F.greatest(state - 1, F.lit(0))
        return F.when(opens(x), state + 1).when(closes(x), down).otherwise(state)

    def kept(state: Column, x: Column) -> Column:
        bare = F.when(opens(x) | closes(x), F.substr(x, F.lit(3))).otherwise(x)
        return F.when(depth(state, x) == 0, bare).otherwise("")

    pieces = _pieces(text, r"\{\{|\}\}")
    return F.array_join(scan(pieces, F.lit(0), depth, kept, "string"), "")


def _head(names: Iterable[str] | Column, start: str = "") -> Column:
    """The pattern of the begin of a link to one of `names`: patterns, or a column `a|b|c` of them."""
    names = names if isinstance(names, Column) else F.lit("|".join(names))
    return F.concat(F.lit(rf"(?i){start}\[\[\s*(?:"), names, F.lit(r")\s*:"))


def drop_media_links(text: Column, names: Iterable[str] | Column) -> Column:
    """Remove `[[name:...]]` for each of `names` with everything inside, nested links too.

    Only closed links count: a backward scan first finds the brackets that have a partner, so an
    opening mark left open costs nothing behind it.
    """
    opens = lambda x: F.startswith(x, F.lit("[["))
    closes = lambda x: F.startswith(x, F.lit("]]"))
    heads = _head(names, "^")

    # Of three or more brackets in a row the last two open the link, also one already gone.
    pieces = _pieces(text, rf"\[\[(?![\[{GONE}])|\]\]")
    # Backwards: how many closing marks still wait for an opening one.
    waiting = lambda s, x: (
        F.when(closes(x), s + 1)
        .when(opens(x), F.greatest(s - 1, F.lit(0)))
        .otherwise(s)
    )
    marked = F.reverse(
        scan(
            F.reverse(pieces),
            F.lit(0),
            waiting,
            lambda s, x: F.when(opens(x) & (s > 0), F.concat(F.lit(OPENED), x)).otherwise(x),
            "string",
        )
    )

    paired = lambda x: F.startswith(x, F.lit(OPENED))
    bare = lambda x: F.when(paired(x), F.substr(x, F.lit(2))).otherwise(x)

    # Forwards: depth inside a dropped link, 0 outside.
    def inside(s: Column, x: Column) -> Column:
        start = paired(x) & ((s > 0) | F.rlike(F.substr(x, F.lit(2)), heads))
        return F.when(start, s + 1).when(closes(x) & (s > 0), s - 1).otherwise(s)

    def kept(s: Column, x: Column) -> Column:
        after = F.when(closes(x) & (s > 0), F.substr(x, F.lit(3))).otherwise(bare(x))
        return F.when(inside(s, x) == 0, after).otherwise("")

    return F.array_join(scan(marked, F.lit(0), inside, kept, "string"), "")


def _shallow(names: Iterable[str] | Column) -> Column:
    """A link of one of `names` with up to 400 plain links in it: nearly all, in one pass.

    The pattern engine takes the links of a possessive group in a loop. The bound is there because a
    link left open is searched that far; `drop_media_links` takes the rest by the same rule. A mark
    stays in the place of what went, so that brackets on its two sides don't become one.
    """
    return F.concat(
        _head(names), F.lit(r"[^\[\]]*+(?:\[\[[^\[\]]*+\]\][^\[\]]*+){0,400}+\]\]")
    )


def drop_media(text: Column, names: Iterable[str] | Column) -> Column:
    """`drop_media_links`, with one pattern for what needs no scan."""
    text = F.regexp_replace(text, _shallow(names), F.lit(GONE))
    text = let(
        text, lambda c: F.when(F.rlike(c, _head(names)), drop_media_links(c, names)).otherwise(c)
    )
    return F.replace(text, F.lit(GONE), F.lit(""))


def plain_wikitext(
    text: Column,
    keep_section_titles: bool = True,
    strict_depth: bool = False,
    media_names: Iterable[str] | Column = (*IMAGE_NAMES, *CATEGORY_NAMES),
) -> Column:
    """Rules 1 to 6: what is left is plain text and `[[...]]` links.

    A step's pattern is searched only in texts with one of the literals that every match holds.
    """
    text = replace_marked(text, f"[{MARK}{OPENED}{TRANSL}{GONE}]", "", MARK, OPENED, TRANSL, GONE)
    text = let(text, lambda c: replace_closed(c, r"(?s)<!--.*?-->", "", "-->", "<!--"))
    text = replace_marked(text, r"\|\s*\{\{transl\}\}\s*\]\]", "|" + TRANSL + "]]", "{{tran")
    text = let(
        text, lambda c: F.when(holds(c, "{{", "}}"), drop_templates(c, strict_depth)).otherwise(c)
    )
    text = replace_marked(text, _EMPTY_REF, "", "/>")
    text = let(text, lambda c: replace_closed(c, _REF, "", "(?i:</ref)\\s*>", "</"))
    text = replace_marked(text, _EXTERNAL, "$1", "//")
    text = drop_media(text, media_names)
    text = let(
        text,
        lambda c: F.when(
            holds(c, "<"), F.regexp_replace(F.regexp_replace(c, _BREAK, "\n\n"), _TAG, "")
        ).otherwise(c),
    )
    text = replace_marked(text, _HEADING, "$1" if keep_section_titles else "", "=")
    text = replace_marked(text, _TABLE_LINE, "", "|", "!")
    text = replace_marked(text, _LIST_MARK, "", "*", "#", ":", ";")
    text = replace_marked(text, r"'{2,}", "", "''")
    return let(text, decode_entities)


def _link(body: Column, link_filter: LinkFilter) -> Column:
    """One link body as `(link, shown, href)`; `href` says whether the filter lets it through."""

    def parts(b: Column) -> Column:
        link = strip(F.substring_index(F.substring_index(b, "|", 1), "#", 1))
        pipe = F.instr(b, "|")
        text = strip(F.when(pipe > 0, F.substr(b, pipe + 1)).otherwise(b))
        return F.struct(link.alias("link"), text.alias("text"))

    def finish(p: Column) -> Column:
        own_title = F.replace(p["link"], F.lit("_"), F.lit(" "))
        shown = F.when(p["text"] == TRANSL, own_title).otherwise(
            F.replace(p["text"], F.lit(TRANSL), F.lit(""))
        )
        return F.struct(
            p["link"].alias("link"),
            shown.alias("shown"),
            link_filter(wikilink_title(p["link"])).alias("href"),
        )

    return let(let(F.regexp_replace(body, r"^\s*:", ""), parts), finish)


def link_spans(text: Column, link_filter: LinkFilter) -> Column:
    """Rule 7: the final text and its spans, as a struct `(content, links)`."""

    def cut(c: Column) -> Column:
        bodies = F.regexp_extract_all(c, F.lit(_LINK_BODY), 1)
        # One gap more than links: the last one has no link behind it.
        return F.struct(
            F.split(c, _LINK, -1).alias("gaps"),
            F.transform(bodies, lambda b: _link(b, link_filter)).alias("links"),
        )

    def shown(p: Column) -> Column:
        padded = F.transform(
            p["links"],
            lambda x: F.when(
                x["href"], F.concat(F.lit(" "), x["shown"], F.lit(" "))
            ).otherwise(x["shown"]),
        )
        return F.struct(p["gaps"].alias("gaps"), p["links"].alias("links"), padded.alias("outs"))

    def finish(p: Column) -> Column:
        content = F.zip_with(
            p["gaps"],
            p["outs"],
            lambda gap, out: F.concat(gap, F.coalesce(out, F.lit(""))),
        )
        # Text before the link, the gap in front of it, and its leading space.
        starts = F.zip_with(
            running_total(F.transform(content, F.length)),
            p["gaps"],
            lambda before, gap: before + F.length(gap) + 1,
        )
        spans = F.zip_with(
            p["links"],
            starts,
            lambda x, start: F.struct(
                start.alias("char_start"),
                (start + F.length(x["shown"])).alias("char_end"),
                x["shown"].alias("surface"),
                F.when(x["href"] & ~is_blank(x["shown"]), x["link"]).alias("link"),
            ),
        )
        kept = F.filter(spans, lambda s: s["link"].isNotNull())
        return F.struct(
            F.array_join(content, "").alias("content"), kept.cast(SPAN_TYPE).alias("links")
        )

    return let(let(let(text, cut), shown), finish)


def annotate_links(
    dump: DataFrame,
    site_names: Iterable[str] | Column = (),
    link_filter: LinkFilter = is_entity_link,
    keep_section_titles: bool = True,
    strict_depth: bool = False,
    with_links: bool = True,
    media_names: Iterable[str] | Column = (*IMAGE_NAMES, *CATEGORY_NAMES),
) -> DataFrame:
    """Add `content` and `links` to dump pages `(id, ns, title, text)`.

    Pages outside the main namespace, special titles and pages without text get `''` and no
    links. `link_filter` takes a link's normalized title and says whether it becomes a span.
    `with_links=False` leaves the array empty and the text as it is.
    """
    gate = (
        is_main(F.col("ns"))
        & has_text(F.col("text"))
        & ~is_special_title(F.col("title"), site_names)
    )
    # Gated pages carry '' through the steps, which costs next to nothing.
    text = F.when(gate, F.col("text")).otherwise("")
    page = link_spans(
        plain_wikitext(text, keep_section_titles, strict_depth, media_names), link_filter
    )
    annotated = with_fields(dump, page)
    return annotated if with_links else annotated.withColumn("links", F.array().cast(SPAN_TYPE))
