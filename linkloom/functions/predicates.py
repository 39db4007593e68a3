"""Filters over dump pages, `wiki_pages` rows and link titles."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes that mark a page title as special whatever the site says.
SPECIAL_PREFIXES = [
    "Media",
    "Special",
    "",
    "Talk",
    "User",
    "User_talk",
    "Meta",
    "Meta_talk",
    "Image",
    "Image_talk",
    "MediaWiki",
    "MediaWiki_talk",
    "Template",
    "Template_talk",
    "Help",
    "Help_talk",
    "Category",
    "Category_talk",
    "File",
    "File_talk",
    "Wikipedia",
    "Wikipedia_talk",
    "Portal",
    "Portal_talk",
    "WP",
    "Project",
    "CAT",
    "MOS",
]

# The standard wiki namespaces whose links are not entity links. Each one but the
# two virtual ones has a talk space.
VIRTUAL_NAMESPACES = ["Media", "Special"]
SUBJECT_NAMESPACES = [
    "User",
    "Wikipedia",
    "Project",
    "File",
    "Image",
    "MediaWiki",
    "Template",
    "Help",
    "Category",
    "Portal",
]
LINK_NAMESPACES = [
    *VIRTUAL_NAMESPACES,
    "Talk",
    *SUBJECT_NAMESPACES,
    *(f"{name} talk" for name in SUBJECT_NAMESPACES),
]

LinkFilter = Callable[[Column], Column]


def prefix(title: Column) -> Column:
    return F.substring_index(title, ":", 1)


def is_main(ns: Column) -> Column:
    return ns == 0


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) > 0


def is_special_title(title: Column, site_names: Iterable[str] | Column = ()) -> Column:
    """The part before the first colon is a site namespace or one of the fixed prefixes.

    `site_names` is the site's own list, or an array column of it, as
    `sources.dump.namespace_names` gives it.
    """
    named = prefix(title).isin(SPECIAL_PREFIXES)
    if not isinstance(site_names, Column):
        site_names = F.array(*[F.lit(n) for n in site_names if n]).cast("array<string>")
    named |= F.array_contains(site_names, prefix(title))
    return F.coalesce(F.contains(title, F.lit(":")) & named, F.lit(False))


def is_content_page(ns: Column, text: Column) -> Column:
    """An article or a category page that has text."""
    return ns.isin(0, 14) & has_text(text)


def is_noncontent_page(
    ns: Column, text: Column, disamb: Column, redirect: Column
) -> Column:
    return ~is_main(ns) | text.isNull() | disamb | redirect


def is_entity_link(title: Column) -> Column:
    """Default link filter: false where the part before the colon is a namespace."""
    spaced = F.replace(prefix(title), F.lit("_"), F.lit(" "))
    return ~F.contains(title, F.lit(":")) | ~spaced.isin(LINK_NAMESPACES)


# White space as Java's Character.isWhitespace has it: Unicode blanks but the no-break ones, and
# the ASCII separators.
_WHITE = r"[\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]"


def is_blank(surface: Column) -> Column:
    return surface.rlike(rf"\A{_WHITE}*\z")


def is_redirect_row(html: Column, mediawiki: Column) -> Column:
    """`html IS NULL AND lower(mediawiki) LIKE '#redirect%'`, lower-casing the prefix only."""
    return html.isNull() & (F.lower(F.substring(mediawiki, 1, 9)) == "#redirect")


def is_plain_title(title: Column) -> Column:
    """Neither a section of a page nor a title in a namespace."""
    return ~title.rlike("[#:]")
