"""Page metadata read off the wikitext. `text` may be NULL in all of these."""

import re
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.scan import let, replace_closed_lines
from linkloom.functions.titles import wikilink_title

# Names of the templates that mark a disambiguation page. Each also counts with
# its first letter in lower case.
DISAMBIGUATION_TEMPLATES = ["Disambig", "Disambiguation", "Dab", "DAB", "Disamb"]
DISAMBIGUATION_SUFFIX = "(disambiguation)"
REDIRECT_PREFIX = "#REDIRECT"
STUB_MARK = "-stub}}"


def disambiguation_pattern() -> str:
    names = "|".join(
        f"{name}|{name[:1].lower()}{name[1:]}" for name in DISAMBIGUATION_TEMPLATES
    )
    return "[{][{](" + names + ")[|}]"


# The order and the patterns of the regex clean-up in `plain_text_regex`.
PIPED_WORD = r"\s(.*?)\|(\w+\s)"
PLAIN_TEXT_STEPS = [
    ("&gt;", ">"),
    ("&lt;", "<"),
    (r"<ref>.*?</ref>", " "),
    (r"</?.*?>", " "),
    (r"\{\{.*?\}\}", " "),
    (r"\[\[.*?:.*?\]\]", " "),
    (r"\[\[(.*?)\]\]", "$1"),
    (PIPED_WORD, " $2"),
    (r"\[.*?\]", " "),
    (r"'+", ""),
]
# The mark that ends a match of a step, and a literal in every match of it.
_CLOSING = {
    PLAIN_TEXT_STEPS[2][0]: ("</ref>", "<ref>"),
    PLAIN_TEXT_STEPS[3][0]: (">", "<"),
    PLAIN_TEXT_STEPS[4][0]: (r"\}\}", "{{"),
    PLAIN_TEXT_STEPS[6][0]: (r"\]\]", "[["),
    PIPED_WORD: (r"\|\w+\s", "|"),
    PLAIN_TEXT_STEPS[8][0]: (r"\]", "["),
}
_COLON_LINK = PLAIN_TEXT_STEPS[5][0]


def _redirect_body(text: Column) -> Column:
    return F.regexp_extract(text, r"(?s)\[\[(.*?)\]\]", 1)


def is_redirect(text: Column) -> Column:
    """Starts with the redirect word in any case, and names a target."""
    starts = F.upper(F.substring(text, 1, len(REDIRECT_PREFIX))) == REDIRECT_PREFIX
    return F.coalesce(starts & (_redirect_body(text) != ""), F.lit(False))


def redirect_target(text: Column, strip_fragment: bool = False) -> Column:
    """Normalized target, NULL where the page is no redirect.

    The whole text between the brackets counts, section and all, unless `strip_fragment`.
    """
    body = _redirect_body(text)
    if strip_fragment:
        body = F.substring_index(body, "#", 1)
    return F.when(is_redirect(text), wikilink_title(body))


def is_stub(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit(STUB_MARK)), F.lit(False))


def is_disambiguation(title: Column, text: Column) -> Column:
    named = F.endswith(title, F.lit(DISAMBIGUATION_SUFFIX))
    return F.coalesce(
        text.isNotNull() & (named | text.rlike(disambiguation_pattern())), F.lit(False)
    )


def _first_parts(bodies: Column) -> Column:
    """First non-empty part of each body between pipes; bodies of pipes only are dropped."""
    return F.filter(
        F.transform(bodies, lambda b: F.nullif(F.regexp_extract(b, r"[^|]+", 0), F.lit(""))),
        lambda part: part.isNotNull(),
    )


def _up_to_closed(text: Column) -> Column:
    """Each line up to its last `]]`; behind it no link ends, and a search for one would fail slowly."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(.*\]\])|.+", "$1")


def categories(text: Column) -> Column:
    """The page's categories, from every `[[Category:...]]` on one line."""
    found = F.regexp_extract_all(
        _up_to_closed(text), F.lit(r"\[\[Category:(.*?)\]\]"), 1
    )
    return _first_parts(found)


def raw_links(text: Column) -> Column:
    """Targets of every `[[...]]` on one line, those with a colon left out."""
    found = F.regexp_extract_all(
        _up_to_closed(text), F.lit(r"\[\[(.*?)\]\]"), 1
    )
    return F.filter(_first_parts(found), lambda t: ~F.contains(t, F.lit(":")))


def _drop_colon_links(text: Column) -> Column:
    """`regexp_replace(text, _COLON_LINK, ' ')` in time linear in the text.

    Only the part of a line up to its last `]]` is searched, and in it, opening marks behind the last
    colon, which would each search in vain, are split by a mark for the while.
    """
    mark, split = "\u0001", "\u0002"
    marked = F.regexp_replace(text, r"(.*\]\])|(.+)", f"$1{mark}$2{mark}")
    pieces = F.split(F.replace(marked, F.lit(mark + mark), F.lit("")), mark, -1)

    def search(piece: Column) -> Column:
        # Such a piece may begin with line ends; its last line holds the colon if one does.
        head = F.regexp_extract(piece, r"(?s)\A.*:", 0)
        tail = F.replace(F.substr(piece, F.length(head) + 1), F.lit("[["), F.lit(f"[{split}["))
        found = F.regexp_replace(F.concat(head, tail), _COLON_LINK, " ")
        return F.replace(found, F.lit(split), F.lit(""))

    searched = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, search(p)).otherwise(p))
    has = F.contains(text, F.lit("[[")) & F.contains(text, F.lit(":"))
    return F.when(has, F.array_join(searched, "")).otherwise(text)


def plain_text_regex(text: Column) -> Column:
    """Strip wiki markup by ten replacements in a fixed order. The marks U+0001 and U+0002 are no text."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "[\u0001\u0002]", "")
    for pattern, replacement in PLAIN_TEXT_STEPS:
        if pattern == _COLON_LINK:
            out = let(out, _drop_colon_links)
        elif pattern in _CLOSING:
            step = partial(replace_closed_lines, pattern=pattern, replacement=replacement)
            closing, opening = _CLOSING[pattern]
            out = let(out, lambda c: step(c, closing=closing, opening=opening))  # noqa: B023
        else:
            out = F.regexp_replace(out, pattern, replacement)
    return out


def translated_title(text: Column, lang: str) -> Column:
    """Title in another language: the first line that is exactly `[[lang:...]]`, else NULL."""
    pattern = r"(?m)^\[\[" + re.escape(lang) + r":(.*?)\]\]$"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))
