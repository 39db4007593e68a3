"""Relations derived from the given tables.

`pages` (web pages) gives links, redirects and entities. `documents` gives wikitext: each page
carries its document's whole text, with words of it turned into links, templates, references,
images and so on. The wikitext expressions are plain SQL that Spark and the checking engine read
alike.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.scan import let, running_total
from linkloom.functions.titles import wikilink_title
from linkloom.operators.once import with_fields

ANCHOR = '<a href="/([^"]*)">([^<]*)</a>'
TITLE = "<title>([^<]+)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def web_parsed(web: DataFrame) -> DataFrame:
    """`(page_id, title, anchors)`, the page source read and searched once.

    `anchors` is an array of `(char_start, char_end, surface, href)`; the offsets are those of the
    anchor's text in the page source.
    """

    def cut(html: Column) -> Column:
        return F.struct(
            F.split(html, ANCHOR, -1).alias("gaps"),
            F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("hrefs"),
            F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("texts"),
            wikilink_title(F.regexp_extract(html, TITLE, 1)).alias("title"),
        )

    def opened(p: Column) -> Column:
        # The last gap has no anchor behind it.
        opening = F.zip_with(p["gaps"], p["hrefs"], lambda g, h: F.length(g) + F.length(h) + 12)
        return F.struct(
            F.slice(opening, F.lit(1), F.size(p["hrefs"])).alias("opening"),
            F.arrays_zip(p["texts"].alias("surface"), p["hrefs"].alias("href")).alias("anchors"),
            p["title"].alias("title"),
        )

    def spanned(p: Column) -> Column:
        whole = F.zip_with(p["opening"], p["anchors"], lambda o, a: o + F.length(a["surface"]) + 4)
        starts = F.zip_with(running_total(whole), p["opening"], lambda t, o: t + o)
        anchors = F.zip_with(
            starts,
            p["anchors"],
            lambda start, a: F.struct(
                start.alias("char_start"),
                (start + F.length(a["surface"])).alias("char_end"),
                a["surface"].alias("surface"),
                a["href"].alias("href"),
            ),
        )
        return F.struct(p["title"].alias("title"), anchors.alias("anchors"))

    page = let(let(let(F.col("html"), cut), opened), spanned)
    return with_fields(web, page, keep=("page_id",))


def web_anchors(parsed: DataFrame) -> DataFrame:
    anchor = F.col("a")
    return parsed.select("page_id", F.explode("anchors").alias("a")).select(
        "page_id", *(anchor[c].alias(c) for c in ("char_start", "char_end", "surface", "href"))
    )


def web_links(parsed: DataFrame) -> DataFrame:
    return web_anchors(parsed).select(
        "page_id", "char_start", "char_end", "surface", wikilink_title(F.col("href")).alias("title")
    )


def web_redirects(links: DataFrame) -> DataFrame:
    """A title that ends in commas or dots redirects to the title without them."""
    bare = F.regexp_replace("title", "[,.]+$", "")
    return (
        links.select("title").distinct().select("title", bare.alias("target")).where("title <> target")
    )


def web_pages(web: DataFrame) -> DataFrame:
    return web.select(
        "page_id",
        wikilink_title(F.regexp_extract("html", TITLE, 1)).alias("title"),
        F.col("html").alias("content"),
        F.lit(False).alias("disamb"),
        F.array().cast("array<string>").alias("categories"),
    )


def web_entities(parsed: DataFrame) -> DataFrame:
    """The titles that each page answers to: its whole title and the first word of it.

    Many pages share a first word, so a link to it leads to each of them.
    """
    names = F.array_distinct(F.array("title", F.substring_index("title", " ", 1)))
    return parsed.select("page_id", F.explode(names).alias("title"))


def _chain(text: str, steps: list[tuple[str, str]]) -> str:
    for old, new in steps:
        text = f"replace({text}, {old}, {new})"
    return text


def _number(expression: str) -> str:
    return f"cast({expression} as varchar(20))"


_NEWLINE = "chr(10)"
_BODY = _chain(
    "text",
    [
        (_NEWLINE, f"concat({_NEWLINE}, '== Part ==', {_NEWLINE}, '* ')"),
        ("' the '", f"concat(' [[page_', {_number('(doc_id * 5) % 200')}, '|the]] ')"),
        ("' de '", f"concat(' [[page ', {_number('doc_id + 7')}, ']] ')"),
        ("' of '", "' [[page 1#Part|of]] '"),
        ("' and '", "' {{tmpl|{{lang|and}}}} '"),
        ("' la '", 'concat(\' \', chr(39), chr(39), \'la\', chr(39), chr(39), \' <ref name="r">n</ref> \')'),
        ("' der '", "' [[Talk:page|der]] '"),
        ("' und '", "' &lt;und&gt; &amp;amp; &#233; '"),
        ("' in '", "' [[File:x.png|thumb|see [[page 1|inner]]]] in '"),
        ("' to '", "' [http://x.example/y to] '"),
        ("' el '", "' <br/>el <b>x</b> '"),
        ("' die '", "' [[die_art|{{transl}}]] '"),
        ("' les '", "' [[les|  ]] '"),
        ("' que '", "' [[ß_que| que ]] '"),
    ],
)

# A redirect is page 7k. One in eight leads to page 1; the others form chains down to those, but
# for a loop of three pages and the chain that runs into it in every 32.
_TARGET = (
    "case when (doc_id % 224) = 63 then doc_id + 14"
    " when (doc_id % 56) = 0 then 1 else doc_id - 7 end"
)

WIKITEXT = {
    "id": "doc_id",
    "ns": "cast(case when doc_id % 11 = 0 then 14 when doc_id % 13 = 0 then 10 else 0 end as int)",
    "title": (
        "concat(case when doc_id % 11 = 0 then 'Category:' when doc_id % 13 = 0 then 'Template:'"
        f" else '' end, 'page ', {_number('doc_id')},"
        " case when doc_id % 17 = 0 then ' (disambiguation)' else '' end)"
    ),
    "text": (
        "case when doc_id % 97 = 96 then null"
        f" when doc_id % 7 = 0 then concat('#redirect [[page ', {_number(_TARGET)},"
        f" case when doc_id % 10 = 0 then '#S' else '' end, ']]', {_NEWLINE}, text)"
        f" when doc_id % 19 = 0 then concat('#REDIRECT nothing ', {_BODY})"
        f" else concat({_BODY},"
        " case when doc_id % 5 = 0 then ' {{disambig|geo}}' else '' end,"
        " case when doc_id % 3 = 0 then ' {{x-stub}}' else '' end,"
        " ' [[Category:', lang, '|', source, ']] [[Category:|', source, ']]',"
        f" case when doc_id % 2 = 0 then concat({_NEWLINE}, '[[', lang, ':T ', {_number('doc_id')},"
        f" ']]', {_NEWLINE}) else '' end) end"
    ),
}

WIKI_PAGES = {
    "id": "id",
    "title": "title",
    "html": "cast(case when id % 5 = 4 then '<p></p>' end as varchar(20))",
    "mediawiki": "text",
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]


def wikitext(documents: DataFrame) -> DataFrame:
    """Dump pages `(id, ns, title, text)`."""
    page = F.struct(*[F.expr(e).alias(name) for name, e in WIKITEXT.items()])
    return with_fields(documents, page, keep=())


# Three brackets, many nested links, rare and long-winded entities, blank surfaces; then the whole
# text without the characters that are markup.
ODD_MARKUP = (
    "x[[[File:p.png|" + "[[a]] " * 60 + "]]]y &forall;&#00000233;&#x00000e9;&thetasym; "
    "[[b|\u3000]][[c|&emsp;]][[d|&nbsp;]] "
)


# A site that names its file and category namespaces itself and has one for each language of its
# articles. Every fifth page is in one of those.
SITE_MARKUP = "[[Datei:x.png|thumb|[[a]]]] [[Kategorie:K]] [[b]] "
SITE_TITLE = "case when doc_id % 5 = 0 then concat('Raum ', coalesce(lang, 'x'), ':T') else 'T' end"
MARKUP_CHARACTERS = r"[\[\]{}<>&''=*#:;|!]"
PLAIN_TEXT = f"regexp_replace(coalesce(text, ''), '{MARKUP_CHARACTERS}', '', 'g')"


def odd_markup(documents: DataFrame, markup: str = ODD_MARKUP, title: str = "'T'") -> DataFrame:
    """Dump pages `(id, ns, title, text)` of the articles' text behind some markup."""
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), MARKUP_CHARACTERS, "")
    return documents.select(
        F.col("doc_id").alias("id"),
        F.lit(0).alias("ns"),
        F.expr(title).alias("title"),
        F.concat(F.lit(markup), plain).alias("text"),
    )


def site_header(documents: DataFrame) -> Column:
    """The header of the site's dump, as a scalar subquery over its articles."""
    lang = F.coalesce("lang", F.lit("x"))
    space = F.format_string(
        '      <namespace key="%d" case="first-letter">Raum %s</namespace>\n',
        F.ascii(lang) * 256 + F.ascii(F.substr(lang, F.lit(2))), lang,
    )
    own = (
        '<mediawiki xml:lang="en">\n  <siteinfo>\n    <namespaces>\n      <namespace key="0" case="first-letter" />\n'
        '      <namespace key="6" case="first-letter">Datei</namespace>\n'
        '      <namespace key="14" case="first-letter">Kategorie</namespace>\n'
    )
    spaces = F.array_join(F.array_sort(F.collect_set(space)), "")
    return documents.agg(F.concat(F.lit(own), spaces, F.lit("    </namespaces>\n  </siteinfo>\n"))).scalar()


# A closing mark too many, and text that it takes along up to the next template.
STRAY = "case when id % 4 = 1 then 'a }} b {{c}} d ' || text else text end"


def stray_braces(dump: DataFrame) -> DataFrame:
    return dump.withColumn("text", F.expr(STRAY))


def wiki_pages(dump: DataFrame) -> DataFrame:
    """`wiki_pages` rows whose `html` is missing from four in five."""
    return dump.selectExpr(*select_list(WIKI_PAGES)).withColumn("html", F.col("html").cast("string"))


def part_edges(part: DataFrame) -> DataFrame:
    """Chains of 19 edges; the first of each hundred parts are a loop of two with a tail."""
    key = F.col("p_partkey")
    return part.where(key % 20 != 0).select(
        key.alias("src"), F.when(key % 100 == 1, key + 1).otherwise(key - 1).alias("dst")
    )
