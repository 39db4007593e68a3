import random
import time

import pytest
from pyspark.sql import functions as F

from linkloom.functions import meta
from linkloom.operators.annotate import (
    IMAGE_NAMES,
    _shallow,
    annotate_links,
    drop_media,
    drop_media_links,
    drop_templates,
    plain_wikitext,
)

DUMP = "id long, ns int, title string, text string"


@pytest.fixture
def render(spark):
    def run(text, **options):
        df = spark.createDataFrame([(1, 0, "T", text)], DUMP)
        row = annotate_links(df, **options).first()
        for link in row.links:
            assert row.content[link.char_start : link.char_end] == link.surface
        return row.content, [(s.surface, s.link) for s in row.links]

    return run


def test_link_is_padded_and_spanned(render):
    assert render("a [[foo_bar#Sec|b c]] d[[x]]") == (
        "a  b c  d x ",
        [("b c", "foo_bar"), ("x", "x")],
    )


def test_offsets_count_code_points(spark):
    df = spark.createDataFrame([(1, 0, "T", "😀é [[a😀|b😀]] [[c]]")], DUMP)
    got = annotate_links(df).select("content", F.explode("links").alias("s"))
    got = got.withColumn(
        "cut",
        F.substr("content", F.col("s.char_start") + 1, F.col("s.char_end") - F.col("s.char_start")),
    )
    assert [(r.s.char_start, r.cut) for r in got.collect()] == [(4, "b😀"), (9, "c")]


def test_rejected_link_keeps_its_text(render):
    assert render("[[Talk:x|t]] [[fr:y]]") == ("t  fr:y ", [("fr:y", "fr:y")])
    assert render("[[talk:x]] [[user_talk:y]] [[:Category:Z]]") == (
        "talk:x user_talk:y Category:Z", [],
    )
    own = {"link_filter": lambda title: title != "B"}
    assert render("[[a]][[b]][[Talk:c]]", **own) == (" a b Talk:c ", [("a", "a"), ("Talk:c", "Talk:c")])


def test_blank_link_and_transl(render):
    assert render("[[a|  ]]|[[b_c|{{transl}}]]") == ("  | b c ", [("b c", "b_c")])


def test_markup_goes(render):
    text = (
        "== Head ==\n* item '''bold''' <ref name=a/>x<ref>gone [[g]]</ref>\n"
        "a<br/>b <b>c</b> [http://u.x/ y z] [http://u.x/] <!-- {{ --> &amp;lt; <references/>"
    )
    assert render(text)[0] == "Head\nitem bold x\na\n\nb c y z   &lt; "
    assert render(text, keep_section_titles=False)[0].startswith("\nitem")


def test_table_lines(render):
    assert render("{| class=x\n! h\n|-\n| c\n|}\nend")[0] == "\n h\n\n c\n\nend"


def test_images_and_categories_go_with_nested_links(render):
    text = "a[[File:x.png|thumb|see [[b]] and [[File:y|[[c]]|d]]]] [[image:z]] [[Category:C]] [[d]]"
    assert render(text) == ("a    d ", [("d", "d")])


def test_open_image_costs_nothing_behind_it(render):
    assert render("[[File:x [[a]] b")[1] == [("a", "a")]


def test_unbalanced_brackets_stay(render):
    assert render("[[ a ]] b ]] [[c")[0] == " a  b ]] [[c"


def test_gate(spark):
    rows = [
        (1, 0, "A", "x"), (2, 14, "B", "x"), (3, 0, "Talk:C", "x"), (4, 0, "D", None), (5, 0, "E", ""),
        (6, 0, "Book:F", "x"),
    ]
    df = spark.createDataFrame(rows, DUMP)
    assert [r.content for r in annotate_links(df).orderBy("id").collect()] == ["x", "", "", "", "", "x"]
    named = annotate_links(df, site_names=["Book"]).where("id = 6")
    assert named.first().content == ""


def test_without_links_the_text_is_the_same(render):
    assert render("a [[b]]", with_links=False) == ("a  b ", [])


def _depth_model(text, strict):
    out, depth, i = [], 0, 0
    while i < len(text):
        two = text[i : i + 2]
        if two == "{{":
            depth += 1
            i += 2
        elif two == "}}":
            depth = depth - 1 if strict else max(depth - 1, 0)
            i += 2
        else:
            if depth == 0:
                out.append(text[i])
            i += 1
    return "".join(out)


def test_templates_against_a_model(texts):
    rng = random.Random(1)
    given = ["".join(rng.choices("{{}}ab ", k=rng.randint(0, 40))) for _ in range(500)]
    given += ["a {{x {{y}} z}} b }} c {{ d", "{{{a}}} b", "x}}}y{{z", ""]
    got = texts(given, drop_templates, lambda c: drop_templates(c, True))
    assert got == [(_depth_model(t, False), _depth_model(t, True)) for t in given]


def _media_model(text):
    """Pair the brackets by a stack, then drop the outermost paired `[[F:` spans."""
    marks, i = [], 0
    while i < len(text):
        if text[i : i + 2] == "]]" or text[i : i + 2] == "[[" and text[i + 2 : i + 3] != "[":
            marks.append((i, text[i : i + 2]))
            i += 2
        else:
            i += 1
    stack, spans = [], []
    for at, mark in marks:
        if mark == "[[":
            stack.append(at)
        elif stack:
            start = stack.pop()
            if text[start + 2 : start + 4] == "F:":
                spans.append((start, at + 2))
    for start, end in sorted(spans, key=lambda s: s[0], reverse=True):
        if not any(a < start and end <= b for a, b in spans):
            text = text[:start] + text[end:]
    return text


def test_media_links_against_a_model(texts):
    rng = random.Random(2)
    pieces = ["[[F:", "[[", "]]", "a", "|"]
    given = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(500)]
    got = texts(given, lambda c: drop_media_links(c, ["F"]))
    assert got == [_media_model(t) for t in given]


def test_media_links_by_one_rule(texts):
    """The fast pattern and the scan behind it give what the scan gives alone."""
    rng = random.Random(4)
    pieces = ["[[File:", "[[", "]]", "[", "]", "a", "|"]
    given = ["".join(rng.choices(pieces, k=rng.randint(0, 16))) for _ in range(5_000)]
    names = ["File", "Image"]
    both = texts(given, lambda c: drop_media(c, names), lambda c: drop_media_links(c, names))
    assert [a for a, _ in both] == [b for _, b in both]


@pytest.mark.parametrize("n", [0, 1, 40, 41, 60])
def test_any_number_of_nested_links(render, n):
    content, links = render("x[[[File:p.png|" + "[[a]] " * n + "]]]y")
    assert (content, links) == ("x[]y", [])


def test_sixty_nested_links_need_no_scan(texts):
    """One pass of the pattern takes them; so does it a page's worth, without recursion."""
    text = lambda n: "x[[File:p.png|" + "[[a]] " * n + "]]y"
    found = texts([text(60), text(400), text(401)], lambda c: F.regexp_replace(c, _shallow(IMAGE_NAMES), F.lit("-")))
    assert found == ["x-y", "x-y", text(401)]


@pytest.mark.parametrize("n", [399, 400, 401, 5000])
def test_many_nested_links(render, n):
    assert render("x[[File:p.png|" + "[[a]] " * n + "]]y") == ("xy", [])


def test_blank_surfaces(render):
    content, links = render("[[a|\u3000]][[b|&emsp;]][[c|&#x2028;]][[d|&nbsp;]][[e|\u202f]]")
    assert [link for _, link in links] == ["d", "e"]


def test_long_page_in_one_row(spark):
    """A page of 100,000 links is one row and one task; the scan must not be quadratic."""
    df = spark.range(1).select(
        F.col("id"), F.lit(0).alias("ns"), F.lit("T").alias("title"),
        F.repeat(F.lit("w [[a|b]] {{t}} "), 100_000).alias("text"),
    )
    row = annotate_links(df).select(
        F.size("links").alias("n"), F.length("content").alias("length"),
        F.element_at("links", -1).alias("last"),
    ).first()
    assert (row.n, row.length) == (100_000, 700_000)
    assert (row.last.char_start, row.last.char_end) == (699_996, 699_997)


def test_rendering_is_evaluated_once(spark):
    """A filter on the rendered text must not render a second time below."""
    df = annotate_links(spark.createDataFrame([(1, 0, "T", "x")], DUMP)).where("content like '%x%'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transl") == 1


def test_options_reach_the_text(texts):
    got = texts(["}} a {{ b"], lambda c: plain_wikitext(c, strict_depth=True), plain_wikitext)
    assert got == [(" b", " a ")]


@pytest.mark.parametrize(
    "text",
    [
        "[[File:open.png " + "[[a]] b " * 20_000,
        "[[File:x.png|" + "[[a]] " * 20_000 + "]]",
        "=" * 20_000 + " x",
        "== " + "= " * 20_000,
        "[http://x " * 5_000,
        "[[" * 20_000,
        "}}{{" * 10_000,
        "&" * 50_000 + "&lt;" * 10_000,
        "'" * 50_000,
        "{|" * 10_000 + "\n|" * 10_000,
        "<ref>" * 100_000,
        "<ref>" * 50_000 + "</ref>" + "<ref " * 50_000,
        "<!--" * 100_000,
        "-->" + "<!-- a " * 50_000,
        "<" * 200_000,
    ],
    ids=lambda t: t[:8],
)
def test_odd_pages_neither_fail_nor_hang(spark, text):
    df = spark.createDataFrame([(1, 0, "T", text)], DUMP)
    row = annotate_links(df).first()
    assert all(row.content[s.char_start : s.char_end] == s.surface for s in row.links)


@pytest.mark.parametrize("mark", ["<ref>", "<!--", "{{", "[[", "<", "[[a:", "[", ":[[", "{{a}} {{", "[[Category:", "]] : [["])
def test_time_grows_with_the_text(spark, mark):
    """A megabyte of a mark left open, in one line, takes seconds and not hours."""
    df = spark.createDataFrame([(1, 0, "T", mark * (1_000_000 // len(mark)))], DUMP)
    text = F.col("text")
    begun = time.time()
    annotate_links(df).select(F.length("content")).first()
    df.select(
        F.size(meta.categories(text)), F.size(meta.raw_links(text)), F.length(meta.plain_text_regex(text))
    ).first()
    assert time.time() - begun < 60


def test_headings(render):
    assert render("==A==\n=== b c ===  \n= d\n====\n= e=f =")[0] == "A\nb c\n= d\n====\ne=f"
