import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions import meta, predicates
from linkloom.functions.entities import decode_entities, named_entities
from linkloom.functions.literals import (
    from_array_literal,
    from_int_array_literal,
    to_array_literal,
    to_int_array_literal,
)
from linkloom.functions.scan import holds, replace_marked, running_total, scan
from linkloom.functions.titles import (
    abbreviate,
    bracketed_target,
    normalize_title,
    wikilink_title,
)


def test_wikilink_title(texts):
    given = [None, "", "foo_bar", " foo", "Éa", "éa", "ß_x", "1_a", "_a", "ABC"]
    wanted = [None, "", "Foo bar", " foo", "Éa", "Éa", "SS x", "1 a", " a", "ABC"]
    assert texts(given, wikilink_title) == wanted


def test_normalize_title(texts):
    given = [None, "", " foo ", "\tfoo_bar\n", "éa", "ßa", "Ab"]
    wanted = [None, "", "Foo", "Foo bar", "Éa", "ßa", "Ab"]
    assert texts(given, normalize_title) == wanted


def test_bracketed_target(texts):
    given = ["#redirect [[a#b]] [[c]]", "no", "[[]] [[x]]", "[[a]b]] [[c]]", None]
    assert texts(given, bracketed_target) == ["a#b", None, "x", "c", None]


def test_abbreviate(texts):
    given = ["a" * 100, "a" * 101, None]
    assert texts(given, abbreviate) == ["a" * 100, "a" * 97 + "...", None]


def test_special_title(texts):
    given = ["Talk:X", ":X", "Foo: bar", "X", None, "", "Book:X", "User_talk:a:b"]
    assert texts(given, predicates.is_special_title) == [
        True, True, False, False, False, False, False, True,
    ]
    assert texts(["Book:X", "Boo:X"], lambda c: predicates.is_special_title(c, ["Book", None])) == [
        True, False,
    ]


def test_link_filter(texts):
    given = ["X", "Talk:X", "User_talk:X", "User talk:X", "Foo:X", "fr:X"]
    assert texts(given, predicates.is_entity_link) == [True, False, False, False, True, True]


def test_text_and_namespace_filters(spark):
    rows = [(0, "x"), (14, "x"), (10, "x"), (0, ""), (0, None)]
    df = spark.createDataFrame(rows, "ns int, t string")
    got = df.select(
        predicates.is_main(df.ns),
        predicates.has_text(df.t),
        predicates.is_content_page(df.ns, df.t),
        predicates.is_noncontent_page(df.ns, df.t, F.lit(False), F.lit(False)),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True, False),
        (False, True, True, True),
        (False, True, False, True),
        (True, False, False, False),
        (True, False, False, True),
    ]


def test_redirect(texts):
    given = [
        "#REDIRECT [[A]]", "#redirect [[a_b#S]]", " #REDIRECT [[A]]", "#REDIRECT nothing",
        "#REDIRECT [[]]", "#RED", None, "#Redirect:\n[[x\ny]]",
    ]
    assert texts(given, meta.is_redirect, meta.redirect_target) == [
        (True, "A"), (True, "A b#S"), (False, None), (False, None),
        (False, None), (False, None), (False, None), (True, "X\ny"),
    ]
    assert texts(["#redirect [[a_b#S]]"], lambda c: meta.redirect_target(c, True)) == ["A b"]


def test_redirect_row(spark):
    rows = [(None, "#REDIRECT x"), ("h", "#redirect"), (None, "#redirec"), (None, None)]
    df = spark.createDataFrame(rows, "h string, m string")
    assert df.where(predicates.is_redirect_row(df.h, df.m)).count() == 1


def test_disambiguation_and_stub(texts):
    disamb = lambda c: meta.is_disambiguation(F.lit("T"), c)
    given = ["{{Dab}}", "{{dAB|x}}", "{{DABx}}", "{{disambiguation}}", "{{dab }}", None]
    assert texts(given, disamb) == [True, True, False, True, False, False]
    titled = lambda c: meta.is_disambiguation(F.lit("X (disambiguation)"), c)
    assert texts(["", None], titled) == [True, False]
    assert texts(["{{x-stub}}", "{{stub}}", None], meta.is_stub) == [True, False, False]


def test_categories_and_raw_links(texts):
    given = [
        "[[Category:A|b]] [[Category:|z]] [[Category:|]] [[Category:]] [[A]] [[x|y]] [[|q]]",
        "[[Category:A\nB]]",
        None,
    ]
    assert texts(given, meta.categories) == [["A", "z"], [], []]
    assert texts(given, meta.raw_links) == [["A", "x", "q"], [], []]


def test_translated_title(texts):
    given = ["a\n[[fr:Un]]\n[[fr:Deux]]", "x [[fr:Un]]", "[[fr:]]", None]
    assert texts(given, lambda c: meta.translated_title(c, "fr")) == ["Un", None, "", None]


def test_plain_text_regex_is_the_plain_chain(texts):
    """The linear form of the piped-word step gives what the ten replacements give."""

    def chain(c):
        out = F.coalesce(c, F.lit(""))
        for pattern, replacement in meta.PLAIN_TEXT_STEPS:
            out = F.regexp_replace(out, pattern, replacement)
        return out

    rng = random.Random(5)
    pieces = [" ", "|", "\n", "a", "bc", "d ", "|e ", "|f\n", "[[", "]]", "{{", "}}", ":", "<", ">",
              "'", "\r", "[", "]", "&lt;", "\t", "|g"]
    given = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(3000)]
    given += [None, "", "a b|c d", "x|y\nc d|e f", " \n|a \n b|c\n"]
    got = texts(given, meta.plain_text_regex, chain)
    assert [g for g, _ in got] == [w for _, w in got]


def test_plain_text_regex_is_linear(spark):
    df = spark.range(1).select(F.repeat(F.lit("word "), 400_000).alias("t"))
    df = df.select(F.concat("t", F.lit("|end x")).alias("t")).union(df)
    got = df.select(F.length(meta.plain_text_regex(F.col("t"))).alias("n")).collect()
    assert sorted(r["n"] for r in got) == [len(" end x") + 4, 2_000_000]


def test_entities(texts):
    given = ["&lt;a&gt; &amp;lt; &#233;&#x1F600;&eacute; &bogus; &; A&B &#0; &#xD800; &Omega;", None]
    assert texts(given, decode_entities) == [
        "<a> &lt; é😀é &bogus; &; A&B &#0; &#xD800; Ω", None,
    ]
    assert named_entities()["yuml"] == "ÿ"
    assert named_entities()["omega"] == "ω"


def test_array_literals(spark):
    rows = [(["a", 'b"c', "d\\e", "f,g", "h\ni", ""], [1, -2]), ([], []), (None, None)]
    df = spark.createDataFrame(rows, "s array<string>, n array<int>")
    got = df.select(
        to_array_literal(df.s).alias("s"), to_int_array_literal(df.n).alias("n")
    )
    assert got.collect()[0]["n"] == "{1,-2}"
    assert got.collect()[0]["s"] == '{"a","b\\"c","d\\\\e","f,g","h\ni",""}'
    back = got.select(from_array_literal("s"), from_int_array_literal("n"))
    assert [tuple(r) for r in back.collect()] == rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 10, 17, 100, 1001])
def test_running_total(spark, n):
    values = [random.Random(n).randint(0, 9) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "a array<int>")
    assert df.select(running_total(df.a)).first()[0] == [sum(values[:i]) for i in range(n)]


def test_scan_emits_from_the_state_before(spark):
    df = spark.createDataFrame([(list("abcdefg"),)], "a array<string>")
    joined = scan(df.a, F.lit(""), F.concat, lambda s, x: F.concat(s, F.lit("|"), x), "string")
    assert df.select(joined).first()[0][-1] == "abcdef|g"


def test_all_names_and_any_number_of_digits(texts):
    assert len(named_entities()) == 252
    given = ["&forall;&part;&sum;&empty;&rArr;&hearts;&thetasym;", "&#00000233;&#x00000e9;&#X1F600;", "&#99999999999999999999;&#x110000;&#xd800;&nosuchname;"]
    assert texts(given, decode_entities) == ["∀∂∑∅⇒♥ϑ", "éé😀", given[2]]


def test_a_pattern_is_searched_where_a_literal_is(texts):
    """The same text, whether a literal of the pattern is there or not."""
    found = texts(["a=b", "ab", "", None], lambda c: replace_marked(c, "(=+)|b", "-$1", "=", "!"), lambda c: holds(c, "a", "!"))
    assert found == [("a-=-", True), ("ab", True), ("", False), (None, None)]
