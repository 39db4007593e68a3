import pytest

from linkloom import schemas
from linkloom.plans.extract import extract, stage_relations, write_relations
from linkloom.plans.preview import preview

PAGES = [
    (1, 0, "anarchism", "An [[idea_x|idea]] {{t}} [[Category:Ideas|x]]"),
    (2, 0, "old_name", "#REDIRECT [[anarchism#Top]] {{R}}"),
    (3, 14, "Category:C", "see [[x]] [[Category:D]]"),
    (4, 0, "Name (disambiguation)", "no link"),
    (5, 0, "Empty", None),
    (6, 0, "Broken", "#REDIRECT nowhere"),
]


@pytest.fixture
def dump(spark):
    return spark.createDataFrame(PAGES, schemas.DUMP)


def rows(df, key="page_id"):
    return [tuple(r) for r in df.orderBy(key).collect()]


PAGE_ROWS = [
    (1, "Anarchism", "An  idea   ", False, ["Ideas"]),
    (3, "Category:C", "", False, ["D"]),
    (4, "Name (disambiguation)", "no link", True, []),
    (5, "Empty", "", False, []),
    (6, "Broken", "REDIRECT nowhere", False, []),
]


def test_extract(dump):
    pages, links, redirects = extract(dump)
    assert rows(pages) == PAGE_ROWS
    assert rows(links) == [(1, 4, 8, "idea", "Idea x")]
    assert rows(redirects, "title") == [("Old name", "Anarchism#Top")]


def test_options(dump):
    pages, links, redirects = extract(dump, main_only=True, strip_fragment=True, with_links=False)
    assert [r[0] for r in rows(pages)] == [1, 4, 5, 6]
    assert links.count() == 0
    assert rows(redirects, "title") == [("Old name", "Anarchism")]


def test_write_relations(dump, tmp_path):
    stored = write_relations(dump, str(tmp_path))
    for got, wanted in zip(stored, extract(dump)):
        assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
    assert rows(stored.pages) == PAGE_ROWS


def test_staged_views_read_their_columns_only(dump, tmp_path):
    staged = stage_relations(dump, str(tmp_path))
    for got, wanted in zip(staged, extract(dump)):
        assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
    plan = staged.links._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :]
    assert "links" in schema and "content" not in schema
    assert "PushedFilters: [Not" in plan or "PushedFilters: [IsNotNull(is_redirect)" in plan


def test_schemas(dump):
    pages, links, redirects = extract(dump)
    for df, wanted in ((pages, schemas.PAGES), (links, schemas.LINKS), (redirects, schemas.REDIRECTS)):
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
            (f.name, f.dataType.simpleString()) for f in wanted
        ]


def test_extraction_does_not_shuffle(dump):
    for df in extract(dump):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_caller_functions(dump):
    """The per-page and per-link callbacks of a dump reader are plain frame functions here."""
    longest = extract(dump).pages.transform(lambda df: df.selectExpr("max(length(content)) as n"))
    assert longest.first().n == 16
    per_link = extract(dump).links.transform(lambda df: df.selectExpr("upper(surface) as s"))
    assert per_link.first().s == "IDEA"


def test_preview(spark):
    many = " ".join(f"[[l{i}]]" for i in range(60)) + "[[Category:A]][[Category:B]][[Category:C]]"
    df = spark.createDataFrame([(1, 0, "t", "  " + many), (2, 0, "r", "#REDIRECT [[x]]")], schemas.DUMP)
    first, second = preview(df).orderBy("page_id").collect()
    assert first.surfaces == ["l0", "l1"] and first.categories == ["A", "B"]
    assert len(first.text) == 100 and first.text.startswith("l0") and first.text.endswith("...")
    assert tuple(second) == (2, "R", "X", None, None, None)
