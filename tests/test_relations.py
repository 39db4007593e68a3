from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.plans.relations import aggregate_pages, count_links, link_counts, normalized_links


@pytest.fixture
def relations(spark):
    links = [
        (1, 0, 1, "a", "Moved"), (1, 2, 3, "a", "Page"), (1, 4, 5, "b", "Both"),
        (1, 6, 7, "c", "Neither"), (2, 0, 1, "d", "Twice"), (2, 2, 3, "e", None),
        (2, 4, 5, None, "Page"), (2, 6, 7, "a", "Page"), (2, 8, 9, "f", "To page"),
    ]
    pages = [
        (1, "Page", "p", False, ["x"]), (2, "Both", "q", True, []), (3, "Twice", "r", False, []),
        (4, "Twice", "s", False, []),
    ]
    redirects = [("Moved", "Gone"), ("Both", "Else"), ("To page", "Page")]
    return (
        spark.createDataFrame(links, schemas.LINKS),
        spark.createDataFrame(redirects, schemas.REDIRECTS),
        spark.createDataFrame(pages, schemas.PAGES),
    )


def found(df):
    return Counter((r.page_id, r.char_start, r.link, r.link_id) for r in df.collect())


COMMON = {
    (1, 0, "Gone", -1): 1, (1, 2, "Page", 1): 1, (1, 6, "Neither", -1): 1, (2, 0, "Twice", 3): 1,
    (2, 0, "Twice", 4): 1, (2, 2, None, -1): 1, (2, 4, "Page", 1): 1, (2, 6, "Page", 1): 1,
}


@pytest.mark.parametrize("hot_rows", [1, 2, None])
def test_id_of_the_links_own_title(relations, hot_rows):
    got = found(normalized_links(*relations, hot_rows=hot_rows))
    assert got == Counter({**COMMON, (1, 4, "Else", 2): 1, (2, 8, "Page", -1): 1})


@pytest.mark.parametrize("hot_rows", [1, 2, None])
def test_id_behind_the_redirect(relations, hot_rows):
    got = found(normalized_links(*relations, resolve_id="target", hot_rows=hot_rows))
    assert got == Counter({**COMMON, (1, 4, "Else", -1): 1, (2, 8, "Page", 1): 1})


def test_unknown_mode(relations):
    with pytest.raises(ValueError):
        normalized_links(*relations, resolve_id="else")


COUNTS = {
    ("a", "Gone"): 1, ("a", "Page"): 2, ("b", "Else"): 1, ("c", "Neither"): 1, ("d", "Twice"): 2,
    ("e", None): 1, (None, "Page"): 0, ("f", "Page"): 1,
}


def test_link_counts(relations):
    got = link_counts(normalized_links(*relations)).collect()
    assert {(r.surface, r.title): r.n for r in got} == COUNTS
    assert len(got) == len(COUNTS)


@pytest.mark.parametrize("hot_rows", [1, None])
def test_counting_before_the_join_is_the_same(relations, hot_rows):
    got = count_links(*relations, hot_rows=hot_rows).collect()
    assert {(r.surface, r.title): r.n for r in got} == COUNTS
    assert len(got) == len(COUNTS)


def test_aggregate_pages(spark, relations):
    links, redirects, pages = relations
    normalized = normalized_links(links.orderBy(F.desc("char_start")), redirects, pages)
    got = {r.page_id: r for r in aggregate_pages(pages, normalized).collect()}
    assert set(got) == {1, 2}
    assert got[1].char_starts == [0, 2, 4, 6]
    assert got[1].links == ["Gone", "Page", "Else", "Neither"]
    assert got[1].link_ids == [-1, 1, 2, -1]
    assert (got[1].title, got[1].categories) == ("Page", ["x"])
    # The title held twice gives two entries; a NULL title stays in line.
    assert got[2].char_starts == [0, 0, 2, 4, 6, 8]
    assert got[2].links == ["Twice", "Twice", None, "Page", "Page", "Page"]
    for row in got.values():
        lengths = {len(row[c]) for c in ("char_starts", "char_ends", "links", "link_ids")}
        assert len(lengths) == 1


def test_pages_give_two_columns_to_the_link_join(spark, relations, tmp_path):
    links, redirects, pages = relations
    path = str(tmp_path / "pages")
    pages.write.parquet(path)
    df = normalized_links(links, redirects, spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,title:string>" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("hot_rows", [1, None])
def test_pages_of_a_title_travel_as_an_array(relations, hot_rows):
    links, redirects, pages = relations
    pages = pages.unionByName(pages.where("page_id = 1").withColumn("page_id", F.lit(None).cast("long")))
    plain = normalized_links(links, redirects, pages, hot_rows=hot_rows)
    grouped = normalized_links(links, redirects, pages, hot_rows=hot_rows, by_link=True)
    assert grouped.count() == links.count() < plain.count()
    rows = [sorted(map(str, aggregate_pages(pages, x).collect())) for x in (plain, grouped)]
    assert rows[0] == rows[1]
    with pytest.raises(ValueError):
        normalized_links(*relations, resolve_id="target", by_link=True)


@pytest.mark.parametrize("by_link", [False, True])
def test_link_arrays_are_never_broadcast(spark, relations, tmp_path, by_link):
    links, redirects, pages = relations
    for name, df in (("links", links), ("pages", pages)):
        df.write.parquet(str(tmp_path / name))
    links, pages = (spark.read.parquet(str(tmp_path / name)) for name in ("links", "pages"))
    normalized = normalized_links(links, redirects, pages, by_link=by_link)
    plan = aggregate_pages(pages, normalized)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [page_id" in plan
    assert "BroadcastHashJoin [page_id" not in plan


@pytest.mark.parametrize("resolve_id", ["source", "target"])
def test_few_links_and_pages_that_give_many_rows_are_spread(spark, resolve_id):
    links = [(i, 0, 1, "a", "Many") for i in range(400)] + [(i, 2, 3, "b", "To many") for i in range(100)]
    links = spark.createDataFrame(links, schemas.LINKS)
    redirects = spark.createDataFrame([("To many", "Many")], schemas.REDIRECTS)
    pages = spark.createDataFrame([(i, "Many", "c", False, []) for i in range(200)], schemas.PAGES)
    got = normalized_links(links, redirects, pages, resolve_id, hot_rows=1_000)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == (80_100 if resolve_id == "source" else 100_000)
    assert max(sizes) < sum(sizes) / 5
    assert got.where("link = 'Many'").select("page_id", "char_start", "link_id").distinct().count() == sum(sizes)
