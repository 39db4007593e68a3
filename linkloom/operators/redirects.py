"""Redirect graphs over page ids: edges from wikitext, end points, loops."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.predicates import is_plain_title, is_redirect_row
from linkloom.functions.titles import bracketed_target, normalize_title
from linkloom.operators.joins import HOT_ROWS, salted_left_join
from linkloom.operators.lineage import cut, discard, scratch_path, stored


def title_map(wiki_pages: DataFrame) -> DataFrame:
    """`(title, id)` with one row per normalized title; of several ids the smallest counts."""
    return wiki_pages.groupBy(normalize_title(F.col("title")).alias("title")).agg(
        F.min("id").alias("id")
    )


def article_count(wiki_pages: DataFrame) -> DataFrame:
    """The number of distinct normalized titles, as one row `(articles)`."""
    return title_map(wiki_pages).agg(F.count("*").alias("articles"))


def redirect_targets(
    wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS, titles: DataFrame | None = None
) -> DataFrame:
    """`(src, title, dst)` for each redirect row: its target title, and the id if there is one.

    Rows that name no target are left out. `titles` is the `title_map`, if it is there already.
    """
    target = bracketed_target(F.col("mediawiki"))
    rows = wiki_pages.where(
        is_redirect_row(F.col("html"), F.col("mediawiki")) & target.isNotNull()
    ).select(F.col("id").alias("src"), normalize_title(target).alias("title"))
    # Stored, so that looking for hot targets does not read the wikitext again.
    rows = cut(rows, "targets")
    ids = (title_map(wiki_pages) if titles is None else titles).withColumnRenamed("id", "dst")
    joined = salted_left_join(rows, [ids], "title", hot_rows)
    return joined.select("src", "title", "dst")


def redirect_edges(wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`(src, dst)` for each redirect whose target title has an id."""
    return redirect_targets(wiki_pages, hot_rows).where("dst >= 0").select("src", "dst")


def unresolved_redirects(wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`(src, title)` for each redirect to a title that has no id.

    Targets inside a page or in a namespace are not reported.
    """
    return (
        redirect_targets(wiki_pages, hot_rows)
        .where(F.col("dst").isNull() & is_plain_title(F.col("title")))
        .select("src", "title")
    )


class Closure(NamedTuple):
    resolved: DataFrame
    looping: DataFrame
    rounds: list[tuple[int, int]]


def close_redirects(edges: DataFrame, hot_rows: int | None = HOT_ROWS) -> Closure:
    """End points `(src, dst)`, edges `(src, dst)` of sources that run into a loop, sizes of rounds.

    `dst` of a resolved row is the last id of the chain. `src` must be unique.

    Each round replaces every open pointer by the pointer of the row it points to, so a chain of
    n hops takes about log2(n) rounds. A source d hops from its end settles by round log2(d); if
    any open source is going to settle, one does so in the very next round, so a round that
    settles nothing has only sources on loops left.

    A round reads the open rows and the pointers they ask for, and nothing else: what an open row
    asks for next is the pointer of what it asks for now, so pointers that no open row asks for
    are never asked for again. Settled rows are added to the result at once. Each round is stored
    before the next one reads it, and the round before is removed.
    """
    spark = edges.sparkSession
    result = scratch_path(spark, "resolved")
    first = scratch_path(spark, "edges")
    edges = stored(edges.select("src", "dst"), first)
    sources = edges.select(F.col("src").alias("dst"), F.lit(True).alias("is_source"))
    salt = lambda rows: hot_rows if hot_rows is not None and rows > hot_rows else None
    path = scratch_path(spark, "round")
    rows = stored(
        salted_left_join(edges, [sources], "dst", salt(edges.count())).select(
            "src", "dst", F.col("is_source").isNull().alias("settled")
        ),
        path,
    )
    settled = stored(rows.where("settled").select("src", "dst"), result)
    pointers, old = rows, [path]
    open_rows, rounds = rows.where("NOT settled"), []
    left = open_rows.count()
    while left:
        asked = open_rows.select(F.col("dst").alias("src")).distinct()
        kept, path = scratch_path(spark, "pointers"), scratch_path(spark, "round")
        pointers = stored(pointers.join(asked, "src", "left_semi"), kept)
        rounds.append((left, pointers.count()))
        target = pointers.select(F.col("src").alias("dst"), F.col("dst").alias("next"), "settled")
        rows = stored(
            salted_left_join(open_rows.select("src", "dst"), [target], "dst", salt(left)).select(
                "src", F.col("next").alias("dst"), "settled"
            ),
            path,
        )
        settled = stored(rows.where("settled").select("src", "dst"), result)
        # Pointers asked for in this round: settled ones as they are, open ones one round on.
        pointers = pointers.where("settled").unionByName(rows)
        open_rows = rows.where("NOT settled")
        before, left = left, open_rows.count()
        for done in old:
            discard(spark, done)
        old = [kept, path]
        if left == before:
            break
    loops = scratch_path(spark, "loops")
    looping = stored(edges.join(open_rows.select("src"), "src", "left_semi"), loops)
    for done in [*old, first]:
        discard(spark, done)
    return Closure(settled, looping, rounds)


def follow_redirects(
    edges: DataFrame, hot_rows: int | None = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Split the sources of `edges(src, dst)` into those with an end point and those without.

    The first frame is `(src, dst)` with `dst` the last id of the chain; the second holds the
    sources, as `(src)`, whose chain runs into a loop. `src` must be unique.
    """
    found = close_redirects(edges, hot_rows)
    return found.resolved, found.looping.select("src")


def resolve_redirects(edges: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`(src, dst)` with the end point of each source; sources that run into a loop are left out."""
    return close_redirects(edges, hot_rows).resolved


def label_loops(looping: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`(src, loop_id, on_loop, place)` for edges `(src, dst)` of which every chain runs into a loop.

    A loop is named by its smallest id, which has place 0; the others follow in the order of the
    edges. Sources that only lead to a loop have no place.

    First pointers double until the ids they point to get no fewer: these are the loops. Then, on
    the loops alone, each id learns the smallest id within 2, 4, 8 ... steps and its distance,
    until nothing changes. Each round is stored, and the round before is removed.
    """
    spark = looping.sparkSession
    salt = lambda rows: hot_rows if hot_rows is not None and rows > hot_rows else None
    path = scratch_path(spark, "ahead")
    ahead = stored(looping.select("src", "dst"), path)
    rows = ahead.count()
    ends, before = ahead.select("dst").distinct().count(), -1
    while ends != before:
        hop = ahead.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
        new = scratch_path(spark, "ahead")
        ahead = stored(
            salted_left_join(ahead, [hop], "dst", salt(rows)).select("src", F.col("next").alias("dst")), new
        )
        discard(spark, path)
        path = new
        ends, before = ahead.select("dst").distinct().count(), ends
    members = ahead.select(F.col("dst").alias("src")).distinct()
    # On a loop every id has one pointer and is pointed to once: no key is hot.
    near_path = scratch_path(spark, "near")
    near = stored(
        looping.join(members, "src", "left_semi").select("src", "dst", F.col("src").alias("least"), F.lit(0).cast("bigint").alias("steps")),
        near_path,
    )
    span, changed = 1, 1
    while changed:
        other = near.select(
            F.col("src").alias("dst"), F.col("dst").alias("next"), F.col("least").alias("_least"), F.col("steps").alias("_steps")
        )
        less = F.col("_least") < F.col("least")
        new = scratch_path(spark, "near")
        near = stored(
            near.drop("changed").join(other, "dst").select(
                "src",
                F.col("next").alias("dst"),
                F.least("least", "_least").alias("least"),
                F.when(less, F.col("_steps") + span).otherwise(F.col("steps")).alias("steps"),
                less.alias("changed"),
            ),
            new,
        )
        discard(spark, near_path)
        near_path = new
        span, changed = span * 2, near.where("changed").count()
    sizes = near.groupBy("least").agg(F.count("*").alias("size"))
    on = near.join(sizes, "least").select(
        "src", F.col("least").alias("loop_id"), F.pmod(F.col("size") - F.col("steps"), F.col("size")).alias("place")
    )
    ways = salted_left_join(ahead, [on.select(F.col("src").alias("dst"), "loop_id")], "dst", salt(rows))
    labels = cut(
        ways.join(on.select("src", "place"), "src", "left").select(
            "src", "loop_id", F.col("place").isNotNull().alias("on_loop"), "place"
        ),
        "labels",
    )
    for done in (path, near_path):
        discard(spark, done)
    return labels


def with_titles(ids: DataFrame, wiki_pages: DataFrame) -> DataFrame:
    """Add the normalized title of each `src`."""
    titles = wiki_pages.select(
        F.col("id").alias("src"), normalize_title(F.col("title")).alias("title")
    )
    return ids.join(titles, "src", "left").select(*ids.columns, "title")


def loop_titles(labels: DataFrame, wiki_pages: DataFrame) -> DataFrame:
    """`(loop_id, loop_titles)`: the titles of each loop's members, in the order of the edges.

    A loop's titles are one row, as a report has them; `label_loops` has them one by one.
    """
    named = with_titles(labels.where("on_loop").select("src", "loop_id", "place"), wiki_pages)
    title = F.coalesce("title", F.lit(""))
    return named.groupBy("loop_id").agg(
        F.array_sort(F.collect_list(F.struct("place", title.alias("title")))).alias("_members")
    ).select("loop_id", F.col("_members.title").alias("loop_titles"))


def redirect_loops(
    edges: DataFrame, wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """`(src, title)` for each source that runs into a loop."""
    return with_titles(follow_redirects(edges, hot_rows)[1], wiki_pages)


def redirect_loop_members(
    edges: DataFrame, wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """`(src, loop_id, on_loop, loop_titles)` for each source that runs into a loop."""
    labels = label_loops(close_redirects(edges, hot_rows).looping, hot_rows)
    reports = loop_titles(labels, wiki_pages)
    return salted_left_join(labels, [reports], "loop_id", hot_rows).select("src", "loop_id", "on_loop", "loop_titles")
