"""Derived relations: normalized links, link counts, pages with their links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.joins import HOT_ROWS, hot_keys, salted_left_join, tiled_left_join

UNRESOLVED = -1


def _ids(pages: DataFrame) -> DataFrame:
    return pages.select("title", F.col("page_id").alias("link_id"))


def normalized_links(
    links: DataFrame,
    redirects: DataFrame,
    pages: DataFrame,
    resolve_id: str = "source",
    hot_rows: int | None = HOT_ROWS,
    by_link: bool = False,
) -> DataFrame:
    """Links with their title sent through one redirect, and the id of the page they name.

    `resolve_id="source"` looks the id up by the link's own title, so a link through a redirect
    normally gets -1. `"target"` looks up the title behind the redirect. A title that `redirects`
    or `pages` holds twice gives two rows, as the joins say. `by_link` (with `"source"`) gives the
    pages of a title as one row with an array `link_ids`, in order, in place of a row for each.
    """
    if resolve_id not in ("source", "target"):
        raise ValueError("resolve_id is 'source' or 'target'")
    unresolved = F.lit(UNRESOLVED)
    ids = _ids(pages)
    if by_link:
        if resolve_id != "source":
            raise ValueError("by_link needs resolve_id 'source'")
        each = F.collect_list(F.coalesce("link_id", unresolved))
        ids = ids.groupBy("title").agg(F.sort_array(each).alias("link_ids"))
        joined = salted_left_join(links, [redirects, ids], "title", hot_rows)
        link_id = F.coalesce("link_ids", F.array(unresolved)).alias("link_ids")
    else:
        # One lookup by title: redirects with the id of the page they or their target name, and
        # every page title that no redirect takes away. The links are joined once.
        key = "title" if resolve_id == "source" else "target"
        through = salted_left_join(redirects, [ids.withColumnRenamed("title", key)], key, hot_rows)
        direct = ids.join(redirects.select("title"), "title", "left_anti")
        lookup = through.select("title", "target", "link_id").unionByName(direct, allowMissingColumns=True)
        # Links to one title times the pages that answer to it: few rows may give many.
        joined = tiled_left_join(links, lookup, "title", hot_rows)
        link_id = F.coalesce("link_id", unresolved).alias("link_id")
    return joined.select(
        "page_id",
        "char_start",
        "char_end",
        "surface",
        F.coalesce("target", "title").alias("link"),
        link_id,
    )


def link_counts(normalized: DataFrame) -> DataFrame:
    """How often each surface points to each title; rows without a surface count 0."""
    return normalized.groupBy("surface", F.col("link").alias("title")).agg(
        F.count("surface").alias("n")
    )


def count_links(
    links: DataFrame,
    redirects: DataFrame,
    pages: DataFrame,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """`link_counts(normalized_links(links, redirects, pages))`, counted before it is joined.

    Links that share surface and title go through the joins as one row with a count, so a popular
    link costs a row per task and not a row per use. A title that several pages hold multiplies
    its links; the pages therefore enter as a number of copies per title.
    """
    hot = None if hot_rows is None else hot_keys(links, "title", hot_rows)
    counted = links.groupBy("surface", "title").agg(F.count("surface").alias("n"))
    copies = pages.groupBy("title").agg(F.count("*").alias("copies")).where("copies > 1")
    joined = salted_left_join(counted, [redirects, copies], "title", None, hot)
    return joined.groupBy("surface", F.coalesce("target", "title").alias("title")).agg(
        F.sum(F.col("n") * F.coalesce("copies", F.lit(1))).alias("n")
    )


def aggregate_pages(pages: DataFrame, normalized: DataFrame) -> DataFrame:
    """Pages that have links, with the links as four aligned arrays in text order.

    The links are grouped by `page_id` before the join, so no article text is grouped on;
    `page_id` is unique in `pages`. One page's links are one row of the result by definition, and
    were one row of the dump before. `normalized` may be that of `by_link`: a link then travels once
    with the pages of its title, and is multiplied in the row of its page. The join is a merge join:
    the planner guesses the arrays' size from files that do not hold them, and would broadcast them all.
    """

    def multiplied(x: Column) -> Column:
        start, end, link = (x[c].alias(c) for c in ("char_start", "char_end", "link"))
        return F.transform(x["link_ids"], lambda i: F.struct(start, end, link, i.alias("link_id")))

    if "link_ids" in normalized.columns:
        links = F.collect_list(F.struct("char_start", "char_end", "link", "link_ids"))
        links = F.flatten(F.transform(links, multiplied))
    else:
        links = F.collect_list(F.struct("char_start", "char_end", "link", "link_id"))
    spans = normalized.groupBy("page_id").agg(F.sort_array(links).alias("spans"))
    return pages.join(spans.hint("merge"), "page_id").select(
        *(pages[c] for c in pages.columns),
        F.col("spans.char_start").alias("char_starts"),
        F.col("spans.char_end").alias("char_ends"),
        F.col("spans.link").alias("links"),
        F.col("spans.link_id").alias("link_ids"),
    )
