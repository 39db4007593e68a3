"""Redirect statistics over a `wiki_pages` table."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.joins import HOT_ROWS
from linkloom.operators.lineage import cut
from linkloom.operators.redirects import (
    follow_redirects,
    redirect_targets,
    title_map,
    with_titles,
)
from linkloom.functions.predicates import is_plain_title


class RedirectStats(NamedTuple):
    titles: DataFrame
    articles: DataFrame
    redirects: DataFrame
    loops: DataFrame
    unresolved: DataFrame


def collect_stats(wiki_pages: DataFrame, hot_rows: int | None = HOT_ROWS) -> RedirectStats:
    """Title map, article count, end point of each redirect, and the two audit lists."""
    titles = cut(title_map(wiki_pages), "titles")
    targets = cut(redirect_targets(wiki_pages, hot_rows, titles))
    resolved, looping = follow_redirects(targets.where("dst >= 0").select("src", "dst"), hot_rows)
    return RedirectStats(
        titles=titles,
        articles=titles.agg(F.count("*").alias("articles")),
        redirects=resolved,
        loops=with_titles(looping, wiki_pages),
        unresolved=targets.where(targets["dst"].isNull() & is_plain_title(targets["title"])).select(
            "src", "title"
        ),
    )
