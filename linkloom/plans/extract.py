"""A dump's three relations: pages, links and redirects."""

from collections.abc import Callable
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import meta
from linkloom.functions.titles import wikilink_title
from linkloom.operators.annotate import CATEGORY_NAMES, IMAGE_NAMES, annotate_links
from linkloom.sinks.tables import save_parquet, write_csv
from linkloom.sources.dump import count_while_reading, namespace_names, read_dump

# The keys of the file and the category namespace on every site.
MEDIA_KEYS = (6, 14)
SITE_NAMES, MEDIA, NUMBER = "_site_names", "_media_names", "number"


class Relations(NamedTuple):
    pages: DataFrame
    links: DataFrame
    redirects: DataFrame


def page_meta(dump: DataFrame, strip_fragment: bool = False) -> DataFrame:
    """Add the metadata columns to dump pages `(id, ns, title, text)`."""
    text = F.col("text")
    return dump.withColumns(
        {
            "is_redirect": meta.is_redirect(text),
            "redirect_target": meta.redirect_target(text, strip_fragment),
            "is_stub": meta.is_stub(text),
            "disamb": meta.is_disambiguation(F.col("title"), text),
            "categories": meta.categories(text),
        }
    )


def annotate_dump(
    dump: DataFrame,
    main_only: bool = False,
    strip_fragment: bool = False,
    namespaces: DataFrame | None = None,
    **rules: Any,
) -> DataFrame:
    """One row per page with everything the three relations need; one pass and no shuffle.

    A redirect's text is not rendered. `rules` are the options of `annotate_links`. `namespaces`, as
    `read_namespaces` gives them, sets two of these: titles in the site's namespaces are special,
    and links to its file and category namespaces render nothing, whatever their language. A
    `number`, as `number_pages` gives it, is kept.
    """
    pages = dump.where("ns = 0") if main_only else dump
    if namespaces is not None:
        # Columns of each page: a subquery can't stand inside the functions that render.
        pages = pages.withColumns(
            {SITE_NAMES: namespace_names(namespaces), MEDIA: namespace_names(namespaces, MEDIA_KEYS)}
        )
        end = r"\E"
        quoted = F.transform(
            MEDIA, lambda n: F.concat(F.lit(r"\Q"), F.replace(n, F.lit(end), F.lit(r"\E\\E\Q")), F.lit(end))
        )
        known = F.array(*map(F.lit, (*IMAGE_NAMES, *CATEGORY_NAMES)))
        rules = {
            "site_names": F.col(SITE_NAMES),
            "media_names": F.array_join(F.concat(known, quoted), "|"),
            **rules,
        }
    pages = page_meta(pages, strip_fragment)
    # Rendering starts from '' for redirects.
    pages = pages.withColumn("text", F.when(~F.col("is_redirect"), F.col("text")))
    return annotate_links(pages, **rules).select(
        F.col("id").alias("page_id"),
        wikilink_title(F.col("title")).alias("title"),
        "is_redirect",
        "redirect_target",
        "content",
        "disamb",
        "categories",
        "links",
        *(c for c in dump.columns if c == NUMBER),
    )


def exploded_links(annotated: DataFrame) -> DataFrame:
    """One row per link of each page; pages without links give none."""
    link: Column = F.col("link")
    # `explode` would push a size test of the array, and with it a second rendering, to the scan.
    number = [c for c in annotated.columns if c == NUMBER]
    rows = annotated.select("page_id", *number, F.explode_outer("links").alias("link"))
    return rows.where(link.isNotNull()).select(
        "page_id",
        link["char_start"].alias("char_start"),
        link["char_end"].alias("char_end"),
        link["surface"].alias("surface"),
        wikilink_title(link["link"]).alias("title"),
        *number,
    )


def split_relations(annotated: DataFrame) -> Relations:
    """Redirects to one relation; every other page to `pages`, its links to `links`.

    Pages with a `number` give it to their rows.
    """
    number = [c for c in annotated.columns if c == NUMBER]
    articles = annotated.where(~F.col("is_redirect"))
    return Relations(
        pages=articles.select("page_id", "title", "content", "disamb", "categories", *number),
        links=exploded_links(articles),
        redirects=annotated.where("is_redirect").select(
            "title", F.col("redirect_target").alias("target"), *number
        ),
    )


def extract(dump: DataFrame, **options: Any) -> Relations:
    """The three relations of a dump. Each one reads the dump when it is used."""
    return split_relations(annotate_dump(dump, **options))


def stage_relations(dump: DataFrame, path: str, mode: str = "error", **options: Any) -> Relations:
    """The three relations as views of one stored table, `path`/annotated.

    The dump is parsed and rendered once, and the text is written once; a view reads only the
    columns it needs.
    """
    staged = f"{path}/annotated"
    annotated = annotate_dump(dump, **options)
    save_parquet(annotated, staged, mode)
    return split_relations(dump.sparkSession.read.schema(annotated.schema).parquet(staged))


def write_relations(dump: DataFrame, path: str, mode: str = "error", **options: Any) -> Relations:
    """Write the three relations under `path` as Parquet, one folder each, and read them back.

    They are written from the staged table, so that three outputs do not render the dump thrice.
    """
    spark = dump.sparkSession
    for name, df in stage_relations(dump, path, mode, **options)._asdict().items():
        save_parquet(df, f"{path}/{name}", mode)
    return Relations(*(spark.read.parquet(f"{path}/{name}") for name in Relations._fields))


def write_dump(
    spark: SparkSession, dump: str, path: str, mode: str = "error", **options: Any
) -> tuple[Relations, dict[str, int]]:
    """`write_relations` of the dump stored at `dump`, and how many pages it has and how many are corrupt.

    The counts are taken while the pages are rendered; the dump is read once.
    """
    pages, seen = count_while_reading(read_dump(spark, dump, keep_corrupt=True))
    relations = write_relations(pages, path, mode, **options)
    return relations, seen.get


def write_chunks(relations: Relations, path: str, chunks: int = 10, mode: str = "error") -> None:
    """Write numbered relations as CSV, each into folders `chunk=0`, `chunk=1`, ... by page number.

    A page's rows are in the chunk of its number modulo `chunks`. Nothing is shuffled.
    """
    for name, df in relations._asdict().items():
        chunk = F.pmod(F.col(NUMBER), F.lit(chunks)).cast("int").alias("chunk")
        write_csv(df.select("*", chunk).drop(NUMBER), f"{path}/{name}", mode=mode, by="chunk")


def each_page(
    annotated: DataFrame, callback: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Call `callback` on Arrow batches of pages, as `annotate_dump` gives them, for rows of `schema`.

    The batches are those of the scan; the callback sees every page once, whole, with its links.
    """
    return annotated.mapInArrow(lambda batches: map(callback, batches), schema)
