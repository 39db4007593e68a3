"""Registered queries: name -> function of the session and the data folder."""

import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.catalog import inputs
from linkloom.functions import meta, predicates
from linkloom.functions.literals import to_array_literal, to_int_array_literal
from linkloom.functions.scan import replace_held
from linkloom.functions.titles import normalize_title, wikilink_title
from linkloom.operators import redirects
from linkloom.operators.annotate import annotate_links
from linkloom.operators.lineage import cut, scratch_path
from linkloom.operators.spread import spread
from linkloom.plans import extract, preview, relations
from linkloom.plans.stats import collect_stats
from linkloom.sinks import tables as sinks
from linkloom.sources import dump as dumps
from linkloom.sources import tables as sources

Query = Callable[[SparkSession, str], DataFrame]


def _web(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, redirects and entities of the web pages. The page source is read once."""
    parsed = cut(inputs.web_parsed(spread(inputs.table(spark, sf_dir, "pages"), "page_id")))
    links = inputs.web_links(parsed)
    return links, inputs.web_redirects(links), inputs.web_entities(parsed)


def _dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.wikitext(spread(inputs.table(spark, sf_dir, "documents"), "doc_id"))


def _wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, as `wiki_pages` is: whoever needs titles only does not read the text."""
    return cut(inputs.wiki_pages(_dump(spark, sf_dir)))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.selectExpr(*inputs.select_list(inputs.WIKITEXT)).select("id", "title")


def _array_text(df: DataFrame) -> DataFrame:
    """Array columns as array literals, the form they have in CSV."""
    for field in df.schema:
        kind = field.dataType.simpleString()
        if kind == "array<string>":
            df = df.withColumn(field.name, to_array_literal(F.col(field.name)))
        elif kind.startswith("array"):
            df = df.withColumn(field.name, to_int_array_literal(F.col(field.name)))
    return df


# Web pages: derived relations


def normalized_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, moved, entities = _web(spark, sf_dir)
    return relations.normalized_links(links, moved, entities)


def normalized_links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, moved, entities = _web(spark, sf_dir)
    return relations.normalized_links(links, moved, entities, "target")


def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, moved, entities = _web(spark, sf_dir)
    return relations.count_links(links, moved, entities)


def link_counts_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.link_counts(normalized_links(spark, sf_dir))


def aggregate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.web_pages(inputs.table(spark, sf_dir, "pages"))
    links, moved, entities = _web(spark, sf_dir)
    # Many pages answer to one title: their ids travel as arrays.
    normalized = relations.normalized_links(links, moved, entities, by_link=True)
    return _array_text(relations.aggregate_pages(pages, normalized))


def normalized_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = F.col("href")
    parsed = inputs.web_parsed(spread(inputs.table(spark, sf_dir, "pages"), "page_id"))
    return inputs.web_anchors(parsed).select(
        "page_id",
        "char_start",
        "href",
        wikilink_title(href).alias("wikilink"),
        normalize_title(F.concat(F.lit(" "), href, F.lit(" "))).alias("normalized"),
    )


# Wikitext: page metadata and filters


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.page_meta(_dump(spark, sf_dir)).select(
        "id", "is_redirect", "redirect_target", "is_stub", "disamb"
    )


def redirect_targets_no_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = extract.page_meta(_dump(spark, sf_dir), strip_fragment=True)
    return df.where("is_redirect").select("id", "redirect_target")


def page_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dump(spark, sf_dir).select(
        "id", F.posexplode(meta.categories(F.col("text"))).alias("pos", "category")
    )


def page_raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dump(spark, sf_dir).select(
        "id", F.posexplode(meta.raw_links(F.col("text"))).alias("pos", "link")
    )


def page_plain_text_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dump(spark, sf_dir).select("id", meta.plain_text_regex(F.col("text")).alias("plain"))


def translated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return _dump(spark, sf_dir).select(
        "id",
        meta.translated_title(text, "fr").alias("fr"),
        meta.translated_title(text, "de").alias("de"),
    )


def page_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns, title, text = F.col("ns"), F.col("title"), F.col("text")
    return extract.page_meta(_dump(spark, sf_dir)).select(
        "id",
        predicates.is_main(ns).alias("is_main"),
        predicates.has_text(text).alias("has_text"),
        predicates.is_special_title(title).alias("is_special"),
        predicates.is_content_page(ns, text).alias("is_content"),
        predicates.is_noncontent_page(ns, text, F.col("disamb"), F.col("is_redirect")).alias(
            "is_noncontent"
        ),
        predicates.is_entity_link(title).alias("is_entity_link"),
    )


# Wikitext: the extracted relations


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _array_text(extract.extract(_dump(spark, sf_dir)).pages)


def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_dump(spark, sf_dir)).links


def extract_links_by_own_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only links to the numbered pages count as links."""
    numbered = lambda title: title.rlike("^Page [0-9]+$")
    return extract.extract(_dump(spark, sf_dir), link_filter=numbered).links


def extract_pages_without_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(_dump(spark, sf_dir), main_only=True, keep_section_titles=False)
    return _array_text(found.pages)


def extract_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_dump(spark, sf_dir)).redirects


def page_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _array_text(preview.preview(_dump(spark, sf_dir)))


def _stored(spark: SparkSession, sf_dir: str) -> extract.Relations:
    """The relations over a stored table."""
    return extract.stage_relations(_dump(spark, sf_dir), scratch_path(spark, "relations"))


def wiki_normalized_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stored(spark, sf_dir)
    return relations.normalized_links(found.links, found.redirects, found.pages, "target")


def wiki_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stored(spark, sf_dir)
    return relations.count_links(found.links, found.redirects, found.pages)


def wiki_aggregate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stored(spark, sf_dir)
    normalized = relations.normalized_links(found.links, found.redirects, found.pages)
    return _array_text(relations.aggregate_pages(found.pages, normalized))


def extract_pages_strict_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates by the exact counter: a closing mark too many takes text with it."""
    found = extract.extract(inputs.stray_braces(_dump(spark, sf_dir)), strict_depth=True)
    return _array_text(found.pages)


def extract_pages_without_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text, and no links at all."""
    annotated = extract.annotate_dump(_dump(spark, sf_dir), with_links=False)
    return annotated.where(~F.col("is_redirect")).select(
        "page_id", "content", F.size("links").alias("n_links")
    )


def odd_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.odd_markup(spread(inputs.table(spark, sf_dir, "documents"), "doc_id"))
    span = F.col("s")
    return annotate_links(pages).select("id", "content", F.explode("links").alias("s")).select(
        "id", "content", *(span[c].alias(c) for c in ("char_start", "char_end", "surface", "link"))
    )


def extract_links_site_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of a dump whose site names its own file and category namespaces."""
    path = _write_site(spark, sf_dir)
    names = dumps.read_namespaces(spark, path)
    return extract.extract(dumps.read_dump(spark, path), namespaces=names).links


def namespace_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.read_namespaces(spark, _write_site(spark, sf_dir))


def special_titles_of_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_site(spark, sf_dir)
    names = dumps.namespace_names(dumps.read_namespaces(spark, path))
    title = F.col("title")
    return dumps.read_dump(spark, path).select(
        "id", "title", predicates.is_special_title(title, names).alias("is_special")
    )


# Redirect statistics


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.build_wiki_pages(_dump(spark, sf_dir))


def title_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.title_map(_titles(spark, sf_dir))


def article_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.article_count(_titles(spark, sf_dir))


def redirect_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.redirect_edges(_wiki_pages(spark, sf_dir))


def unresolved_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.unresolved_redirects(_wiki_pages(spark, sf_dir))


def resolved_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.resolve_redirects(redirect_edges(spark, sf_dir))


def redirect_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _wiki_pages(spark, sf_dir)
    return redirects.redirect_loops(redirects.redirect_edges(pages), pages)


def redirect_loop_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source that runs into a loop, with the loop's titles in order."""
    pages = _wiki_pages(spark, sf_dir)
    return _array_text(redirects.redirect_loop_members(redirects.redirect_edges(pages), pages))


def looping_part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = inputs.part_edges(inputs.table(spark, sf_dir, "part"))
    return redirects.label_loops(redirects.close_redirects(edges).looping)


def redirect_stats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics themselves, as rows `(part, id, other, title)`."""
    stats = collect_stats(_wiki_pages(spark, sf_dir))
    none, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    parts = [
        stats.titles.select(F.lit("titles").alias("part"), "id", number.alias("other"), "title"),
        stats.redirects.select(F.lit("redirects"), "src", "dst", none),
        stats.loops.select(F.lit("loops"), "src", number, "title"),
        stats.unresolved.select(F.lit("unresolved"), "src", number, "title"),
    ]
    return reduce(DataFrame.union, parts)


def redirect_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of each part of the statistics, as rows `(part, n)`."""
    stats = collect_stats(_wiki_pages(spark, sf_dir))
    counts = [stats.articles.select(F.lit("articles").alias("part"), F.col("articles").alias("n"))]
    for part in ("redirects", "loops", "unresolved"):
        size = getattr(stats, part).agg(F.count("*").alias("n"))
        counts.append(size.select(F.lit(part).alias("part"), "n"))
    return reduce(DataFrame.union, counts)


def resolved_part_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.resolve_redirects(inputs.part_edges(inputs.table(spark, sf_dir, "part")))


def looping_part_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = inputs.part_edges(inputs.table(spark, sf_dir, "part"))
    return redirects.follow_redirects(edges)[1]


# Files


def csv_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).pages, path)
    return _array_text(sources.read_pages_csv(spark, path))


def csv_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).links, path)
    return sources.read_links_csv(spark, path)


def csv_links_in_ten_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).links, path, chunks=10)
    return sources.read_links_csv(spark, path)


def csv_links_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of another program, read by many tasks."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).links, path, chunks=1, foreign=True)
    return sources.read_links_csv(spark, path, foreign=True)


def csv_pages_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of another program whose texts hold line ends."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).pages, path, foreign=True)
    return _array_text(sources.read_pages_csv(spark, path, foreign=True))


def wiki_pages_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wiki_pages")
    sinks.save_parquet(wiki_pages(spark, sf_dir), path)
    return sources.read_wiki_pages(spark, path)


def first_wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of the stored table by id, for a first look."""
    path = scratch_path(spark, "wiki_pages")
    sinks.save_parquet(wiki_pages(spark, sf_dir), path)
    return sources.read_wiki_pages(spark, path, limit=5, order="id")


def aggregate_pages_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and links saved as tables bucketed alike, joined and grouped where they lie."""
    found = _stored(spark, sf_dir)
    normalized = relations.normalized_links(found.links, found.redirects, found.pages)
    tables = []
    for name, df in (("pages", found.pages), ("links", normalized)):
        table = f"bucketed_{name}_{uuid.uuid4().hex}"
        sinks.save_table(df, table, "page_id", 8)
        tables.append(spark.table(table))
    return _array_text(relations.aggregate_pages(*tables))


def csv_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(extract.extract(_dump(spark, sf_dir)).redirects, path)
    return sources.read_redirects_csv(spark, path)


def _write_site(spark: SparkSession, sf_dir: str) -> str:
    """A dump whose header has the names of the site's namespaces."""
    documents = inputs.table(spark, sf_dir, "documents")
    pages = inputs.odd_markup(documents, inputs.SITE_MARKUP, inputs.SITE_TITLE)
    return _write_xml(spark, sf_dir, pages=pages, header=inputs.site_header(documents), compression="none")


def _write_xml(
    spark: SparkSession,
    sf_dir: str,
    broken: str = "false",
    pages: DataFrame | None = None,
    header: Column | None = None,
    compression: str = "bzip2",
) -> str:
    """Pages, else the wikitext pages, as an XML dump, a part per task; `broken` ones lose a mark.

    Every part begins with the header.
    """

    def escaped(name: str) -> Column:
        c = replace_held(F.col(name), "&", "&amp;")
        return replace_held(replace_held(c, "<", "&lt;"), ">", "&gt;")

    path = scratch_path(spark, "dump")
    page = F.format_string(
        "  <page>\n    <title>%s</title>\n    <ns>%d</ns>\n    <id>%d</id>\n    <revision>\n"
        '      <id>7</id>\n      <text xml:space="preserve">%s</text>\n    </revision>\n  </page>',
        escaped("title"),
        "ns",
        "id",
        F.coalesce(escaped("text"), F.lit("")),
    )
    page = F.when(F.expr(broken), F.replace(page, F.lit("</ns>"), F.lit(""))).otherwise(page)
    if header is not None:
        first = F.monotonically_increasing_id() % (1 << 33) == 0
        page = F.concat(F.when(first, header).otherwise(""), page)
    pages = _dump(spark, sf_dir) if pages is None else pages
    pages.select(page.alias("value")).write.option("compression", compression).text(path)
    return path


def dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dumps.read_dump(spark, _write_xml(spark, sf_dir))
    return df.withColumn("text", F.coalesce("text", F.lit("")))


def dump_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.count_pages(spark, _write_xml(spark, sf_dir))


def dump_count_with_broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.count_pages(spark, _write_xml(spark, sf_dir, "id % 9 = 4"))


def dump_counts_while_extracting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, taken by the job that extracts the relations."""
    path = _write_xml(spark, sf_dir, "id % 9 = 4")
    _, counts = extract.write_dump(spark, path, scratch_path(spark, "relations"))
    return spark.createDataFrame([(counts["pages"], counts["corrupt"])], "pages long, corrupt long")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a dump in the order of their ids, with their numbers."""
    # The documents are sorted, not the wikitext: a sort computes its input twice.
    documents = inputs.table(spark, sf_dir, "documents").orderBy("doc_id")
    path = _write_xml(spark, sf_dir, pages=inputs.wikitext(documents))
    return dumps.number_pages(dumps.read_dump(spark, path, keep_split=True))


def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("number")
    return _numbered(spark, sf_dir).select("id", "number", (number % 10).cast("int").alias("chunk"))


def csv_links_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in ten folders by the number of their page."""
    path = scratch_path(spark, "chunks")
    # Rendered once: each relation of `extract` would render the dump anew when it is written.
    found = extract.stage_relations(_numbered(spark, sf_dir), scratch_path(spark, "relations"))
    extract.write_chunks(found, path)
    chunks = [
        sources.read_links_csv(spark, f"{path}/links/chunk={k}").withColumn("chunk", F.lit(k))
        for k in range(10)
    ]
    return reduce(DataFrame.union, chunks)


def pages_by_callback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own function of each page, with its number, text and links."""

    def measure(pages: pa.RecordBatch) -> pa.RecordBatch:
        size = pc.coalesce(pc.list_value_length(pages["links"]), pa.scalar(0, pa.int32()))
        chars = pc.cast(pc.utf8_length(pages["content"]), pa.int32())
        columns = [pages["number"], pages["page_id"], size, chars]
        return pa.record_batch(columns, names=["number", "page_id", "n_links", "n_chars"])

    annotated = extract.annotate_dump(_numbered(spark, sf_dir))
    annotated = annotated.select("number", "page_id", "content", "links")
    return extract.each_page(annotated, measure, "number long, page_id long, n_links int, n_chars int")


def dump_wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.build_wiki_pages(dumps.read_dump(spark, _write_xml(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalized_links,
        normalized_links_resolved,
        link_counts,
        link_counts_after_join,
        aggregate_pages,
        normalized_titles,
        page_meta,
        redirect_targets_no_fragment,
        page_categories,
        page_raw_links,
        page_plain_text_regex,
        translated_titles,
        page_filters,
        extract_pages,
        extract_links,
        extract_links_by_own_filter,
        extract_pages_without_headings,
        extract_redirects,
        page_preview,
        wiki_normalized_links,
        wiki_link_counts,
        wiki_aggregate_pages,
        wiki_pages,
        title_map,
        article_count,
        redirect_edges,
        unresolved_redirects,
        resolved_redirects,
        redirect_loops,
        redirect_loop_titles,
        looping_part_labels,
        redirect_stats,
        resolved_part_chains,
        looping_part_chains,
        csv_pages,
        csv_links,
        csv_redirects,
        dump_scan,
        dump_count,
        dump_count_with_broken_pages,
        dump_counts_while_extracting,
        page_numbers,
        csv_links_in_chunks,
        pages_by_callback,
        namespace_scan,
        special_titles_of_site,
        extract_pages_strict_depth,
        first_wiki_pages,
        aggregate_pages_bucketed,
        redirect_stats_rows,
        dump_wiki_pages,
        csv_links_in_ten_files,
        csv_links_one_file,
        csv_pages_foreign,
        wiki_pages_parquet,
        extract_pages_without_links,
        extract_links_site_names,
        odd_markup,
    )
}
