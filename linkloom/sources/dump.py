"""XML page dumps, plain or compressed."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions.entities import decode_entities
from linkloom.functions.predicates import is_content_page
from linkloom.operators.lineage import cut
from linkloom.operators.once import with_fields
from linkloom.schemas import CORRUPT, XML_PAGE

# The header of a dump has a few dozen namespaces: a first look, and what it never exceeds.
HEADER_LINES = (500, 10_000)
HEADER_END = "</siteinfo>"

PAGE_END = "</page>"
PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # Page text is text: its surrounding blanks belong to it.
    "ignoreSurroundingSpaces": "false",
}
_NAMESPACE = r'<namespace key="(-?[0-9]+)"[^>]*?(?:/>|>([^<]*)</namespace>)'


def read_dump(
    spark: SparkSession,
    path: str,
    partitions: int | None = None,
    keep_corrupt: bool = False,
    keep_split: bool = False,
) -> DataFrame:
    """One row `(id, ns, title, text)` per `<page>` element.

    The XML source reads a file in one task and gives up on it at the first error. The file is
    therefore read as text records that end at `</page>`, which Spark splits among tasks, plain or
    bzip2, and each record is parsed by itself. (A page's own text cannot hold the end mark: there
    it is escaped.) `partitions` spreads the pages anew where the files cannot be split, as gzip.
    A page that does not parse is left out; `keep_corrupt` keeps it, with its source in
    `_corrupt_record`. `keep_split` adds `(file, start)`, the split of the page, for `number_pages`.
    """
    records = spark.read.option("lineSep", PAGE_END).text(path)
    split = ("file", "start") if keep_split else ()
    if keep_split:
        records = records.select("value", "_metadata.file_path", "_metadata.file_block_start")
        records = records.toDF("value", *split)
    page = F.regexp_extract("value", r"(?s)<page(?:\s[^>]*)?>.*$", 0)
    parsed = F.from_xml(F.concat(page, F.lit(PAGE_END)), XML_PAGE, PARSE_OPTIONS)
    df = (
        with_fields(records.where(F.contains("value", F.lit("<page"))), parsed, keep=split)
        .select("id", "ns", "title", F.col("revision.text._VALUE").alias("text"), CORRUPT, *split)
    )
    if not keep_corrupt:
        df = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return df if partitions is None else df.repartition(partitions)


def count_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages read and pages that did not parse, as one row `(pages, corrupt)`."""
    return read_dump(spark, path, keep_corrupt=True).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("pages"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"),
    )


def count_while_reading(dump: DataFrame) -> tuple[DataFrame, Observation]:
    """The pages of a dump read with `keep_corrupt`, and the counts `count_pages` would give.

    The counts are taken by the first job that reads the pages, while it reads them; `get` of the
    observation waits for that job.
    """
    seen = Observation("dump")
    corrupt = F.col(CORRUPT).isNotNull()
    counted = dump.observe(
        seen, F.count_if(~corrupt).alias("pages"), F.count_if(corrupt).alias("corrupt")
    )
    return counted.where(~corrupt).drop(CORRUPT), seen


def number_pages(dump: DataFrame) -> DataFrame:
    """Add `number`, from 0 without gaps in the order of the dump, to pages read with `keep_split`.

    Nothing is sorted: pages come out of a split in their order, and the pages of the splits
    before it are added from one row for each split. The pages are stored once, so that counts
    and pages come from the same splits.
    """
    rows = cut(dump.withColumn("_row", F.monotonically_increasing_id()), "pages")
    splits = rows.groupBy("file", "start").agg(
        F.count("*").alias("_pages"), F.min("_row").alias("_first")
    )
    before = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(*before)
    splits = splits.withColumn("_in_file", F.sum("_pages").over(in_file))
    # One row for each file of the dump.
    files = splits.groupBy("file").agg(F.sum("_pages").alias("_all"))
    ahead = F.sum("_all").over(Window.orderBy("file").rowsBetween(*before))
    files = files.select("file", ahead.alias("_files"))
    offset = F.coalesce("_files", F.lit(0)) + F.coalesce("_in_file", F.lit(0)) - F.col("_first")
    offsets = splits.join(files, "file").select("file", "start", offset.alias("_offset"))
    # Dealt by split, the texts would go to a few tasks.
    numbered = rows.join(F.broadcast(offsets), ["file", "start"])
    return numbered.withColumn("number", F.col("_row") + F.col("_offset")).drop("file", "start", "_row", "_offset")


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """The site's namespaces `(ns, name)`; the main one has no name.

    Every part of a dump carries the same header. The first lines of the first part are read, up
    to the end of its header, however large the dump is.
    """
    for most in HEADER_LINES:
        read = [row["value"] for row in spark.read.text(path).head(most)]
        end = next((n for n, line in enumerate(read) if HEADER_END in line), None)
        if end is not None or len(read) < most:
            break
    header = [(line,) for line in read[: len(read) if end is None else end]]
    lines = spark.createDataFrame(header, "value string").where(
        F.contains("value", F.lit("<namespace "))
    )
    found = F.arrays_zip(
        F.regexp_extract_all("value", F.lit(_NAMESPACE), 1).alias("key"),
        F.regexp_extract_all("value", F.lit(_NAMESPACE), 2).alias("name"),
    )
    return lines.select(F.explode(found).alias("n")).select(
        F.col("n.key").cast("int").alias("ns"),
        decode_entities(F.nullif(F.col("n.name"), F.lit(""))).alias("name"),
    )


def namespace_names(namespaces: DataFrame, keys: tuple[int, ...] = ()) -> Column:
    """Distinct namespace names, of the namespaces in `keys` if given, as one array column.

    It is a scalar subquery: the names are aggregated once and tested in the row.
    """
    wanted = F.col("name").isNotNull()
    if keys:
        wanted &= F.col("ns").isin(*keys)
    return namespaces.where(wanted).agg(F.array_sort(F.collect_set("name"))).scalar()


def build_wiki_pages(dump: DataFrame) -> DataFrame:
    """The `wiki_pages` relation of a dump: its article and category pages that have text.

    `html` stays NULL, since pages are not rendered to HTML.
    """
    return dump.where(is_content_page(F.col("ns"), F.col("text"))).select(
        "id",
        "title",
        F.lit(None).cast("string").alias("html"),
        F.col("text").alias("mediawiki"),
    )
