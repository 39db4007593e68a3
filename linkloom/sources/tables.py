"""The CSV relations and the `wiki_pages` table."""

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom import schemas
from linkloom.functions.literals import from_array_literal, from_int_array_literal
from linkloom.operators.once import with_fields
from linkloom.sources.records import read_records

# A CSV field cannot tell NULL from '': NULL is written as this mark. Backslashes are doubled and
# line ends written as below, so that a record is a line and a file splits among tasks at any line.
NULL_MARK = "\\N"
LINE_ENDS = {"\n": "\\n", "\r": "\\r"}
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for plain, written in LINE_ENDS.items():
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    def line_ends(part: Column) -> Column:
        for plain, written in LINE_ENDS.items():
            part = F.replace(part, F.lit(written), F.lit(plain))
        return part

    # Between doubled backslashes a single one begins a line end.
    parts = F.transform(F.split(c, r"\\\\", -1), line_ends)
    return F.when(F.contains(c, F.lit("\\")), F.array_join(parts, "\\")).otherwise(c)


def decode_field(c: Column, dtype: T.DataType) -> Column:
    # An empty field comes back as NULL; the mark is the only NULL written.
    c = F.coalesce(c, F.lit(""))
    plain = unescape(c)
    if isinstance(dtype, T.ArrayType):
        integers = isinstance(dtype.elementType, (T.IntegerType, T.LongType))
        array = from_int_array_literal if integers else from_array_literal
        plain = array(plain)
    return F.when(c != NULL_MARK, plain.cast(dtype))


def plain_field(c: Column, dtype: T.DataType) -> Column:
    """A field of a file that knows no escapes: backslashes and the word null are text."""
    c = F.coalesce(c, F.lit(""))
    if isinstance(dtype, T.ArrayType):
        integers = isinstance(dtype.elementType, (T.IntegerType, T.LongType))
        return (from_int_array_literal if integers else from_array_literal)(c)
    return c if isinstance(dtype, T.StringType) else c.try_cast(dtype)


def _read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, foreign: bool = False
) -> DataFrame:
    """`path` may be a folder, a glob or a list: chunk files simply add up.

    `foreign` is for files that other programs wrote: their fields hold no NULL mark and no escapes,
    and may hold line ends between quotes. Both kinds of files split among tasks.
    """
    decode = plain_field if foreign else decode_field
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    if foreign:
        fields = F.from_csv("record", text.simpleString()[7:-1].replace(":", " "), {**CSV_OPTIONS, "multiLine": "true"})
        raw = with_fields(read_records(spark, path), fields, keep=())
    else:
        raw = spark.read.options(**CSV_OPTIONS).schema(text).csv(path)
    return raw.select(*[decode(F.col(f.name), f.dataType).alias(f.name) for f in schema])


def read_pages_csv(
    spark: SparkSession, path: str | list[str], foreign: bool = False
) -> DataFrame:
    return _read_csv(spark, path, schemas.PAGES, foreign)


def read_links_csv(
    spark: SparkSession, path: str | list[str], foreign: bool = False
) -> DataFrame:
    return _read_csv(spark, path, schemas.LINKS, foreign)


def read_redirects_csv(
    spark: SparkSession, path: str | list[str], foreign: bool = False
) -> DataFrame:
    return _read_csv(spark, path, schemas.REDIRECTS, foreign)


def jdbc_source(database: str, partitions: int, max_id: int, host: str = "localhost") -> dict:
    """Options for `read_wiki_pages` on a PostgreSQL database, read by ranges of `id`.

    The port is that of the environment variable PGPORT, 8432 if it is not set.
    """
    port = os.environ.get("PGPORT", "8432")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": str(max_id),
        "numPartitions": str(partitions),
    }


def read_wiki_pages(
    spark: SparkSession,
    source: str | Mapping[str, str],
    limit: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """The table `wiki_pages(id, title, html, mediawiki)`.

    `source` is a Parquet path or the options of a JDBC read, as `jdbc_source` gives them. Filters
    and the column list reach the database. `limit` keeps that many rows, for a first look: any, or
    the first by the column `order`.
    """
    names = schemas.WIKI_PAGES.fieldNames()
    if isinstance(source, str):
        df = spark.read.schema(schemas.WIKI_PAGES).parquet(source)
    else:
        options = {"dbtable": "wiki_pages", **source}
        df = spark.read.format("jdbc").options(**options).load()
        # Ids may be 32-bit there.
        df = df.select(*[F.col(n).cast(schemas.WIKI_PAGES[n].dataType).alias(n) for n in names])
    if limit is None:
        return df
    return (df if order is None else df.orderBy(order)).limit(limit)
