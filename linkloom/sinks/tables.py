"""Chunked CSV and Parquet tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.literals import to_array_literal, to_int_array_literal
from linkloom.sources.tables import CSV_OPTIONS, NULL_MARK, escape


def encode_field(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        integers = isinstance(dtype.elementType, (T.IntegerType, T.LongType))
        text = to_int_array_literal(c) if integers else to_array_literal(c)
    else:
        text = c.cast("string")
    return F.coalesce(escape(text), F.lit(NULL_MARK))


def foreign_field(c: Column, dtype: T.DataType) -> Column:
    """A field as programs write it that know no escapes: line ends as they are, NULL as a word."""
    if isinstance(dtype, T.ArrayType):
        integers = isinstance(dtype.elementType, (T.IntegerType, T.LongType))
        c = to_int_array_literal(c) if integers else to_array_literal(c)
    return F.coalesce(c.cast("string"), F.lit("null"))


def write_csv(
    df: DataFrame, path: str, chunks: int | None = None, mode: str = "error", foreign: bool = False, by: str | None = None
) -> None:
    """Write files without a header, fields quoted where needed.

    `chunks` asks for that many files, each written by one task: ten will do for a small dump.
    Without it every partition of `df` writes its own, and nothing is shuffled. `foreign` files are
    for programs that know no escapes. `by` names a column whose values get a folder each.
    """
    encode = foreign_field if foreign else encode_field
    rows = df.select(
        *[F.col(f.name) if f.name == by else encode(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]
    )
    if chunks is not None:
        rows = rows.repartition(chunks)
    writer = rows.write.mode(mode).options(**CSV_OPTIONS)
    (writer.partitionBy(by) if by else writer).csv(path)


def save_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def save_table(
    df: DataFrame, name: str, key: str | None = None, buckets: int = 0, mode: str = "error"
) -> None:
    """Save as a table, bucketed by `key` if `buckets` is given.

    Bucket `pages` and `links` by `page_id` with the same count: their joins and the groups by
    page then need no shuffle, so article text stays where it was written.
    """
    writer = df.write.mode(mode).format("parquet")
    if buckets:
        if key is None:
            raise ValueError("a bucketed table needs a key")
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
