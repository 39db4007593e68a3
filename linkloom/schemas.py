"""Declared schemas. Nothing is inferred: inference would read a dump twice."""

from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("disamb", T.BooleanType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("char_start", T.IntegerType()),
        T.StructField("char_end", T.IntegerType()),
        T.StructField("surface", T.StringType()),
        T.StructField("title", T.StringType()),
    ]
)

REDIRECTS = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("target", T.StringType()),
    ]
)

WIKI_PAGES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("mediawiki", T.StringType()),
    ]
)

# One <page> element of an XML dump, and the column holding what failed to parse.
CORRUPT = "_corrupt_record"
XML_PAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ns", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField(
            "revision",
            T.StructType(
                [
                    T.StructField(
                        "text", T.StructType([T.StructField("_VALUE", T.StringType())])
                    )
                ]
            ),
        ),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# A dump page after flattening; every extraction operator starts from these columns.
DUMP = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ns", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
