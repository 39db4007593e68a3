"""A short view of each page of a dump."""

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.titles import abbreviate, strip
from linkloom.plans.extract import annotate_dump


def preview(dump: DataFrame, items: int = 2, width: int = 100, **options: Any) -> DataFrame:
    """Title, and either the redirect target or the start of the text with the first surfaces and
    categories. `title` is as in the dump's relations."""
    article = ~F.col("is_redirect")
    return annotate_dump(dump, **options).select(
        "page_id",
        "title",
        F.col("redirect_target").alias("redirect"),
        F.when(article, abbreviate(strip(F.col("content")), width)).alias("text"),
        F.when(article, F.slice(F.col("links.surface"), 1, items)).alias("surfaces"),
        F.when(article, F.slice(F.col("categories"), 1, items)).alias("categories"),
    )
