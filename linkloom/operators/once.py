"""Columns that are worked out once per row."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_fields(df: DataFrame, value: Column, keep: Sequence[str] = ("*",)) -> DataFrame:
    """The columns `keep` of `df` and the fields of the struct `value`, evaluated once per row.

    A filter on a projected column moves below the projection, and the column's expression with
    it: a page would be parsed or rendered again for each test of it. It does not move below a
    generator, so the struct goes through one as a single element.
    """
    return df.select(*keep, F.inline(F.array(value)))
