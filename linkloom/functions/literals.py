"""Array literals of the form `{"a","b"}`, the text form of array columns in CSV."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_ELEMENT = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'


def to_array_literal(c: Column) -> Column:
    def quoted(x: Column) -> Column:
        x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        x = F.replace(x, F.lit('"'), F.lit('\\"'))
        return F.concat(F.lit('"'), x, F.lit('"'))

    return F.concat(F.lit("{"), F.array_join(F.transform(c, quoted), ","), F.lit("}"))


def to_int_array_literal(c: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(c.cast("array<string>"), ","), F.lit("}"))


def from_array_literal(c: Column) -> Column:
    found = F.regexp_extract_all(c, F.lit("(?s)" + _ELEMENT), 1)
    return F.transform(found, lambda x: F.regexp_replace(x, r"(?s)\\(.)", "$1"))


def from_int_array_literal(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(-?[0-9]+)"), 1).cast("array<int>")
