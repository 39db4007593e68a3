"""Title normalizers and small text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Java's String.trim removes and a title can hold.
BLANKS = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def _with_first(c: Column, first: Column) -> Column:
    return F.replace(F.concat(first, F.substr(c, F.lit(2))), F.lit("_"), F.lit(" "))


def wikilink_title(c: Column) -> Column:
    """Upper-case a lower-case first letter and turn underscores into spaces.

    NULL and '' pass through, and the text is not trimmed. A letter whose upper case is longer
    than one character grows, so a leading sharp s becomes SS.
    """
    first = F.substring(c, 1, 1)
    raised = F.when(first == F.lower(first), F.upper(first)).otherwise(first)
    return _with_first(c, raised)


def normalize_title(c: Column) -> Column:
    """Trim, capitalize the first letter, turn underscores into spaces.

    Capitalizing maps one character to one character, so a leading sharp s stays as it is.
    """
    c = strip(c)
    first = F.substring(c, 1, 1)
    raised = F.upper(first)
    return _with_first(c, F.when(F.length(raised) == 1, raised).otherwise(first))


def bracketed_target(c: Column) -> Column:
    """The text of the first `[[...]]` that holds no closing bracket; NULL if there is none."""
    return F.nullif(F.regexp_extract(c, r"\[\[([^\]]+)\]\]", 1), F.lit(""))


def abbreviate(c: Column, width: int = 100) -> Column:
    """Cut to `width` characters, the last three being dots."""
    return F.when(
        F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))
    ).otherwise(c)
