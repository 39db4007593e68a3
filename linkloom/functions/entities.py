"""Character entities to characters."""

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.scan import let


def named_entities() -> dict[str, str]:
    """The names of HTML 4."""
    return {name: chr(code) for name, code in name2codepoint.items()}


_NAME = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
# Digits behind leading zeros; a number with more is no character.
_MOST_DIGITS = 7


def _from_code(code: Column) -> Column:
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, char)


def decode_entities(text: Column) -> Column:
    """Decode each entity once; what is no entity stays as written."""
    # One literal, folded into a map when the plan is optimized.
    table = F.from_json(F.lit(json.dumps(named_entities())), "map<string,string>")

    def char(name: Column) -> Column:
        digits = F.regexp_replace(name, "^#[xX]?0*", "")
        number = F.when(F.length(digits) <= _MOST_DIGITS, digits)
        hexadecimal = F.conv(number, 16, 10).try_cast("bigint")
        decimal = number.try_cast("bigint")
        return (
            F.when(F.lower(F.substring(name, 1, 2)) == "#x", _from_code(hexadecimal))
            .when(F.startswith(name, F.lit("#")), _from_code(decimal))
            .otherwise(F.try_element_at(table, name))
        )

    def decoded(segment: Column) -> Column:
        return let(
            F.regexp_extract(segment, _NAME, 1),
            lambda name: F.coalesce(
                F.concat(char(name), F.substr(segment, F.length(name) + 2)),
                F.concat(F.lit("&"), segment),
            ),
        )

    joined = let(
        F.split(text, "&", -1),
        lambda pieces: F.concat(
            pieces[0],
            F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded), ""),
        ),
    )
    return F.when(text.rlike("&[#A-Za-z]"), joined).otherwise(text)
