"""Named intermediate values and left-to-right scans, inside the row."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, evaluated once however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def scan(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column], Column],
    out_type: str,
) -> Column:
    """Emit one value per item from the state before it; `step` gives the state after it.

    `aggregate` alone would copy its growing output once per item. The items are therefore taken
    in blocks of about sqrt(n), which keeps a page of n tokens at n*sqrt(n) reference copies, and
    a running total needs no shuffle of the page's pieces.
    """
    nothing = F.array().cast(f"array<{out_type}>")

    def blocks(xs: Column) -> Column:
        n = F.size(xs)
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
        return F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), width),
            lambda first: F.slice(xs, first + 1, width),
        )

    def run(seed: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(seed.alias("state"), nothing.alias("out")),
            lambda acc, x: F.struct(
                step(acc["state"], x).alias("state"),
                F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out"),
            ),
        )

    runs = F.aggregate(
        let(items, blocks),
        F.array(F.struct(zero.alias("state"), nothing.alias("out"))),
        lambda acc, block: F.concat(
            acc, F.array(run(F.element_at(acc, -1)["state"], block))
        ),
    )
    return F.flatten(F.transform(runs, lambda r: r["out"]))


def running_total(lengths: Column) -> Column:
    """For each item, the sum of the items before it."""
    return scan(lengths, F.lit(0), lambda s, x: s + x, lambda s, x: s, "int")


def holds(text: Column, *literals: str) -> Column:
    """Whether `text` holds one of `literals`; a search of bytes, far cheaper than a pattern's."""
    return reduce(Column.__or__, (F.contains(text, F.lit(x)) for x in literals))


def replace_marked(text: Column, pattern: str, replacement: str, *literals: str) -> Column:
    """`regexp_replace(text, pattern, replacement)`; every match must hold one of `literals`."""
    return let(
        text,
        lambda c: F.when(holds(c, *literals), F.regexp_replace(c, pattern, replacement)).otherwise(c),
    )


def replace_held(text: Column, old: str, new: str) -> Column:
    """`replace(text, old, new)`; a text without `old` costs a search only."""
    return let(
        text, lambda c: F.when(holds(c, old), F.replace(c, F.lit(old), F.lit(new))).otherwise(c)
    )


def replace_closed(text: Column, pattern: str, replacement: str, closing: str, opening: str) -> Column:
    """`regexp_replace(text, pattern, replacement)` in time linear in the text.

    `pattern` ends with `closing`. Behind the last closing mark every opening mark would start a
    search to the end of the text that fails; that tail is set aside. Texts without `opening`, a
    literal that every match holds, stay as they are. `text` is named several times.
    """
    head = F.regexp_extract(text, rf"(?s)\A.*{closing}", 0)
    done = let(
        head,
        lambda h: F.concat(
            F.regexp_replace(h, pattern, replacement), F.substr(text, F.length(h) + 1)
        ),
    )
    return F.when(F.contains(text, F.lit(opening)), done).otherwise(text)


def replace_closed_lines(
    text: Column, pattern: str, replacement: str, closing: str, opening: str
) -> Column:
    """The same for a pattern that stays within a line, with a tail for each line."""
    mark = "\u0001"
    marked = F.regexp_replace(text, rf"(.*{closing})|(.+)", f"$1{mark}$2{mark}")
    pieces = F.split(F.replace(marked, F.lit(mark + mark), F.lit("")), mark, -1)
    searched = F.transform(
        pieces,
        lambda piece, i: F.when(
            i % 2 == 0, F.regexp_replace(piece, pattern, replacement)
        ).otherwise(piece),
    )
    return F.when(F.contains(text, F.lit(opening)), F.array_join(searched, "")).otherwise(text)
