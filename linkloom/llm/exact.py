"""Exact duplicates by counting quotient filters, verified byte by byte.

Every row's normalised text has a 64-bit fingerprint. Each partition builds a counting quotient
filter of its fingerprints; filters merge without loss by their sorted remainders, range by range of
the fingerprint, and only fingerprints with a count above one send their texts on to the byte
comparison. A text that occurs once never travels while the routed fingerprints fit a checked
broadcast; beyond that bound a salted join takes over.

Texts are equal when identical after each run of the six ASCII blanks becomes one space. Null counts
as empty, so null and empty texts are one group. Of equal texts the smallest doc_id stays; null ids
come after all others, and among rows of one id (repeats) one row stays in `drop_copies`, while
`class_rows`, which has no other mark of a row, calls each row of that id kept. Very long texts are
hashed at the scan and compared whole. An empty table gives an empty result. Extra columns, whatever
their names and types, are kept by `drop_copies` and left out by `class_rows`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_rows, staged

#: A filter holds at most this many rows' fingerprints before a task starts the next one.
FILTER_ROWS = 1 << 20
#: Each merge level splits fingerprints into this many ranges and merges as many filters.
FAN_BITS = 6
#: Share of a filter's slots in use.
LOAD = 0.9
#: A counter slot holds this many bits of a count.
DIGIT = 24
#: Routed fingerprints up to this number (8 bytes each) are broadcast, more are joined.
ROUTED_BROADCAST = 1 << 20
#: Groups of more rows than this are salted; there are at most rows / HOT_ROWS of them.
HOT_ROWS = 1_000_000

_BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of blanks replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " ")


def pack_filter(values: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A counting quotient filter of sorted distinct `width`-bit values and their counts (1 or more).

    A value's high bits, the quotient, name its home slot; its low bits, the remainder, are stored
    in the run of that quotient, sorted, shifted right where slots are taken. A count above one
    is followed by counter slots with the digits of count - 1. Three bits a slot: the quotient is
    occupied, the slot ends a run, the slot is a counter.
    """
    values, rest = values.astype(np.uint64), counts.astype(np.uint64) - np.uint64(1)
    digits = np.zeros(len(values), np.int64)
    left = rest.copy()
    while left.any():
        digits += left > 0
        left >>= np.uint64(DIGIT)
    used = digits + 1
    total = int(used.sum())
    q = max(1, int(np.ceil(np.log2(max(1, total) / LOAD))))
    r = width - q
    if r < DIGIT:
        raise ValueError("too many values for one filter")
    home = (values >> np.uint64(r)).astype(np.int64)
    first = np.cumsum(used) - used
    body, counter = np.empty(total, np.uint64), np.ones(total, bool)
    body[first], counter[first] = values & np.uint64((1 << r) - 1), False
    for level in range(int(digits.max(initial=0))):
        at = np.flatnonzero(digits > level)
        body[first[at] + level + 1] = (rest[at] >> np.uint64(DIGIT * level)) & np.uint64((1 << DIGIT) - 1)
    homes, order = np.repeat(home, used), np.arange(total)
    place = np.maximum.accumulate(homes - order) + order
    size = max(1 << q, int(place[-1]) + 1 if total else 0)
    slots = np.zeros(size, np.uint64)
    slots[place] = body
    occupied, ends, counters = np.zeros(1 << q, bool), np.zeros(size, bool), np.zeros(size, bool)
    occupied[home] = True
    ends[place[np.flatnonzero(np.append(homes[1:] != homes[:-1], True)[:total])]] = True
    counters[place] = counter
    bits = b"".join(np.packbits(x).tobytes() for x in (occupied, ends, counters))
    held = np.ascontiguousarray(slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (r + 7) // 8])
    return np.array([width, q, size], "<i8").tobytes() + bits + held.tobytes()


def unpack_filter(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values and counts that `pack_filter` was given."""
    width, q, size = (int(x) for x in np.frombuffer(blob, "<i8", 3))
    r, at, found = width - q, 24, []
    for n in (1 << q, size, size):
        found.append(np.unpackbits(np.frombuffer(blob, np.uint8, (n + 7) // 8, at), count=n).astype(bool))
        at += (n + 7) // 8
    occupied, ends, counters = found
    slots = np.zeros((size, 8), np.uint8)
    slots[:, : (r + 7) // 8] = np.frombuffer(blob, np.uint8, offset=at).reshape(size, -1)
    homes, last = np.flatnonzero(occupied), np.flatnonzero(ends)
    start = np.maximum(homes, np.append(-1, last[:-1]) + 1) if len(homes) else homes
    length = last - start + 1
    place = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
    body, counter = slots.view("<u8").ravel()[place], counters[place]
    heads = np.flatnonzero(~counter)
    values = (np.repeat(homes, length)[heads].astype(np.uint64) << np.uint64(r)) | body[heads]
    counts, digit = np.ones(len(heads), np.int64), np.flatnonzero(counter)
    item = np.cumsum(~counter)[digit] - 1
    np.add.at(counts, item, body[digit].astype(np.int64) << (DIGIT * (digit - heads[item] - 1)))
    return values, counts


def merge_sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of values with the summed counts; the stable sort merges the sorted runs."""
    values, counts = np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _pieces(values: np.ndarray, counts: np.ndarray, prefix: int, width: int, source: int) -> dict:
    """The values, of `width` bits below `prefix`, as one filter for each of their next ranges."""
    low = np.uint64(width - FAN_BITS)
    cuts = np.searchsorted(values >> low, np.arange((1 << FAN_BITS) + 1, dtype=np.uint64))
    made: dict = {"prefix": [], "source": [], "filter": []}
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            made["prefix"].append(prefix << FAN_BITS | k)
            made["source"].append(source)
            made["filter"].append(pack_filter(values[a:b] & np.uint64((1 << int(low)) - 1), counts[a:b], int(low)))
    return made


_PIECE = "prefix bigint, source bigint, filter binary"


def _built(rows: DataFrame) -> DataFrame:
    """The filters of each partition of rows (fp), split by their first ranges."""

    def run(batches):
        held, n = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            return pa.table(_pieces(values, counts, 0, 64, TaskContext.get().partitionId()), schema=schema).to_batches()

        for batch in batches:
            held.append(np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)))
            n += batch.num_rows
            if n >= FILTER_ROWS:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    schema = pa.schema([("prefix", pa.int64()), ("source", pa.int64()), ("filter", pa.binary())])
    return rows.select("fp").mapInArrow(run, _PIECE)


def _merged(pieces: DataFrame, levels: int, last: bool) -> DataFrame:
    """Merge the filters of each range and of each 64 sources; `last` gives fingerprints instead."""
    width = 64 - FAN_BITS * levels

    def step(slices):
        key, parts = None, []

        def done():
            values, counts = merge_sorted(parts)
            if not last:
                return _pieces(values, counts, key[0], width, key[1])
            more = counts > 1
            whole = values[more] | np.uint64(key[0] << width if width < 64 else 0)
            return {"fp": whole.view(np.int64), "copies": counts[more]}

        for part in slices:
            for prefix, source, blob in zip(part["prefix"], part["source"], part["filter"], strict=True):
                if key != (prefix, source):
                    if parts:
                        yield done()
                    key, parts = (prefix, source), []
                parts.append(unpack_filter(blob))
                if len(parts) > 1 << FAN_BITS:
                    parts = [merge_sorted(parts)]
        if parts:
            yield done()

    pieces = pieces.withColumn("source", F.shiftright("source", FAN_BITS) if not last else F.lit(0).cast("bigint"))
    dealt = pieces.repartition("prefix", "source").sortWithinPartitions("prefix", "source")
    return map_rows(dealt, step, "fp bigint, copies bigint" if last else _PIECE, 16 << 20)


def repeated_fingerprints(rows: DataFrame) -> DataFrame:
    """(fp, copies) of the fingerprints that several of the stored rows (fp) have.

    A task's filter is cut into 64 ranges; a level merges the same range of 64 sources and cuts
    it into 64 ranges more, until one source is left. So each level sends 64 pieces for each
    partition, in proportion to the input, and takes about a partition's share into a task.
    """
    sources, levels, pieces = rows.rdd.getNumPartitions(), 1, _built(rows)
    while sources > 1 << FAN_BITS:
        pieces = _merged(pieces, levels, last=False)
        sources, levels = -(-sources >> FAN_BITS), levels + 1
    return staged(_merged(pieces, levels, last=True), "repeated")


def _salted(rows: DataFrame, groups: DataFrame, keys: list[str], how: str) -> DataFrame:
    """`rows` joined with `groups` (with `copies`) on `keys`, groups of over HOT_ROWS rows split by row."""
    parts = F.ceil(F.col("copies") / HOT_ROWS).cast("int")
    hot = F.broadcast(groups.where(F.col("copies") > HOT_ROWS).groupBy("fp").agg(F.max(parts).alias("_parts")))
    spread = F.pmod(F.xxhash64("doc_id", "mark"), F.coalesce("_parts", F.lit(1)))
    left = rows.join(hot, "fp", "left").withColumn("_salt", spread.cast("int")).drop("_parts")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    right = groups.join(hot, "fp", "left").withColumn("_salt", salts).drop("_parts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _grouped(docs: DataFrame, mark: Column) -> DataFrame:
    """doc_id, mark, sha, first (struct of the row that stays) and copies for each row of docs."""
    text = normalised(F.col("text"))
    read = docs.select("doc_id", mark.alias("mark"), F.xxhash64(text).alias("fp"), text.alias("body"))
    rows = staged(read.select("doc_id", "mark", "fp", F.unhex(F.sha2("body", 256)).alias("sha")), "fingerprints")
    routed = repeated_fingerprints(rows)
    if routed.count() <= ROUTED_BROADCAST:
        texts = read.join(F.broadcast(routed.select("fp")), "fp", "left_semi")
    else:
        texts = _salted(read, routed, ["fp"], "left_semi")
    # Grouping by the text itself compares bytes; a task sends each distinct text once.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    classes = texts.groupBy("fp", "body").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    classes = staged(classes.select("fp", F.unhex(F.sha2("body", 256)).alias("sha"), "first", "copies"), "classes")
    back = _salted(rows, classes.where("copies > 1"), ["fp", "sha"], "left")
    return back.select("doc_id", "mark", "sha", F.coalesce("first", order).alias("first"), F.coalesce("copies", F.lit(1)).alias("copies"))


def class_rows(docs: DataFrame) -> DataFrame:
    """For each row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    found = _grouped(docs, F.lit(0).cast("bigint"))
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without exact copies: one row of each group of equal texts, with all its columns."""
    inner = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("mark")), "documents")
    found = _grouped(inner.select("row.doc_id", "row.text", "mark"), F.col("mark"))
    stay = found.where(F.col("mark") == F.col("first.mark")).select("mark")
    return inner.join(stay, "mark", "left_semi").select("row.*")
