"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards. At each level every child of the node reached draws an
exponential variate from a hash of (doc_id, child) divided by the child's weight, and the least
draw wins; a child is so chosen in proportion to its weight. A draw depends on nothing but the id,
the child and its weight. When weights change, only draws of nodes on the changed paths change,
so rows move only between subtrees whose weights change.

A further shard comes as a region of its own (one rack, one shard): no old draw changes, and it
takes rows only into itself.

Rows: a null doc_id is hashed as the empty string. Equal ids share a shard. Null text: size 1 (no byte, plus 1),
crc32 0. Slots are numbered by (chunk, doc_id, crc32), a chunk being a hash class of the id, so
that no task ever sorts a whole shard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.llm.common import utf8

#: Shards of the base tree: 2 regions of 2 racks of 2 shards.
RACK, REGION = 2, 4
BASE = 8
#: Hash classes within a shard for numbering its rows.
CHUNKS = 1024

Tree = dict[str, dict[str, dict[int, float]]]


def standard_tree(shards: int) -> Tree:
    """Shards 0-7 in 2 x 2 x 2; each one beyond them in a region of its own. All weigh 1."""
    tree: Tree = {}
    for s in range(shards):
        region, rack = (f"g{s // REGION}", f"r{s // RACK}") if s < BASE else (f"g+{s}", f"r+{s}")
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def unit(key: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the key's MD5."""
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 1) / F.lit(float(2**52 + 1))


def _draw(key: Column, name: str, weight: float) -> Column:
    return -F.log(unit(F.concat(F.lit(f"{name}:"), key))) / F.lit(weight)


def _descend(key: Column, node: dict, prefix: str) -> Column:
    """The shard that `key` reaches below `node`."""
    kids = {k: v for k, v in node.items() if _weight(v) > 0}
    if not kids:
        raise ValueError(f"no weight below {prefix or 'the root'}")
    below = {k: _descend(key, v, f"{prefix}/{k}") if isinstance(v, dict) else F.lit(int(k)) for k, v in kids.items()}
    if len(kids) == 1:
        return next(iter(below.values()))
    draws = [F.struct(_draw(key, f"{prefix}/{k}", _weight(v)).alias("d"), F.lit(i).alias("k")) for i, (k, v) in enumerate(kids.items())]
    won = F.least(*draws)["k"]
    return reduce(lambda c, x: c.when(won == x[0], x[1]), list(enumerate(below.values()))[1:], F.when(won == 0, below[next(iter(below))]))


def assign(key: Column, tree: Tree) -> Column:
    """The shard of a string key by the tree."""
    return _descend(key, tree, "")


def shard_rows(docs: DataFrame, shards: int = BASE, tree: Tree | None = None, grown: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row of (doc_id, text).

    `tree` and `grown` default to the standard trees of `shards` and of one shard more. No text is
    shuffled: sizes and checksums are computed at the scan, and only they meet the slot numbers.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    chunk = F.conv(F.substring(F.md5(F.concat(F.lit("slot:"), key).cast("binary")), 1, 8), 16, 10).cast("long") % CHUNKS
    placed = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"),
        assign(key, tree or standard_tree(shards)).alias("shard"),
        assign(key, grown or standard_tree(shards + 1)).alias("grown_shard"),
        chunk.alias("chunk"),
    )
    # At most shards x CHUNKS rows; the text isn't read for them.
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["shard", "chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("rank")).cast("long").alias("slot"),
            F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
