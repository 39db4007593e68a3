"""Near-duplicate texts: SimHash and the generalised pigeonhole principle, verified by Jaccard similarity.

Two texts link if their sets of SHINGLE-word shingles have a Jaccard similarity of LEAST_JACCARD or
more. Equal sets collapse first. Candidates come from op 5's method (`simhash.py`), over TABLES SimHash
fingerprints of a set:

1. The bits of each fingerprint are grouped into PARTS partitions by correlation, a dynamic program
   chooses each fingerprint's thresholds, and it probes its partitions' values within them. Sets that
   differ in MOST bits of a fingerprint or fewer meet for certain. At a similarity of 0.8 a bit differs
   with a chance of 0.15, so a partition of 16 bits agrees with 0.07, and one of TABLES * PARTS with 0.9999
   (0.99 for sets of 4 and 5, whose bits tie often).
2. Members of a bucket are candidates at NEAR or fewer differing bits of that fingerprint, and go on if
   the bits of all fingerprints differ in no more than FAR says.
3. Each of those is verified by its sets, so no false link is made.

A bucket gives its pairs of candidates, FIRST for each member at most. One with more gives no pair but the lists of
members that candidates join, a row for each. Nodes that such lists join are a cluster, dealt into blocks of about
SMALL * MORE nodes (or SETS shingles). A block is resolved in its task, with all fingerprints and with the sets:
each node is verified against its nearest of other components until one links, so that only links leave the
task. Then the nodes outside a cluster's largest component are compared with its other blocks, after their
fingerprints have told which of them hold a candidate. So no row stands for a pair of a dense group; the comparisons
in memory grow with the square of a cluster, dealt over its blocks. A bucket is in one task, as 8-byte numbers.

Rows: null or wordless text has the empty set, which equals itself and links to nothing else. A text
of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from linkloom.llm.common import Forest, components, map_rows, mix64, staged, text_udf, utf8
from linkloom.llm.simhash import BITS, bit_table, forest, group_bits, places, signed, thresholds

SHINGLE, LEAST_JACCARD, SEED = 5, 0.8, 42
TABLES, PARTS, MOST, NEAR = 32, 4, 3, 12
#: Differing bits of all fingerprints, for sets of fewer than FEW shingles (their bits tie often) and for others.
#: At a similarity of 0.8 their mean is 383 at 4 shingles and 310 at many, their deviation 16 to 17.
FAR, FEW = (455, 380), 32
#: Pairs of a bucket for each member; members of a bucket that gives all its pairs, nodes of a block for each of
#: these, and members of a bucket compared with all at a time.
FIRST, MORE, SMALL, CHUNK = 2, 64, 8, 256
#: Shingles of a block.
SETS = 1 << 20
#: Pairs of one text in a group.
GROUP = 1000

_rng = np.random.default_rng(5)
_FACTORS = _rng.integers(0, 2**63, TABLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, TABLES, dtype=np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - SHINGLE]]
    return np.array(sorted({xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=True)}), np.uint64)


def sketch(found: np.ndarray) -> list[int]:
    """The fingerprints of a set. Sets of fewer than 4 can only link to equal ones and have none."""
    if len(found) < 4:
        return []
    ones = np.zeros(TABLES * BITS, np.int64)
    for i in range(0, len(found), 256):
        h = mix64(found[i : i + 256, None] * _FACTORS + _SHIFTS)
        ones += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.uint16)
    return np.packbits(2 * ones > len(found)).view(np.int64).tolist()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _sets():
    def step(texts):
        out = {"node": [], "n": [], "prints": []}
        for t in texts:
            found = shingles(t)
            out["node"].append(signed(xxh64_intdigest(found.tobytes(), SEED)))
            out["n"].append(len(found))
            out["prints"].append(sketch(found))
        return out

    return text_udf(lambda: step, "node bigint, n bigint, prints array<bigint>")


def partitions(nodes: DataFrame) -> list[tuple[list[list[int]], np.ndarray]]:
    """For each fingerprint its bits grouped by correlation, and each bit's frequency of 1."""
    half = np.triu_indices(BITS)

    def count(slices):
        both, n = np.zeros((TABLES, BITS, BITS)), 0
        for part in slices:
            f = np.array(part["prints"], np.int64)
            for t in range(TABLES):
                b = bit_table(f[:, t]).astype(np.float32)
                both[t] += b.T @ b
            n += len(f)
        counts = both[:, *half].reshape(-1).astype(np.int64)
        yield {"at": [*range(len(counts)), -1], "n": [*counts.tolist(), n]}

    rows = map_rows(nodes.select("prints"), count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 66,561 rows
    got = {r["at"]: r["n"] for r in rows}
    out, size = [], len(half[0])
    for t in range(TABLES):
        both = np.zeros((BITS, BITS))
        both[half] = [got.get(t * size + i, 0) for i in range(size)]
        both = np.maximum(both, both.T) / max(1, got.get(-1, 0))
        out.append(group_bits(both, PARTS))
    return out


def probed(nodes: DataFrame) -> DataFrame:
    """key, f, node, own: the values of its fingerprints' partitions that each node has (own) or probes."""
    grouped, n = partitions(nodes), nodes.count()

    def step(slices):
        for part in slices:
            every, f = np.array(part["node"], np.int64), np.array(part["prints"], np.int64)
            for t, (groups, p) in enumerate(grouped):
                mine = f[:, t]
                key, at, own = places(mine, groups, thresholds(bit_table(mine), groups, p, n, MOST))
                yield {"key": key | t << 40, "f": mine[at], "node": every[at], "own": own}

    return map_rows(nodes.select("node", "prints"), step, "key bigint, f bigint, node bigint, own boolean", 1 << 20)


def _small(key, f, node, own):
    """(a, b): the candidates of buckets of at most SMALL members, sorted by key."""
    out = [np.zeros((0, 2), np.int64)]
    for d in range(1, SMALL):
        at = np.flatnonzero(key[d:] == key[:-d])
        if not len(at):
            break
        at = at[(own[at] | own[at + d]) & (np.bitwise_count(f[at] ^ f[at + d]) <= NEAR)]
        out.append(np.c_[node[at], node[at + d]])
    return np.concatenate(out)


def _large(f, node, own, most: int):
    """The candidates of one bucket, or None if there are more than `most` for each member."""
    out, n, m = [np.zeros((0, 2), np.int64)], 0, len(f)
    for start in range(0, m, CHUNK):
        end = min(start + CHUNK, m)
        near = np.bitwise_count(f[start:end, None] ^ f[None, start:]) <= NEAR
        i, j = np.nonzero(np.triu(near & (own[start:end, None] | own[None, start:]), 1))
        n += len(i)
        if n > most * m:
            return None
        out.append(np.c_[node[start + i], node[start + j]])
    return np.concatenate(out)


def _joined(f, node, own) -> list[list[int]]:
    """The members of one bucket that candidates join, a list for each group."""
    groups, found = Forest(len(f)), {}
    edges = forest(f.view(np.int64), own, NEAR)
    for i, j in edges:
        groups.join(i, j)
    for i in sorted({i for edge in edges for i in edge}):
        found.setdefault(groups.root(i), []).append(int(node[i]))
    return list(found.values())


def candidates(buckets: DataFrame, most: int = FIRST, apart: bool = True) -> DataFrame:
    """x, y (x < y): the candidates of buckets (key, f, node, own); or key, members: the members of a dense bucket.

    `apart`: a row for each group of members that candidates join. Else one for the bucket.
    """

    def step(slices):
        names = ("key", "f", "node", "own")
        held: list[list[np.ndarray]] = []

        def joined():
            return [np.concatenate(c) for c in zip(*held, strict=True)]

        def made(columns):
            key = columns[0]
            if not len(key):
                return
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            few = np.repeat(sizes <= SMALL, sizes)
            pairs, keys, members = [_small(*(c[few] for c in columns))], [], []
            for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
                own = [c[s : s + n] for c in columns[1:]]
                found = _large(*own, most)
                if found is None:
                    lists = _joined(*own) if apart else [own[1].tolist()]
                    keys += [int(key[s])] * len(lists)
                    members += lists
                else:
                    pairs.append(found)
            pairs = np.concatenate(pairs)
            pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
            yield {"x": pairs[:, 0], "y": pairs[:, 1], "key": [None] * len(pairs), "members": [None] * len(pairs)}
            if keys:
                yield {"x": [None] * len(keys), "y": [None] * len(keys), "key": keys, "members": members}

        for part in slices:  # sorted by key: all but the last are complete
            held.append([np.array(part["f"], np.int64).view(np.uint64) if n == "f" else np.array(part[n]) for n in names])
            if held[0][0][0] == held[-1][0][-1]:
                continue  # one key so far
            columns = joined()
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            yield from made([c[:last] for c in columns])
            held = [[c[last:] for c in columns]]
        if held:
            yield from made(joined())

    dealt = buckets.select("key", "f", "node", "own").repartition("key").sortWithinPartitions("key")
    return map_rows(dealt, step, "x bigint, y bigint, key bigint, members array<bigint>")


def clusters(lists: DataFrame) -> DataFrame:
    """node, root: the nodes that lists (members) join, roots too."""

    def step(slices):
        up: dict[int, int] = {}  # a node of each task's own lists, once

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for part in slices:
            for members in part["members"]:
                first = root(members[0])
                for x in members[1:]:
                    up[root(x)] = first
        yield {"a": list(up), "b": [root(x) for x in up]}

    found = components(staged(map_rows(lists, step, "a bigint, b bigint"), "joined"), "clusters")
    return found.union(found.select("root", "root").distinct())


def _likely(n, prints, ns, all_prints, least: float) -> np.ndarray:
    """Differing bits of all fingerprints of a node from those of others, 9999 where they tell that it doesn't link."""
    far = np.bitwise_count(all_prints ^ prints).sum(1, dtype=np.int64)
    low, high = np.minimum(ns, n), np.maximum(ns, n)
    far[(far > np.where(low < FEW, FAR[0], FAR[1])) | (low < least * high)] = 9999
    return far


def _met(placed: DataFrame, schema: str, least: float, found: Callable) -> DataFrame:
    """What `found` gives for the nodes of each block.

    placed: cluster, part, ask, node, root, n, prints and, if sets are needed, body. The nodes of a block come before
    those that ask it. `found` is called once for each node, with the block's nodes so far, the likely ones among
    them (nearest first), the node itself and a dictionary of its own for the block; it yields rows.
    """
    names = schema.replace(",", "").split(" ")[::2]
    extra = ["body"] if "body" in placed.columns else []

    def step(slices):
        key = None
        for part in slices:
            out: list[tuple] = []
            for at in range(len(part["node"])):
                if key != (key := (part["cluster"][at], part["part"][at])):
                    held, size, ns, prints, memory = [], 0, np.zeros(64, np.int64), np.zeros((64, TABLES), np.uint64), {}
                one = {c: part[c][at] for c in ("cluster", "part", "ask", "node", "root", "n")}
                if extra:
                    one["set"] = shingles(part["body"][at])
                own = np.array(part["prints"][at], np.int64).view(np.uint64)
                far = _likely(one["n"], own, ns[:size], prints[:size], least)
                near = np.flatnonzero(far < 9999)
                out += found(held, near[np.argsort(far[near], kind="stable")].tolist(), one, memory)
                if not one["ask"]:
                    if size == len(ns):
                        ns, prints = np.r_[ns, ns], np.r_[prints, prints]
                    ns[size], prints[size], size = one["n"], own, size + 1
                    held.append(one)
            yield {c: [r[i] for r in out] for i, c in enumerate(names)}

    columns = ["cluster", "part", "ask", "node", "root", "n", "prints", *extra]
    dealt = placed.select(*columns).repartition("cluster", "part").sortWithinPartitions("cluster", "part", "ask")
    return staged(map_rows(dealt, step, schema), "met")


def _links_met(placed: DataFrame, least: float, asked: bool) -> DataFrame:
    """Links (a, b) that join the components (root) of each block's nodes as all their links do; `asked`: of asking nodes only."""

    def found(held, near, one, up):
        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        if asked and not one["ask"]:
            return
        for i in near:
            a, b = root(one["root"]), root(held[i]["root"])
            if a != b and jaccard(one["set"], held[i]["set"]) >= least:
                up[a] = b
                yield one["node"], held[i]["node"]

    return _met(placed, "a bigint, b bigint", least, found)


def _asks(placed: DataFrame, least: float) -> DataFrame:
    """node, cluster, part: the blocks in which an asking node has a likely one of another component."""

    def found(held, near, one, _):
        if one["ask"] and any(held[i]["root"] != one["root"] for i in near):
            yield one["node"], one["cluster"], one["part"]

    return _met(placed, "node bigint, cluster bigint, part int", least, found)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (x, y) whose sets link. texts: (node, body)."""
    # At most pairs / GROUP rows, so it may be broadcast.
    hot = pairs.groupBy("y").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("y", F.ceil(F.col("n") / GROUP).cast("int").alias("parts"))
    dealt = pairs.join(F.broadcast(hot), "y", "left").select("x", "y", F.pmod(F.xxhash64("x"), F.coalesce("parts", F.lit(1))).cast("int").alias("salt"))
    first = dealt.select("y", "salt").distinct().join(texts, F.col("y") == F.col("node")).select("y", "salt", F.lit(None).cast("bigint").alias("x"), "body")
    rest = dealt.join(texts, F.col("x") == F.col("node")).select("y", "salt", "x", "body")

    def step(slices):
        key, one = None, None
        for part in slices:  # sorted by y and salt, y's own text first
            out = {"a": [], "b": []}
            for y, salt, x, body in zip(part["y"], part["salt"], part["x"], part["body"], strict=True):
                found = shingles(body)
                if x is None:
                    key, one = (y, salt), found
                elif key == (y, salt) and jaccard(one, found) >= least:
                    out["a"].append(x)
                    out["b"].append(y)
            yield out

    met = first.union(rest).repartition("y", "salt").sortWithinPartitions("y", "salt", F.col("x").asc_nulls_first())
    return staged(map_rows(met, step, "a bigint, b bigint"), "near")


def _resolved(nodes: DataFrame, bodies: DataFrame, edges: DataFrame, least: float) -> DataFrame:
    """node, root by edges and by all links within the clusters of nodes (cluster, node, n, prints, mark)."""
    sums = nodes.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    parts = sums.select("cluster", F.ceil(F.greatest(F.col("c") / (SMALL * MORE), F.col("s") / SETS)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = nodes.join(parts, "cluster").select("*", own.alias("part"), F.lit(False).alias("ask"))
    placed = staged(bodies.join(placed, "mark").drop("mark"), "placed")
    edges = edges.union(_links_met(placed.withColumn("root", F.col("node")), least, False))
    roots = components(edges)
    many = placed.where("parts > 1")
    if many.isEmpty():
        return roots
    # Nodes outside the largest component of their cluster are compared with its other blocks.
    rooted = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    largest = rooted.groupBy("cluster", "root").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
    rooted = staged(rooted.join(largest, "cluster"), "rooted")
    asking = rooted.where("root <> largest").withColumn("ask", F.lit(True)).withColumnRenamed("part", "own")
    block = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    asking = asking.drop("body").select("*", block).where("part <> own")
    columns = ["cluster", "part", "ask", "node", "root", "n", "prints"]
    asks = _asks(rooted.select(*columns).union(asking.select(*columns)), least)
    if asks.isEmpty():
        return roots
    told = rooted.drop("part", "ask").join(asks, ["cluster", "node"]).withColumn("ask", F.lit(True))
    used = rooted.join(asks.select("cluster", "part").distinct(), ["cluster", "part"], "left_semi")
    columns.append("body")
    return components(edges.union(_links_met(used.select(*columns).union(told.select(*columns)), least, True)))


def links(nodes: DataFrame, bodies: DataFrame, least: float = LEAST_JACCARD) -> DataFrame:
    """node, root of the components of nodes (node, n, prints, mark). bodies: (mark, body) of the nodes' first rows."""
    spark = nodes.sparkSession
    nodes = nodes.where("size(prints) > 0")
    edges = spark.createDataFrame([], "a bigint, b bigint")
    found = staged(candidates(probed(nodes)), "candidates")
    lists = found.where("key is not null").select("members")
    dense = not lists.isEmpty()
    if dense:
        placed = clusters(lists).select("node", F.col("root").alias("cluster"))
        nodes = nodes.join(placed, "node", "left")
    else:
        nodes = nodes.withColumn("cluster", F.lit(None).cast("bigint"))
    pairs = found.where("key is null").select("x", "y").distinct()
    one, other = (nodes.select(*(F.col(k).alias(v) for k, v in (("node", c), ("n", f"{c}n"), ("prints", f"{c}p"), ("cluster", f"{c}c")))) for c in "xy")
    far = F.aggregate(F.zip_with("xp", "yp", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    limit = F.when(F.least("xn", "yn") < FEW, FAR[0]).otherwise(FAR[1])
    scored = pairs.join(one, "x").join(other, "y").where(F.least("xn", "yn") >= least * F.greatest("xn", "yn"))
    # The pairs of a cluster are resolved there.
    scored = staged(scored.where((far <= limit) & ~F.coalesce(F.col("xc") == F.col("yc"), F.lit(False))).select("x", "y"), "scored")
    if not scored.isEmpty():
        used = scored.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(nodes.select("node", "mark"), "node")
        texts = staged(bodies.join(used, "mark").select("node", "body"), "texts")
        edges = _verified(scored, texts, least)
    if dense:
        return _resolved(nodes.where("cluster is not null"), bodies, edges, least)
    return components(edges)


def keep_first(docs: DataFrame, least: float = LEAST_JACCARD) -> DataFrame:
    """One row of docs, with all its columns, for each group of linked texts: the one with the smallest id.

    Of several rows with that id, equal or not, one stays. A row without an id stays only if no row of
    its group has one. Null and empty texts are one group. Columns of any name and type are kept.
    """
    # The rows are stored with a number, by which they are known from here on.
    given = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("mark")), "rows", compression="zstd")
    docs = given.select("row.doc_id", "row.text", "mark")
    rows = staged(docs.select("doc_id", "mark", _sets()(utf8(F.col("text"))).alias("s")).select("doc_id", "mark", "s.*"), "shingled")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "mark")).alias("first")
    nodes = staged(rows.groupBy("node").agg(first, F.first("n").alias("n"), F.first("prints").alias("prints")), "sets")
    bodies = docs.select("mark", utf8(F.col("text")).alias("body"))
    roots = links(nodes.select("node", "n", "prints", "first.mark"), bodies, least)
    placed = nodes.join(roots, "node", "left").select("first", F.coalesce("root", "node").alias("root"))
    stay = placed.groupBy("root").agg(F.min("first").alias("s")).select(F.col("s.mark").alias("mark"))
    return given.join(stay, "mark", "left_semi").select("row.*")
