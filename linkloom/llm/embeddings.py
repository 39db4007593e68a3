"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is scaled to length 1, padded to a power of two and rotated by three turns of random
signs and a fast Hadamard transform. Its hash is the nearest vertex of the cross-polytope, that is
the coordinate of the largest absolute value and its sign. HASHES of these make a bucket, and a vector
lies in a bucket of each table. Wider vectors get more tables, so that of pairs just above the
threshold at most about one in a thousand is missed at any width (`table_count`). In each table a vector also lies in PROBES - 1 more buckets: those whose vertices
are the next nearest in sum. A pair is a candidate if one's first bucket is among the other's; each
candidate is verified by its cosine in double precision, so no false link is made. The share of
links found is measured against brute force in the tests.

Equal vectors collapse first, with their count. Links are counted inside the buckets and never
written out as pairs: a pair counts in the first bucket, in table order, where it would be found.
For components, each bucket gives the edges of a spanning forest. A bucket of more than BLOCK rows
is dealt into blocks by hash, and each pair of blocks is a group of its own, so no task holds a
large bucket.

Rows: a vector that is null, empty, zero or holds null or non-finite numbers has no link, its own
id as component, and is kept. Vectors of different lengths never link. A repeated row is another
vector. A null vec_id takes part in links; it names a component only if no other id does.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import components, map_rows, staged

LEAST_COSINE = 0.95
HASHES, PROBES = 2, 4
#: Nearest vertices of one hash among which probes are chosen.
NEAREST = 4
BLOCK = 2048
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def table_count(dim: int) -> int:
    """Tables for vectors of a width: five up to 64 numbers, one more for each further factor of four."""
    return 5 + max(0, ((dim - 1).bit_length() - 5) // 2)


def buckets(unit: np.ndarray, tables: int | None = None, probes: int = PROBES) -> np.ndarray:
    """Bucket ids of each row, shape (rows, tables, probes), the first one its own."""
    rows, dim = unit.shape
    tables = tables or table_count(dim)
    wide = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, wide))
    padded[:, :dim] = unit
    rng = np.random.default_rng(SEED)
    near = min(NEAREST, wide)
    out = np.zeros((rows, tables, probes), np.int64)
    for t in range(tables):
        vertex, loss = np.zeros((rows, 1), np.int64), np.zeros((rows, 1))
        for _ in range(HASHES):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], wide))
            at = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(x, at, 1)
            one = at * 2 + (value < 0)
            lost = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            vertex = (vertex[:, :, None] * (2 * wide) + one[:, None]).reshape(rows, -1)
            loss = (loss[:, :, None] + lost[:, None]).reshape(rows, -1)
            best = np.argsort(loss, axis=1, kind="stable")[:, : max(probes, near)]
            vertex, loss = np.take_along_axis(vertex, best, 1), np.take_along_axis(loss, best, 1)
        out[:, t] = vertex[:, :probes]
    return out


def pair_links(vec: np.ndarray, found: np.ndarray, table: int, bucket: int, left: np.ndarray, right: np.ndarray, least: float):
    """Positions (i, j) of links between rows `left` and `right` that count in this bucket.

    `found` holds all buckets of each row as `buckets` gives them. Left and right are the same rows
    or have none in common.
    """
    same = left is right
    own = found[:, table, 0] == bucket
    step = max(1, (1 << 20) // max(1, len(right)))
    for s in range(0, len(left), step):
        a = left[s : s + step]
        i, j = np.nonzero(vec[a] @ vec[right].T >= least)
        i, j = a[i], right[j]
        keep = own[i] | own[j]
        if same:
            keep &= i < j
        i, j = i[keep], j[keep]
        for t in range(table + 1):
            hit_i = (found[j, t] == found[i, t, :1]).any(1)  # i's own bucket is among j's
            hit_j = (found[i, t] == found[j, t, :1]).any(1)
            if t < table:
                keep = ~(hit_i | hit_j)
            else:
                first = np.minimum(np.where(hit_i, found[i, t, 0], np.iinfo(np.int64).max), np.where(hit_j, found[j, t, 0], np.iinfo(np.int64).max))
                keep = first == bucket
            i, j = i[keep], j[keep]
        yield i, j


def valid(vector: F.Column) -> F.Column:
    """True for vectors that may link."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ok & F.exists(vector, lambda x: x != 0)


def link_rows(vectors: DataFrame, least: float = LEAST_COSINE, tables: int | None = None, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding)."""
    rows = vectors.select("vec_id", F.when(F.coalesce(valid(F.col("embedding")), F.lit(False)), F.col("embedding").cast("array<double>")).alias("e"))
    nodes = rows.where("e is not null").groupBy("e").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("node"), "copies", "first", "e"), "vectors")

    def deal(slices):
        for part in slices:
            for dim in sorted({len(e) for e in part["e"]}):
                at = [i for i, e in enumerate(part["e"]) if len(e) == dim]
                vec = np.array([part["e"][i] for i in at], np.float64)
                vec /= np.abs(vec).max(1, keepdims=True)  # neither overflow nor underflow
                vec /= np.linalg.norm(vec, axis=1, keepdims=True)
                found = buckets(vec, tables, probes)
                flat = found.reshape(len(at), -1)
                for t in range(found.shape[1]):
                    for p in range(probes):
                        yield {
                            "dim": [dim] * len(at), "tab": [t] * len(at), "bucket": found[:, t, p], "node": [part["node"][i] for i in at],
                            "copies": [part["copies"][i] for i in at], "unit": list(vec), "found": list(flat),
                        }

    group = ["dim", "tab", "bucket"]
    dealt = map_rows(nodes, deal, "dim int, tab int, bucket bigint, node bigint, copies bigint, unit array<double>, found array<bigint>")
    dealt = staged(dealt, "buckets")
    sizes = dealt.groupBy(*group).agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    cut = sizes.select(*group, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = dealt.join(cut, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", mine)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("blocks", "other")
    order = [*group, "lo", "hi"]

    def verify(slices):
        columns = [*order, "mine", "node", "copies", "unit", "found"]
        held = {c: [] for c in columns}

        def group_links(g):
            vec, node, copies = np.array(g["unit"]), np.array(g["node"]), np.array(g["copies"])
            found = np.array(g["found"]).reshape(len(node), -1, probes)
            mine = np.array(g["mine"])
            lo, hi = g["lo"][0], g["hi"][0]
            left = np.flatnonzero(mine == lo)
            right = left if lo == hi else np.flatnonzero(mine == hi)
            links, label, edges = np.zeros(len(node), np.int64), np.arange(len(node)), []
            for i, j in pair_links(vec, found, g["tab"][0], g["bucket"][0], left, right, least):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                while len(i := i[keep]) if (keep := label[i] != label[j]).any() else 0:
                    j = j[keep]
                    a, b = label[i[0]], label[j[0]]
                    edges.append((node[i[0]], node[j[0]]))
                    label[label == b] = a
            at = np.flatnonzero(links)
            n = len(at)
            return {
                "a": [*node[at].tolist(), *(int(x) for x, _ in edges)],
                "b": [*[None] * n, *(int(y) for _, y in edges)],
                "links": [*links[at].tolist(), *[0] * len(edges)],
            }

        def key(i):
            return tuple(held[c][i] for c in order)

        for part in slices:  # sorted by `order`: the last group may go on
            for c in columns:
                held[c] += part[c]
            n, start = len(held["node"]), 0
            for i in range(1, n):
                if key(i) != key(i - 1):
                    if i - start > 1:
                        yield group_links({c: held[c][start:i] for c in columns})
                    start = i
            held = {c: held[c][start:] for c in columns}
        if len(held["node"]) > 1:
            yield group_links(held)

    met = spread.repartition(*order).sortWithinPartitions(*order)
    made = staged(map_rows(met, verify, "a bigint, b bigint, links bigint", 1 << 20), "links")
    counts = made.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(made.where("b is not null").select("a", "b"))
    named = nodes.join(counts, nodes["node"] == counts["a"], "left").join(roots, "node", "left").select("e", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    least_id = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(least_id, "root").select("e", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.where("e is not null").join(known, "e").select("vec_id", "n_links", "component_id")
    alone = rows.where("e is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
