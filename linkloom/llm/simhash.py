"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 bits; two link at MOST_BITS or fewer differing bits. Equal fingerprints
collapse first, so copies cost one row.

The bits are grouped into PARTS partitions, correlated bits together (correlations come from all
fingerprints). If two fingerprints differ in at most t bits, then for any integers t_1..t_m >= -1
with sum t - m + 1 there is a partition i with at most t_i differing bits (-1: never). Each
fingerprint takes its own thresholds: a dynamic program chooses, under that sum, those with the
fewest candidates, estimated for its own bits from the bits' frequencies. It then probes each
partition's values within t_i of its own; every fingerprint lies under its own value in each
partition, so the pair is found from either side, and candidates are compared in full.

Linked fingerprints are joined by a forest within each bucket, so a bucket of n gives at most n - 1
edges and never all its pairs. Components come from the edges.

Rows: null or wordless text has fingerprint 0, which links like any other. A null id has a
fingerprint and a component but names no component unless all of it is null.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from linkloom.llm.common import components, map_rows, staged, text_udf, utf8

BITS, MOST_BITS, PARTS, SHINGLE, SEED = 64, 4, 3, 4, 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[: len(words) - shingle]]
        hashes = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        h = np.array(hashes[i : i + (1 << 16)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints():
    return text_udf(lambda: lambda texts: {"f": [signed(fingerprint(t)) for t in texts]}, "f bigint")


def bit_table(f: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones, the highest bit first, for each fingerprint."""
    return np.unpackbits(f.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def correlated_groups(prints: DataFrame, parts: int = PARTS) -> tuple[list[list[int]], np.ndarray]:
    """Bits grouped by correlation over all fingerprints, and each bit's frequency of 1."""

    def count(slices):
        both = np.zeros((BITS, BITS))
        n = 0
        for part in slices:
            b = bit_table(np.array(part["f"], np.int64)).astype(np.float64)
            both += b.T @ b
            n += len(b)
        at = np.arange(BITS * BITS)
        yield {"at": [*at.tolist(), -1], "n": [*both.reshape(-1).astype(np.int64).tolist(), n]}

    rows = map_rows(prints.select("f"), count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    got = {r["at"]: r["n"] for r in rows}
    n = max(1, got.get(-1, 0))
    return group_bits(np.array([got.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS) / n, parts)


def group_bits(both: np.ndarray, parts: int) -> tuple[list[list[int]], np.ndarray]:
    """Bits grouped by correlation, and each bit's frequency, from how often each two bits are both 1."""
    p = both.diagonal().copy()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups, p


def thresholds(bits: np.ndarray, groups: list[list[int]], p: np.ndarray, n: int, most: int = MOST_BITS) -> np.ndarray:
    """The threshold of each partition for each fingerprint, by dynamic programming.

    The cost of threshold t in a partition is the candidates expected there, n times the chance that
    a fingerprint with the bits' frequencies lies within t, plus one for each value probed.
    """
    rows, total = len(bits), most - len(groups) + 1
    differs = np.where(bits == 1, 1 - p, p)
    top = max(total + len(groups) - 1, 0)
    costs = []
    for g in groups:
        near = np.zeros((rows, top + 1))
        near[:, 0] = 1
        for b in g:
            d = differs[:, b : b + 1]
            near[:, 1:] = near[:, 1:] * (1 - d) + near[:, :-1] * d
            near[:, :1] *= 1 - d
        probes = np.cumsum([_choose(len(g), k) for k in range(top + 1)])
        costs.append(np.hstack([np.zeros((rows, 1)), n * np.cumsum(near, axis=1) + probes]))  # column t + 1
    width = total + len(groups) + 1  # sums of (t_i + 1)
    best = np.full((rows, width), np.inf)
    best[:, 0] = 0
    choice = []
    for c in costs:
        new, took = np.full((rows, width), np.inf), np.zeros((rows, width), np.int8)
        for s in range(width):
            for k in range(min(s, top + 1) + 1):
                v = best[:, s - k] + c[:, k]
                better = v < new[:, s]
                new[better, s], took[better, s] = v[better], k
        best = new
        choice.append(took)
    out, s = np.zeros((rows, len(groups)), np.int8), np.full(rows, total + len(groups))
    for i in range(len(groups) - 1, -1, -1):
        k = choice[i][np.arange(rows), s]
        out[:, i] = k - 1
        s = s - k
    return out


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _flips(width: int, t: int) -> np.ndarray:
    """All masks of t bits among `width`."""
    made = [sum(1 << b for b in c) for c in combinations(range(width), t)]
    return np.array(made, np.int64)


def forest(f: np.ndarray, own: np.ndarray, most: int = MOST_BITS) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the links that have an `own` end.

    Each own member is compared with those that it isn't joined to yet, so a dense group costs
    little more than its size, and a group without links costs own x size comparisons.
    """
    f = f.astype(np.int64).view(np.uint64)  # bitwise_count takes a signed number's absolute value
    label, edges = np.arange(len(f)), []
    for x in np.flatnonzero(own).tolist():
        rest = np.flatnonzero(label != label[x])
        if not len(rest):
            if (label == label[0]).all():
                break
            continue
        near = rest[np.bitwise_count(f[rest] ^ f[x]) <= most]
        if len(near):
            joined, first = np.unique(label[near], return_index=True)
            edges.extend((x, int(near[i])) for i in first)
            label[np.isin(label, joined)] = label[x]
    return edges


def keys(f: np.ndarray, groups: list[list[int]], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fingerprint, own) of each fingerprint's own values and of the values it probes."""
    key, at, own = places(f, groups, allowed)
    return key, f[at], own


def places(f: np.ndarray, groups: list[list[int]], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `keys`, with the position of the fingerprint in place of it."""
    bits, out = bit_table(f).astype(np.int64), []
    for i, g in enumerate(groups):
        value = bits[:, g] @ (1 << np.arange(len(g)))
        out.append((value | i << 32, np.arange(len(f)), np.ones(len(f), bool)))
        for t in range(1, int(allowed[:, i].max(initial=0)) + 1):
            # The masks of exactly t bits, for those whose threshold reaches t.
            at, masks = np.flatnonzero(allowed[:, i] >= t), _flips(len(g), t)
            out.append((((value[at, None] ^ masks[None]) | i << 32).reshape(-1), np.repeat(at, len(masks)), np.zeros(len(at) * len(masks), bool)))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def links(prints: DataFrame, most: int = MOST_BITS, parts: int = PARTS) -> DataFrame:
    """Edges (a, b) that join distinct fingerprints of prints (f) exactly as their links do."""
    groups, p = correlated_groups(prints, parts)
    n = prints.count()

    def probe(slices):
        for part in slices:
            f = np.array(part["f"], np.int64)
            for i in range(0, len(f), 4096):
                g = f[i : i + 4096]
                key, prints, own = keys(g, groups, thresholds(bit_table(g), groups, p, n, most))
                yield {"key": key, "f": prints, "own": own}

    def verify(slices):
        key, f, own = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

        def edges(key, f, own):
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(key)]
            has = np.logical_or.reduceat(own, starts) & (ends - starts > 1) if len(key) else np.zeros(0, bool)
            out = []
            for s, e in zip(starts[has].tolist(), ends[has].tolist(), strict=True):
                out.extend((f[s + i], f[s + j]) for i, j in forest(f[s:e], own[s:e], most))
            return {"a": [int(x) for x, _ in out], "b": [int(y) for _, y in out]}

        for part in slices:  # sorted by key: all but the last key are complete
            key, f, own = np.r_[key, part["key"]], np.r_[f, part["f"]], np.r_[own, part["own"]].astype(bool)
            last = int(np.searchsorted(key, key[-1]))
            yield edges(key[:last], f[:last], own[:last])
            key, f, own = key[last:], f[last:], own[last:]
        yield edges(key, f, own)

    probed = map_rows(prints.select("f"), probe, "key bigint, f bigint, own boolean")
    return map_rows(probed.repartition("key").sortWithinPartitions("key"), verify, "a bigint, b bigint")


def group_rows(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of docs (doc_id, text)."""
    rows = staged(docs.select("doc_id", _fingerprints()(utf8(F.col("text")))["f"].alias("f")), "fingerprints")
    prints = rows.groupBy("f").agg(F.min("doc_id").alias("first"))
    roots = components(links(prints, most))
    placed = prints.join(roots, prints["f"] == roots["node"], "left").select("f", "first", F.coalesce("root", "f").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("f", "component_id")
    return rows.join(named, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """One row of docs, with all its columns, for each group: the one with the smallest id.

    Of several rows with that id the one with the least hash stays, of equal rows one. A row without
    an id stays only if no row of its group has one.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    # A row is known by 128 bits of hash over all its columns.
    marks = [F.xxhash64(*own).alias("_h"), F.xxhash64(F.lit(1), *own).alias("_g")]
    rows = staged(docs.select("doc_id", *marks, _fingerprints()(utf8(F.col("text")))["f"].alias("f")), "fingerprints")
    prints = rows.groupBy("f").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h", "_g")).alias("first"))
    roots = components(links(prints, most))
    placed = prints.join(roots, prints["f"] == roots["node"], "left").select("first", F.coalesce("root", "f").alias("root"))
    stay = placed.groupBy("root").agg(F.min("first").alias("s")).select(F.col("s._h").alias("_h"), F.col("s._g").alias("_g"))
    marked = docs.select(F.struct(*own).alias("row"), *marks)
    # The semi join deals rows by their marks; equal rows then meet without another shuffle.
    return marked.join(stay, ["_h", "_g"], "left_semi").groupBy("_h", "_g").agg(F.first("row").alias("row")).select("row.*")
