"""Prediction by partial matching: a byte-context trie trained on part of the corpus scores every text.

A text is its words (A-Z lower-cased) joined by single blanks, and one line end behind them. Each
byte is coded in the context of the ORDER bytes before it (zeros before the first). From the longest
context down: a context that training never saw is passed by; in one that it saw, with T the counts
and D the number of its distinct next bytes, both without the bytes excluded, a next byte seen c
times has probability c / (T + D), and an escape to the shorter context has D / (T + D) and excludes
the bytes seen here. Below order 0 the bytes left are equally likely. The counts are those of the
training texts (a pretrained model), so the cost of a byte depends on its context and itself only.

That makes the trie a table of distinct (context, byte) grams which never has to be in one place:

1. Documents are gathered into blocks. Each sends its distinct grams, with their training counts,
   and its distinct words to buckets. A gram's bucket follows from its last three context bytes, so
   a bucket holds the whole trie below its contexts of order 3. Orders 0 to 2 need the counts of
   byte triples only: 2^24 at most, whatever the corpus; they are broadcast.
2. A bucket sums up and answers each block with the cost of its grams and the counts of its words.
3. Blocks add up the costs over their texts.

Rows: null or wordless text is the line end alone. A null id is in the training part like the id "".
Without any training text all bytes are equally likely and the base counts are 0.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.blocks import by_bucket, gather, open_block, with_answers
from linkloom.llm.common import fold, map_rows, mix64, staged, utf8

ORDER, LOCAL = 5, 3
FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES, BUCKET_BYTES = 12 << 20, 8 << 20
#: Bytes whose grams are sorted at a time; positions that fit beside a gram in 64 bits.
SORTED, BESIDE = 1 << 20, 1 << 16

#: A gram is ORDER context bytes, the nearest first, and the byte itself, in the low 48 bits.
_BYTE = np.uint64(255)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def grams(bodies: list[bytes]) -> np.ndarray:
    """The grams of all bytes of some normalized texts, one text after the other."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    pad = b"\0" * ORDER
    a = np.frombuffer(pad + pad.join(bodies), np.uint8).astype(np.uint64)
    n = len(a) - ORDER
    g = a[ORDER:].copy()
    for j in range(1, ORDER + 1):
        g |= a[ORDER - j : ORDER - j + n] << np.uint64(8 * (ORDER + 1 - j))
    if len(bodies) < 2:
        return g
    keep = np.ones(n, bool)  # the zeros between texts aren't coded
    gaps = np.cumsum(sizes[:-1] + ORDER) - ORDER
    keep[(gaps[:, None] + np.arange(ORDER)).reshape(-1)] = False
    return g[keep]


def distinct(g: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams and how often each is there, or its summed weight."""
    if weight is None:
        g = np.sort(g)
    else:
        o = np.argsort(g, kind="stable")
        g, weight = g[o], weight[o]
    at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    if weight is None:
        return g[at], np.diff(np.r_[at, len(g)])
    return g[at], np.add.reduceat(weight, at) if len(at) else weight[:0]


def _mask(order: int) -> np.uint64:
    """The bits of a gram's `order` nearest context bytes."""
    return np.uint64(((1 << 8 * order) - 1) << 8 * (ORDER + 1 - order))


class _Level:
    """The counts of one order: its (context, byte) keys, and for each context its sums."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts.astype(np.float64)
        context = keys & ~_BYTE
        at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.at, self.context = at, context[at]
        self.total = np.add.reduceat(self.counts, at) if len(at) else np.zeros(0)
        self.kinds = np.diff(np.r_[at, len(keys)]).astype(np.float64)
        self.below = np.zeros(len(at))  # counts, one order lower, of the bytes seen in each context

    def shorter(self, order: int) -> _Level:
        return _Level(*distinct(self.keys & (_mask(order) | _BYTE), self.counts.astype(np.int64)))

    def link(self, lower: _Level, order: int) -> None:
        """Set `below` from the level of `order`, the next lower one."""
        if len(self.keys):
            c = lower.counts[np.searchsorted(lower.keys, self.keys & (_mask(order) | _BYTE))]
            self.below = np.add.reduceat(c, self.at)


def low_levels(triples: np.ndarray, counts: np.ndarray) -> list[_Level]:
    """The levels of orders 0, 1 and 2 from the counts of (two context bytes, byte) keys."""
    levels = [_Level(triples, counts)]
    for order in range(LOCAL - 2, -1, -1):
        levels.insert(0, levels[0].shorter(order))
    for order in range(1, LOCAL):
        levels[order].link(levels[order - 1], order - 1)
    return levels


def costs(asked: np.ndarray, seen: np.ndarray, counts: np.ndarray, low: list[_Level]) -> np.ndarray:
    """log10 probability of each asked gram, from the training grams that share its bucket."""
    high = [_Level(seen, counts)]
    for order in range(ORDER - 1, LOCAL - 1, -1):
        high.insert(0, high[0].shorter(order))
    levels = low + high
    for order in range(LOCAL, ORDER + 1):
        levels[order].link(levels[order - 1], order - 1)
    out, out_total, out_kinds = np.zeros(len(asked)), np.zeros(len(asked)), np.zeros(len(asked))
    left = np.arange(len(asked))
    for order in range(ORDER, -1, -1):
        level = levels[order]
        if not len(level.context) or not len(left):
            continue
        key = asked[left] & (_mask(order) | _BYTE)
        place = np.minimum(np.searchsorted(level.context, key & ~_BYTE), len(level.context) - 1)
        known = level.context[place] == key & ~_BYTE
        at, key, place = left[known], key[known], place[known]
        total, kinds = level.total[place] - out_total[at], level.kinds[place] - out_kinds[at]
        k = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
        hit = level.keys[k] == key
        out[at[hit]] += np.log10(level.counts[k[hit]] / (total + kinds)[hit])
        e = ~hit
        some = e & (kinds > 0)
        out[at[some]] += np.log10(kinds[some] / (total + kinds)[some])
        out_total[at[e]], out_kinds[at[e]] = level.below[place[e]], level.kinds[place[e]]
        done = np.zeros(len(asked), bool)
        done[at[hit]] = True
        left = left[~done[left]]
    out[left] -= np.log10(256 - out_kinds[left])
    return out


class _Block:
    """A block's texts and its distinct grams and words, by bucket and always in the same order."""

    def __init__(self, bodies: list[bytes], ids: list[int | None], buckets: int):
        self.held_out = np.array([crc32(str(i).encode() if i is not None else b"") % FOLDS == HELD_OUT for i in ids], bool)
        # Words are counted and let go text by text: as objects they take many times the text's room.
        self.texts: list[bytes] = []
        counted: dict[bytes, int] = {}
        for body, held in zip(bodies, self.held_out.tolist(), strict=True):
            words = tokens(body)
            for w in words:
                counted[w] = counted.get(w, 0) + (not held)
            self.texts.append(b" ".join(words) + b"\n")
        found, trained = [], []
        for first, last in self._stretches(SORTED):
            for held in (False, True):
                part = [t for t, h in zip(self.texts[first:last], self.held_out[first:last].tolist(), strict=True) if h == held]
                if part:
                    g, n = distinct(grams(part))
                    found.append(g)
                    trained.append((n * (not held)).astype(np.int32))
        self.grams, self.counts = distinct(np.concatenate(found), np.concatenate(trained))
        del found, trained
        bucket = (mix64(self.grams >> np.uint64(8 * (ORDER + 1 - LOCAL))) % np.uint64(buckets)).astype(np.int32)
        self.order = np.argsort(bucket, kind="stable")  # grams stay sorted within a bucket
        self.cut = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        self.of_bucket: dict[int, list[bytes]] = {}
        for w in counted:
            self.of_bucket.setdefault(crc32(w) % buckets, []).append(w)
        self.counted = counted

    def _stretches(self, size: int):
        first, n = 0, 0
        for i, t in enumerate(self.texts):
            if i > first and n + len(t) > size:
                yield first, i
                first, n = i, 0
            n += len(t)
        if first < len(self.texts):
            yield first, len(self.texts)

    def sums(self, cost: np.ndarray) -> np.ndarray:
        """The summed cost of each text; cost is that of the distinct grams."""
        out = []
        for first, last in self._stretches(SORTED):
            g = grams(self.texts[first:last])
            c = np.empty(len(g))
            for i in range(0, len(g), BESIDE):  # sort gram and position as one number
                part = g[i : i + BESIDE]
                both = np.sort(part << np.uint64(16) | np.arange(len(part), dtype=np.uint64))
                key = both >> np.uint64(16)
                new = np.r_[True, key[1:] != key[:-1]]
                known = cost[np.searchsorted(self.grams, key[new])]
                c[i + (both & np.uint64(BESIDE - 1)).astype(np.int64)] = known[np.cumsum(new) - 1]
            sizes = np.fromiter(map(len, self.texts[first:last]), np.int64, last - first)
            out.append(np.add.reduceat(c, np.cumsum(sizes) - sizes))
        return np.concatenate(out)


def _pack(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(3).compress(a if isinstance(a, bytes) else a.tobytes())


def _unpack(b: bytes, kind=None):
    raw = zstandard.ZstdDecompressor().decompress(b)
    return raw if kind is None else np.frombuffer(raw, kind)


def score_rows(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(F.col("text")).alias("body"), F.lit(None).cast("string").alias("extra"))
    blocks = staged(gather(given, BLOCK_BYTES), "blocks").drop("extra")
    size, ends = blocks.select(
        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)),
        F.sum(F.size(F.filter("ids", lambda i: fold(i, FOLDS) != HELD_OUT))),
    ).first()
    buckets, ends = max(12, -(-(size or 0) // BUCKET_BYTES)), ends or 0

    def ask(slices):
        for part in slices:
            for block, ids, sizes, body in zip(part["block"], part["ids"], part["sizes"], part["body"], strict=True):
                b = _Block(open_block(body, sizes), ids, buckets)
                for k in range(buckets):
                    at, words = b.order[b.cut[k] : b.cut[k + 1]], b.of_bucket.get(k, [])
                    if len(at) or words:
                        yield {
                            "block": [block], "bucket": [k], "grams": [_pack(b.grams[at])], "counts": [_pack(b.counts[at].astype(np.int64))],
                            "words": [_pack(b" ".join(words))], "word_counts": [np.array([b.counted[w] for w in words], np.int64).tobytes()],
                        }

    asked = staged(map_rows(blocks, ask, "block bigint, bucket bigint, grams binary, counts binary, words binary, word_counts binary"), "grams")

    def triples(slices):
        for part in slices:
            g = np.concatenate([_unpack(x, np.uint64) for x in part["grams"]])
            n = np.concatenate([_unpack(x, np.int64) for x in part["counts"]])
            key, count = distinct((g >> np.uint64(8 * (ORDER + 1 - 2))) << np.uint64(8) | g & _BYTE, n)
            yield {"triple": key[count > 0].astype(np.int64), "n": count[count > 0]}

    summed = map_rows(asked.select("grams", "counts"), triples, "triple bigint, n bigint").groupBy("triple").agg(F.sum("n").alias("n"))
    known = summed.toPandas().sort_values("triple")  # 2^24 rows at most
    key = known["triple"].to_numpy(np.uint64)
    spread = (key >> np.uint64(8)) << np.uint64(8 * (ORDER + 1 - 2)) | key & _BYTE
    shared = spark.sparkContext.broadcast((spread, known["n"].to_numpy(np.int64)))

    def answer(rows):
        each = [_unpack(r["grams"], np.uint64) for r in rows]
        g, n = distinct(np.concatenate(each), np.concatenate([_unpack(r["counts"], np.int64) for r in rows]))
        cost = costs(g, g[n > 0], n[n > 0], low_levels(*shared.value))
        words = [_unpack(r["words"]).split() for r in rows]
        total: dict[bytes, int] = {}
        for ws, r in zip(words, rows, strict=True):
            for w, c in zip(ws, np.frombuffer(r["word_counts"], np.int64).tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        sums = [sum(total.values()), sum(1 for c in total.values() if c)]
        for i, (r, own, ws) in enumerate(zip(rows, each, words, strict=True)):
            yield {
                "block": [r["block"]], "bucket": [r["bucket"]], "costs": [_pack(cost[np.searchsorted(g, own)])],
                "known": [_pack(np.array([total[w] for w in ws], np.int64))], "n": [0 if i else sums[0]], "v": [0 if i else sums[1]],
            }

    answers = staged(by_bucket(asked, answer, "block bigint, bucket bigint, costs binary, known binary, n bigint, v bigint"), "costs")
    n, v = answers.agg(F.sum("n"), F.sum("v")).first()
    n, v = (n or 0) + ends, (v or 0) + (ends > 0)

    def score(row, by):
        b = _Block(open_block(row["body"], row["sizes"]), row["ids"], buckets)
        cost, count = np.zeros(len(b.grams)), {}
        for k in by["costs"]:
            cost[b.order[b.cut[k] : b.cut[k + 1]]] = _unpack(by["costs"][k], np.float64)
            count.update(zip(b.of_bucket.get(k, []), _unpack(by["known"][k], np.int64).tolist(), strict=True))
        sizes, logs, known = [], [], []
        for text in b.texts:
            words = text.split()
            c = np.fromiter(map(count.__getitem__, words), np.float64, len(words))
            sizes.append(len(words))
            logs.append(np.log10(c + 1).sum())
            known.append(np.count_nonzero(c))
        logs, known, tokens_each = np.array(logs), np.array(known), np.array(sizes) + 1
        base = logs + np.log10(ends + 1) - tokens_each * np.log10(n + v + 1)
        return {
            "doc_id": row["ids"], "held_out": b.held_out, "n_tokens": tokens_each, "n_known": known + (ends > 0),
            "train_tokens": np.full(len(sizes), n), "base_score": base, "score": b.sums(cost),
        }

    kinds = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    return with_answers(blocks, answers.select("block", "bucket", "costs", "known"), score, pa.schema(kinds))
