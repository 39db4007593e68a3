"""Packing token pieces into sequences: shortest pack first over the length histogram.

Each text is tokenized and ends with id 1. It is cut every LENGTH ids; the pieces' lengths (1 to
LENGTH) make a histogram of LENGTH bins at most, the only thing that reaches the driver. There,
lengths go longest first, each into the shortest open pack, all equal packs of a pattern at once,
so the work depends on the histogram and not on the number of documents. The patterns then go
back to the pieces by rank: the r-th piece of a length takes the slot whose range holds r.

Ranks come from counts per (length, chunk), a chunk being a hash class of the piece, so that a
length which many pieces share is never sorted by one task.

Rows: null or empty text is the one id 1. A repeated row is packed as often as it is there.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict
from heapq import heappop, heappush
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.llm.common import staged, text_udf, utf8

LENGTH = 2048
END = 1
CHUNKS = 256

class TextEncoder:
    """Exactly the ids of a byte-level BPE tokenizer file.

    Where a file's ids follow its merges, the merge ranks are the ids, and the texts go through a
    rank encoder, which is several times faster; the file's special strings, files of another form
    and texts that the rank encoder refuses go through the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = self._rank_encoder(path)

    @staticmethod
    def _rank_encoder(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        vocab = model["vocab"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec["normalizer"]
        if not usual or made != list(range(256, 256 + len(made))) or len(vocab) != 256 + len(made) or model["end_of_word_suffix"]:
            return None
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.ranked and len(text) < 10_000_000 and not any(s in text for s in self.special):
            try:
                return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()
            except Exception:  # noqa: BLE001  the pattern engine's limit
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece."""
    end = np.array([END], np.uint32).tobytes()

    def make():
        encoder = TextEncoder(tokenizer_path)

        def step(texts):
            out = {"doc_tokens": [], "crcs": []}
            for text in texts:
                ids = encoder.encode(text.decode()) + end
                out["doc_tokens"].append(len(ids) // 4)
                out["crcs"].append([crc32(ids[i : i + 4 * length]) for i in range(0, len(ids), 4 * length)])
            return out

        return step

    split = text_udf(make, "doc_tokens bigint, crcs array<bigint>")
    cut = docs.select("doc_id", split(utf8(F.col("text"))).alias("t")).select("doc_id", "t.doc_tokens", F.posexplode("t.crcs").alias("k", "ids_crc32"))
    start = F.col("k").cast("long") * length
    return cut.select("doc_id", start.alias("start"), F.least(F.lit(length), F.col("doc_tokens") - start).cast("long").alias("length"), "ids_crc32", "doc_tokens")


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of piece lengths and how often each is used, by shortest pack first."""
    packs: dict[int, list] = defaultdict(list)  # free space -> [(pattern, count)]
    spaces: list[int] = []  # a heap of the negated free spaces

    def put(space: int, pattern: tuple[int, ...], count: int) -> None:
        if not packs[space]:
            heappush(spaces, -space)
        packs[space].append((pattern, count))

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left and spaces and -spaces[0] >= size:
            space = -spaces[0]
            if not packs[space]:
                heappop(spaces)
                continue
            pattern, n = packs[space].pop()
            used = min(n, left)
            if n > used:
                packs[space].append((pattern, n - used))
            put(space - size, (*pattern, size), used)
            left -= used
        # What is left opens packs. Each takes as many pieces of this length as it holds.
        each = length // size
        full, rest = divmod(left, each)
        for count, k in ((full, each), (1, rest)):
            if count and k:
                put(length - k * size, (size,) * k, count)
    return [x for found in packs.values() for x in found]


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, slots of it a sequence, offset of the first).

    Equal lengths stand side by side in a pattern, so k slots of a length take ranks k by k.
    """
    made, at, base = [], defaultdict(int), 0
    for pattern, count in sorted(found, reverse=True):
        offset, i = 0, 0
        while i < len(pattern):
            size, k = pattern[i], 1
            while i + k < len(pattern) and pattern[i + k] == size:
                k += 1
            made.append((size, at[size], at[size] + k * count, base, k, offset))
            at[size] += k * count
            offset += k * size
            i += k
        base += count
    return made


def pack(spark: SparkSession, cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to the pieces of `pieces`."""
    parts = staged(cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(CHUNKS)).cast("int")), "pieces")
    counts = parts.groupBy("length", "chunk").count()  # length x CHUNKS rows at most
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    ranges = slots(patterns(histogram, length))
    before = W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = W.partitionBy("length", "chunk").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        parts.withColumn("r", F.row_number().over(within) - 1)
        .join(starts, ["length", "chunk"])
        .withColumn("rank", F.col("first") + F.col("r"))
    )
    # The ranges of one length, in rank order, are one row of the slot table: at most `length` rows.
    by_length = defaultdict(list)
    for size, *rest in ranges:
        by_length[size].append(tuple(rest))
    kind = "length bigint, slots array<struct<lo:bigint,hi:bigint,base:bigint,k:int,at:int>>"
    table = spark.createDataFrame([(s, v) for s, v in by_length.items()], kind)
    # Each length adds three patterns at most, so the sequence length bounds the table, not the data; it may be broadcast.
    one = F.broadcast(table.select("length", F.explode("slots").alias("s")).select("length", "s.*"))
    hit = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    step = F.col("rank") - F.col("lo")
    return (
        ranked.join(one, "length").where(hit)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("base") + F.floor(step / F.col("k"))).cast("long").alias("sequence_id"),
            (F.col("at") + (step % F.col("k")) * F.col("length")).cast("long").alias("offset"),
        )
    )


def pack_rows(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """The pieces of docs (doc_id, text) with the sequence and the offset that each one got."""
    return pack(docs.sparkSession, pieces(docs, tokenizer_path, length), length)
