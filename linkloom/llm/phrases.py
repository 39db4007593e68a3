"""Phrase collocations by dynamic itemset counting.

The texts are dealt into shards that are scanned in a cycle. Words are counted from the first scan on;
a phrase of two or three words starts to be counted at the scan after both its subphrases (without
the last and without the first word) have reached the threshold, and is counted for one full
cycle, so its count is exact whenever it starts. Lengths are thus interleaved: one scan counts
words, pairs and triples side by side, and scans end when no phrase is open.

Whether a subphrase has reached the threshold is looked up in a table of fixed size, by hash: a slot
has reached it once all phrases of the slot together have. Phrases that share a slot may start others
too early, never too late or for less than a full cycle, so a collision costs work and changes no
count. The two tables (words, pairs) take a byte a slot, whatever the input; they are all that the
driver gets and sends.

Texts are lower-cased in A-Z, cut into pieces at `[.,;:!?]` and line ends and into words at blanks and
tabs. A null text has no words, a null language is `und`; repeated rows count as often as they
occur; very long texts are counted whole, in parts of GATHER_BYTES. An empty table gives an empty
result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from linkloom.llm.common import map_rows, mix64, staged, utf8
from linkloom.operators.joins import salted_left_join

#: Shards of a cycle. Every shard is scanned three times at most, once for each length.
SHARDS = 3
#: Slots of the two tables.
WORD_SLOTS, PAIR_SLOTS = 1 << 22, 1 << 26
#: Slots that travel together, compressed.
CHUNK = 1 << 16
#: Bytes of text that a task counts together, and words it numbers at most, before it sends counts on.
GATHER_BYTES, GATHER_WORDS = 32 << 20, 1 << 21
#: A first or last part with more phrases than this is split among tasks.
HOT_ROWS = 1_000_000

LEAST, SHARE, TOP = 10, 50, 2000
ORDER = ("-score", "-a", "phrase")
_NEVER = 100
_CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"," * 10)
#: Phrases with their counts travel in parts of so many, packed: (phrase, slot, n) in one value.
PART = 1 << 16
_COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("part", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])
_DDL = "lang string, size int, part binary, chunk int, counts binary"



class _Texts:
    """The words of one language's texts, numbered as they come; 0 ends a piece."""

    def __init__(self, lang: str):
        self.seed = xxh64_intdigest(lang.encode())
        self.number = {b",": 0}
        self.ids: list[np.ndarray] = []

    def add(self, bodies: list[bytes]) -> None:
        number = self.number
        words = b"\n".join(bodies).lower().translate(_CUTS).replace(b",", b" , ").split()
        for word in set(words).difference(number):
            number[word] = len(number)
        self.ids.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self.ids.append(np.zeros(1, np.int32))

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words in order, and by number the words and their hashes."""
        hashes = np.fromiter((xxh64_intdigest(w, self.seed) for w in self.number), np.uint64, len(self.number))
        return np.concatenate(self.ids), np.array(list(self.number), object), hashes


def _summed(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots in order, each once, with the sums of their counts."""
    order = np.argsort(slots, kind="stable")
    slots, counts = slots[order], counts[order]
    heads = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])[: len(slots)])
    return slots[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _pair_slots(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, slots: int) -> np.ndarray:
    mixed = mix64(hashes[a] * np.uint64(0x9E3779B97F4A7C15) + hashes[b])
    return (mixed & np.uint64(slots - 1)).astype(np.int32)


def _part(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _count(lang: str, texts: _Texts, step: int, shards: int, reached_words: np.ndarray, reached_pairs: np.ndarray, totals: list):
    """Batches of counts of what is open at this step: words, pairs, triples."""
    ids, words, hashes = texts.whole()
    words = pa.array(words, pa.binary())
    opened = lambda first, last: (np.maximum(first, last) < step) & (step <= np.maximum(first, last) + shards)

    def batch(size: int, phrase, slot, n):
        whole = pa.record_batch([phrase, pa.array(slot, pa.int32()), pa.array(n, pa.int64())], names=["phrase", "slot", "n"])
        parts = [_part(whole.slice(at, PART)) for at in range(0, len(n), PART)]
        rows = len(parts)
        return pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), rows), pa.repeat(pa.scalar(size, pa.int32()), rows), pa.array(parts, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], schema=_COUNTS)

    slots = (hashes & np.uint64(len(reached_words) - 1)).astype(np.int32)
    if step < shards:
        n = np.bincount(ids, minlength=len(words))
        n[0] = 0
        seen = np.flatnonzero(n)
        totals.append(_summed(slots[seen], n[seen]))
        yield batch(1, words.take(pa.array(seen)), slots[seen], n[seen])
        yield batch(0, pa.array([b""], pa.binary()), [0], [n.sum()])
    if not step:
        return
    reach = reached_words[slots].astype(np.int16)
    reach[0] = _NEVER
    # A word that ends a piece or never was frequent is in no pair that counts.
    at = np.flatnonzero((reach[ids[:-1]] < step) & (reach[ids[1:]] < step))
    a, b = ids[at], ids[at + 1]
    active = opened(reach[a], reach[b])
    code, n = np.unique(a[active].astype(np.int64) << 32 | b[active], return_counts=True)
    first, last = (code >> 32).astype(np.int32), (code & 0xFFFFFFFF).astype(np.int32)
    pair = _pair_slots(hashes, first, last, len(reached_pairs))
    totals.append(_summed(pair + len(reached_words), n))
    yield batch(2, pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(last)), b" "), pair, n)
    if step == 1:
        return
    # A pair can't have reached it before its words, even if its slot has.
    pairs = np.full(len(ids), _NEVER, np.int16)
    pairs[at] = np.maximum(reached_pairs[_pair_slots(hashes, a, b, len(reached_pairs))], np.maximum(reach[a], reach[b]))
    at = np.flatnonzero(opened(pairs[:-1], pairs[1:]))
    start, which = np.unique(ids[at].astype(np.int64) << 32 | ids[at + 1], return_inverse=True)
    code, n = np.unique(which.astype(np.int64) << 32 | ids[at + 2], return_counts=True)
    start = start[code >> 32]
    parts = [words.take(pa.array(x)) for x in (start >> 32, start & 0xFFFFFFFF, code & 0xFFFFFFFF)]
    yield batch(3, pc.binary_join_element_wise(*parts, b" "), np.zeros(len(n), np.int32), n)


def _packed(spark: SparkSession, slots: np.ndarray):
    """The slots, compressed, for all tasks: most of them have not been reached, or all have."""
    return spark.sparkContext.broadcast((zstandard.ZstdCompressor(1).compress(slots.tobytes()), len(slots)))


def _unpacked(sent, word_slots: int) -> tuple[np.ndarray, np.ndarray]:
    blob, size = sent.value
    slots = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=size), np.int8)
    return slots[:word_slots], slots[word_slots:]


def _scan(shard: DataFrame, step: int, shards: int, least: int, reached, word_slots: int) -> DataFrame:
    """The counts that one scan of a shard adds, and each task's slot totals in chunks."""
    kind = np.min_scalar_type(least)

    def run(batches):
        words, pairs = _unpacked(reached, word_slots)
        totals: list[tuple[np.ndarray, np.ndarray]] = []
        held: dict[str, _Texts] = {}
        size = 0

        def flush():
            for lang, texts in held.items():
                yield from _count(lang, texts, step, shards, words, pairs, totals)

        for batch in batches:
            rows = max(1, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows).to_pydict()
                by_lang: dict[str, list[bytes]] = {}
                for lang, body in zip(part["lang"], part["body"], strict=True):
                    by_lang.setdefault(lang, []).append(body)
                for lang, bodies in by_lang.items():
                    held.setdefault(lang, _Texts(lang)).add(bodies)
                    size += sum(map(len, bodies))
                if size >= GATHER_BYTES or any(len(x.number) >= GATHER_WORDS // 2 for x in held.values()):
                    yield from flush()
                    held, size = {}, 0
                    totals = [_summed(*map(np.concatenate, zip(*totals, strict=True)))] if totals else []
        yield from flush()
        if totals:
            slots, counts = _summed(*map(np.concatenate, zip(*totals, strict=True)))
            counts = np.minimum(counts, least).astype(kind)
            chunks = slots // CHUNK
            cuts = np.flatnonzero(np.diff(chunks, prepend=-1, append=-1))
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                sparse = (slots[start:stop] % CHUNK).astype(np.uint16).tobytes() + counts[start:stop].tobytes()
                none = [pa.nulls(1, f.type) for f in _COUNTS][:3]
                yield pa.record_batch([*none, pa.array([chunks[start]], pa.int32()), pa.array([sparse])], schema=_COUNTS)

    return shard.mapInArrow(run, _DDL)


def _slot_totals(counts: DataFrame, least: int, slots: int) -> np.ndarray:
    """Totals of the slots over all tasks of a scan, none above `least`."""
    kind = np.min_scalar_type(least)

    def merge(slices):
        key, total = None, np.zeros(CHUNK, np.int64)

        def done():
            return {"chunk": [key], "counts": [zstandard.ZstdCompressor(1).compress(np.minimum(total, least).astype(kind).tobytes())]}

        for part in slices:
            for chunk, sparse in zip(part["chunk"], part["counts"], strict=True):
                if chunk != key:
                    if key is not None:
                        yield done()
                    key, total = chunk, np.zeros(CHUNK, np.int64)
                n = len(sparse) // (2 + kind.itemsize)
                total[np.frombuffer(sparse, np.uint16, n)] += np.frombuffer(sparse, kind, n, 2 * n)
        if key is not None:
            yield done()

    chunks = counts.where("chunk is not null").select("chunk", "counts").repartition("chunk").sortWithinPartitions("chunk")
    whole = np.zeros((slots // CHUNK, CHUNK), kind)
    for row in map_rows(chunks, merge, "chunk int, counts binary").collect():  # at most a byte a slot, compressed
        blob = zstandard.ZstdDecompressor().decompress(bytes(row["counts"]), max_output_size=CHUNK * kind.itemsize)
        whole[row["chunk"]] = np.frombuffer(blob, kind)
    return whole.ravel()


def frequent_phrases(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, word_slots: int = WORD_SLOTS, pair_slots: int = PAIR_SLOTS) -> DataFrame:
    """(lang, size, phrase, n) of words, pairs and triples that occur `least` times or more.

    The row of size 0 has the number of all words of the language. Both numbers of slots are powers
    of two, CHUNK at least.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    dealt = docs.select(lang, utf8(F.col("text")).alias("body"), F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    # One shard after the other, in stored files of its own; a row keeps its shard in each cycle.
    parts = staged(dealt, "shards", "shard", "zstd")
    reach, totals = np.full(word_slots + pair_slots, _NEVER, np.int8), np.zeros(word_slots + pair_slots, np.min_scalar_type(2 * least))
    scans, step, last = [], 0, shards - 1
    while step <= last:
        sent = _packed(spark, reach)
        shard = parts.where(F.col("shard") == step % shards).select("lang", "body")
        scans.append(staged(_scan(shard, step, shards, least, sent, word_slots), "scan", compression="zstd"))
        totals += _slot_totals(scans[-1], least, len(totals))
        np.minimum(totals, least, out=totals)
        new = (totals >= least) & (reach == _NEVER)
        reach[new] = step
        if new.any():
            last = max(last, step + shards)
        sent.destroy()
        step += 1
    sent = _packed(spark, reach)

    def possible(batches):
        """Phrases of slots that reached the threshold, others can't have; equal ones are added up, as many as fit."""
        words, pairs = (slots < _NEVER for slots in _unpacked(sent, word_slots))
        held: dict[tuple, list[pa.Table]] = {}
        bytes_held = 0

        def flush():
            for (lang, size), tables in held.items():
                summed = pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
                for rows in summed.select(["phrase", "n_sum"]).to_batches(max_chunksize=PART):
                    yield pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(rows)), pa.repeat(pa.scalar(size, pa.int32()), len(rows)), *rows.columns], names=["lang", "size", "phrase", "n"])

        for batch in batches:
            for lang, size, part in zip(*(batch.column(c) for c in ("lang", "size", "part")), strict=True):
                rows = pa.ipc.open_stream(part.as_buffer()).read_all()
                if size.as_py() in (1, 2):
                    reached = words if size.as_py() == 1 else pairs
                    rows = rows.filter(pa.array(reached[rows.column("slot").to_numpy()]))
                held.setdefault((lang.as_py(), size.as_py()), []).append(rows.select(["phrase", "n"]))
                bytes_held += rows.nbytes
                if bytes_held >= GATHER_BYTES:
                    yield from flush()
                    held, bytes_held = {}, 0
        yield from flush()

    packed = [scan.where("part is not null").select("lang", "size", "part") for scan in scans]
    whole = reduce(DataFrame.union, packed).mapInArrow(possible, "lang string, size int, phrase binary, n bigint")
    found = whole.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("size") == 0))
    return staged(found.withColumn("phrase", F.col("phrase").cast("string")), "phrases")


def collocations(found: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of `frequent_phrases`.

    The score is a million times a * a / (l * r) at the cut where that is least, rounded down; of
    equal cuts the first counts. A pair goes if a triple around it has `share` percent of its count.
    """
    words = F.split("phrase", " ")
    phrases = found.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("words"))
    part = lambda start, length: F.struct("lang", F.array_join(F.slice("words", start, length), " ").alias("phrase"))
    cuts = phrases.withColumns({"left": part(F.lit(1), F.col("k")), "right": part(F.col("k") + 1, F.col("size") - F.col("k"))}).drop("words")
    known = found.select(F.struct("lang", "phrase").alias("part"), F.col("n").alias("times")).where("part.phrase <> ''")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = salted_left_join(cuts, [known.withColumnsRenamed({"part": side, "times": name})], side, HOT_ROWS)
    wide = lambda c: F.col(c).cast("decimal(13,0)")
    scored = cuts.withColumns({"_up": wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)"), "_down": wide("l") * wide("r")}).withColumn("score", F.expr("_up div _down"))
    best = scored.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    around = cuts.where("size = 3").select(F.explode(F.array(F.when(F.col("k") == 2, F.col("left")), F.when(F.col("k") == 1, F.col("right")))).alias("part"), "a")
    around = around.where("part is not null").groupBy("part.lang", "part.phrase").agg(F.max("a").alias("_around"))
    kept = best.join(around, ["lang", "phrase"], "left").where((F.col("size") == 3) | F.col("_around").isNull() | (100 * F.col("_around") < share * F.col("a")))
    totals = F.broadcast(found.where("size = 0").select("lang", "n"))  # one row for each language
    return kept.join(totals, "lang").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_phrases(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """Each language's first `top` collocations: lang, rank, phrase, a, l, r, n, score."""
    rows = ranked(collocations(frequent_phrases(docs, least), share), ["lang"], ORDER, top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def ranked(rows: DataFrame, group: list[str], by: Sequence[str], top: int, parts: int = 64) -> DataFrame:
    """The first `top` rows of each group with their rank; each of `parts` shares of a group is cut first.

    `by` names the columns that order them, those with a minus descending.
    """
    order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in by]
    share = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = F.row_number().over(Window.partitionBy(*group, "_share").orderBy(*order))
    few = rows.withColumn("_share", share).withColumn("_rank", first).where(F.col("_rank") <= top).drop("_share", "_rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
