"""Removal of repeated passages by logarithmic families of suffix arrays.

A byte goes if a string of MATCH bytes that covers it also starts in a document with a smaller id.
Strings (windows) are judged on the input; overlaps count; matches never cross documents.

1. Documents are gathered into blocks of compressed text, one staged row each.
2. Each window belongs to its anchor, the least hash of the ANCHOR-byte strings in it. Equal windows
   have equal anchors, and neighbouring windows mostly share theirs, so a document falls into runs
   of windows. Blocks send the distinct anchors' hashes to buckets; a bucket answers which of them
   occur in two documents, and which are hot: in more than HOT_TEXTS different texts. A window whose
   anchor doesn't occur twice is no repeat.
3. For the other anchors, blocks send the text of each run (equal texts once, with their smallest
   id) to the anchor's bucket. Runs of a hot anchor are taken apart into windows, and each goes to
   one of SPLIT times as many further buckets by a hash of its MATCH bytes, so that equal windows still
   meet and a phrase shorter than MATCH that many documents hold doesn't fill one bucket.
4. A bucket is an index family. Its texts come in batches of ascending ids. A new batch gets its
   suffix array: the starts of its windows sorted by their first MATCH bytes. It is merge-scanned
   against each existing level, which finds all windows that smaller ids have, then becomes a level;
   levels of like size merge, so sizes grow geometrically and a window is merged a logarithmic number
   of times. The bucket answers one bit per window.
5. Blocks apply the bits to their documents.

Only hashes decide whether texts are compared; windows are compared by their bytes. Copies within a
block collapse before anything is sent, so a passage in a third of all rows reaches its bucket once
per block. Nothing but one block's or one bucket's share is ever in a task.

Rows: null or short text has no window and stays as it is. Rows with the same id don't repeat one
another; a null id counts as larger than all ids, and rows with null ids don't repeat one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.blocks import by_bucket, gather, open_block, with_answers
from linkloom.llm.common import map_rows, mix64, staged, utf8

MATCH, ANCHOR = 50, 24
#: Bytes of text in a block and, on average, per bucket.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: Windows in a batch, and bytes hashed at a time.
BATCH_WINDOWS, CHUNK_BYTES = 1 << 16, 1 << 18
#: Different texts (summed over blocks) beyond which an anchor is hot, and further buckets for each bucket.
HOT_TEXTS, SPLIT = 4096, 8
LAST = np.iinfo(np.int64).max  # stands for a null id

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over each `width` neighbours, by doubling; op must not mind seeing an element twice."""
    n, out = 1, a
    while 2 * n <= width:
        out = op(out[:-n], out[n:])
        n *= 2
    return op(out[: len(a) - width + 1], out[width - n :]) if n < width else out


def anchors(text: np.ndarray) -> np.ndarray:
    """The anchor hash of each window of a byte array."""
    p = text.astype(np.uint64)
    for n in (1, 2, 4):  # eight bytes at each place
        p = p[:-n] << np.uint64(8 * n) | p[n:]
    n = len(text) - ANCHOR + 1
    h = sum(p[8 * i : 8 * i + n] * m for i, m in enumerate(_MULTIPLIERS))
    return _sliding(mix64(h), MATCH - ANCHOR + 1, np.minimum)


def runs(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start in it, windows, anchor) of each run of windows with one anchor."""
    found, first = [], 0
    while first < len(bodies):
        last, size = first, 0
        while last < len(bodies) and (last == first or size + len(bodies[last]) <= CHUNK_BYTES):
            size += len(bodies[last])
            last += 1
        lengths = np.fromiter(map(len, bodies[first:last]), np.int64, last - first)
        if size >= MATCH:
            least = anchors(np.frombuffer(b"".join(bodies[first:last]), np.uint8))
            doc = np.repeat(np.arange(last - first), lengths)
            whole = doc[: len(least)] == doc[MATCH - 1 :]
            same = np.r_[False, whole[1:] & whole[:-1] & (least[1:] == least[:-1])]
            at = np.flatnonzero(whole & ~same)
            end = np.flatnonzero(whole & ~np.r_[same[1:], False])
            start = (np.cumsum(lengths) - lengths)[doc[at]]
            found.append((doc[at] + first, at - start, end - at + 1, least[at]))
        first = last
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def windows(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sortable keys of the windows at `starts`: their bytes and a closing 1 (a final zero would be cut)."""
    out = np.ones((len(starts), MATCH + 1), np.uint8)
    out[:, :MATCH] = np.lib.stride_tricks.sliding_window_view(text, MATCH)[starts]
    return out.reshape(-1).view(f"S{MATCH + 1}")


def window_hashes(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the window at each place."""
    out, view = np.zeros(len(starts), np.uint64), np.lib.stride_tricks.sliding_window_view(text, MATCH)
    words = -(-MATCH // 8)
    for s in range(0, len(starts), CHUNK_BYTES):
        part = starts[s : s + CHUNK_BYTES]
        wide = np.zeros((len(part), 8 * words), np.uint8)
        wide[:, :MATCH] = view[part]
        for column in wide.view(np.uint64).T:
            out[s : s + len(part)] = mix64(out[s : s + len(part)] * _MULTIPLIERS[0] + column)
    return out


class IndexFamily:
    """Levels of sorted windows, all from smaller ids than those of the next batch."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each window of a batch, does a smaller id have it? The batch then joins the index."""
        array = np.argsort(keys, kind="stable")  # the batch's suffix array
        keys, ids = keys[array], ids[array]
        new = np.r_[True, keys[1:] != keys[:-1]]
        group = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        repeat = ids > np.minimum.reduceat(ids, at)[group]
        distinct = keys[at]
        old = np.zeros(len(distinct), bool)
        for level in self.levels:
            place = np.minimum(np.searchsorted(level, distinct), len(level) - 1)
            old |= level[place] == distinct
        out = np.zeros(len(keys), bool)
        out[array] = repeat | old[group]
        self._push(distinct[~old])
        return out

    def _push(self, level: np.ndarray) -> None:
        if not len(level):
            return
        while self.levels and len(self.levels[-1]) < 2 * len(level):
            level = np.sort(np.concatenate([self.levels.pop(), level]), kind="stable")  # merges two runs
        self.levels.append(level)


def repeats(pieces: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each piece, which of its windows a piece with a smaller id has."""
    out: list = [None] * len(pieces)
    order, family, i = np.argsort(ids, kind="stable").tolist(), IndexFamily(), 0
    while i < len(order):
        batch, count = [], 0
        # A batch ends only between ids, so that all before it are smaller.
        while i < len(order) and (count < BATCH_WINDOWS or ids[order[i]] == ids[order[i - 1]]):
            batch.append(order[i])
            count += len(pieces[order[i]]) - MATCH + 1
            i += 1
        sizes = np.array([len(pieces[k]) for k in batch])
        text = np.frombuffer(b"".join([pieces[k] for k in batch]), np.uint8)
        piece = np.repeat(np.arange(len(batch)), sizes - MATCH + 1)
        first = np.cumsum(sizes - MATCH + 1) - (sizes - MATCH + 1)
        starts = np.arange(count) - first[piece] + (np.cumsum(sizes) - sizes)[piece]
        marks = family.add(windows(text, starts), ids[batch][piece])
        for k, part in zip(batch, np.split(marks, first[1:]), strict=True):
            out[k] = part
    return out


def _numbers(ids: list[int | None]) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], np.int64)


class _Block:
    """The runs of a block by bucket, always in the same order."""

    def __init__(self, bodies: list[bytes], ids: list[int | None], buckets: int):
        self.bodies, self.ids, self.buckets = bodies, _numbers(ids), buckets
        self.doc, self.start, self.count, anchor = runs(bodies)
        bucket = (anchor % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((anchor, bucket))
        self.doc, self.start, self.count = self.doc[order], self.start[order], self.count[order]
        self.bucket, self.anchor = bucket[order], anchor[order]
        change = np.r_[True, self.anchor[1:] != self.anchor[:-1]] if len(order) else np.zeros(0, bool)
        self.group = np.cumsum(change) - 1
        self.first = np.flatnonzero(change)  # of each distinct anchor

    def parts(self) -> Iterator[tuple[int, slice]]:
        """Each bucket's slice of the distinct anchors."""
        b = self.bucket[self.first]
        cut = np.r_[0, np.flatnonzero(np.diff(b)) + 1, len(b)] if len(b) else np.zeros(1, int)
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield int(b[s]), slice(s, e)

    def several(self) -> np.ndarray:
        """Whether each distinct anchor lies in two ids of this block."""
        ids = self.ids[self.doc]
        return np.minimum.reduceat(ids, self.first) != np.maximum.reduceat(ids, self.first) if len(self.first) else np.zeros(0, bool)

    def texts(self) -> np.ndarray:
        """In how many different texts each distinct anchor lies here (some may be equal below 16)."""
        ends = np.r_[self.first[1:], len(self.group)]
        count = ends - self.first
        for k in np.flatnonzero(count >= 16).tolist():
            count[k] = len({self._text(*run) for run in self._runs(slice(self.first[k], ends[k]))})
        return np.minimum(count, 65535).astype(np.uint16)

    def _text(self, doc: int, start: int, count: int) -> bytes:
        return self.bodies[doc][start : start + count + MATCH - 1]

    def _runs(self, at) -> Iterator[tuple[int, int, int]]:
        return zip(self.doc[at].tolist(), self.start[at].tolist(), self.count[at].tolist(), strict=True)

    def shared(self, flags: dict[int, bytes]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, start, windows) of what each bucket is asked about: runs, or windows of hot anchors."""
        out, hot_runs = {}, []
        for bucket, part in self.parts():
            n = part.stop - part.start
            marked, hot = np.unpackbits(np.frombuffer(flags[bucket], np.uint8), count=2 * n).astype(bool).reshape(2, n)
            lo = self.first[part.start]
            hi = self.first[part.stop] if part.stop < len(self.first) else len(self.group)
            at = np.arange(lo, hi)
            of = self.group[at] - part.start
            whole = at[(marked & ~hot)[of]]
            if len(whole):
                out[bucket] = self.doc[whole], self.start[whole], self.count[whole]
            hot_runs.append(at[(marked & hot)[of]])
        at = np.concatenate(hot_runs) if hot_runs else np.zeros(0, np.int64)
        if len(at):
            out.update(self._windows(at))
        return out

    def _windows(self, at: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The windows of some runs, dealt to the further buckets."""
        n = self.count[at]
        doc = np.repeat(self.doc[at], n)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n - self.start[at], n)
        sizes = np.fromiter(map(len, self.bodies), np.int64, len(self.bodies))
        hashes = window_hashes(np.frombuffer(b"".join(self.bodies), np.uint8), (np.cumsum(sizes) - sizes)[doc] + start)
        bucket = (hashes % np.uint64(SPLIT * self.buckets)).astype(np.int64) + self.buckets
        order = np.argsort(bucket, kind="stable")
        doc, start, bucket = doc[order], start[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        parts = zip(np.split(doc, cut), np.split(start, cut), strict=True)
        return {int(b): (d, s, np.ones(len(d), np.int64)) for b, (d, s) in zip(bucket[np.r_[0, cut]], parts, strict=True)}

    def pieces(self, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct texts of some runs, their smallest ids, and each run's place among them."""
        number: dict[bytes, int] = {}
        place = np.zeros(len(doc), np.int64)
        for k, run in enumerate(zip(doc.tolist(), start.tolist(), count.tolist(), strict=True)):
            place[k] = number.setdefault(self._text(*run), len(number))
        least = np.full(len(number), LAST, np.int64)
        np.minimum.at(least, place, self.ids[doc])
        return list(number), least, place


def _shared_anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, flags): a bit for each of a block's distinct anchors of a bucket that occurs in two
    ids, then a bit for each that is hot."""

    def send(slices):
        for part in slices:
            for block, ids, sizes, body in zip(part["block"], part["ids"], part["sizes"], part["body"], strict=True):
                b = _Block(open_block(body, sizes), ids, buckets)
                hashes, several, texts = (b.anchor[b.first] >> np.uint64(32)).astype(np.uint32), b.several(), b.texts()
                pack = zstandard.ZstdCompressor(1).compress  # nearly all are 1
                got = [(k, hashes[p].tobytes(), np.packbits(several[p]).tobytes(), pack(texts[p].tobytes())) for k, p in b.parts()]
                if got:
                    k, h, m, n = zip(*got, strict=True)
                    yield {"block": [block] * len(k), "bucket": k, "hashes": h, "several": m, "texts": n}

    def answer(rows):
        each = [np.frombuffer(r["hashes"], np.uint32) for r in rows]
        several = [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, each, strict=True)]
        flat = np.sort(np.concatenate(each + [h[m] for h, m in zip(each, several, strict=True)]))
        shared = np.unique(flat[1:][flat[1:] == flat[:-1]])
        total = np.zeros(len(shared), np.int64)
        places = []
        for r, h in zip(rows, each, strict=True):
            place = np.minimum(np.searchsorted(shared, h), max(0, len(shared) - 1))
            hit = shared[place] == h if len(shared) else np.zeros(len(h), bool)
            texts = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["texts"]), np.uint16)
            np.add.at(total, place[hit], texts[hit])
            places.append((place, hit))
        hot = np.r_[total > HOT_TEXTS, False]  # the last for no shared anchor
        for r, (place, hit) in zip(rows, places, strict=True):
            yield {"block": [r["block"]], "bucket": [r["bucket"]], "flags": [np.packbits(np.r_[hit, hit & hot[place]]).tobytes()]}

    sent = map_rows(blocks, send, "block bigint, bucket bigint, hashes binary, several binary, texts binary")
    return by_bucket(sent, answer, "block bigint, bucket bigint, flags binary")


def dedupe(docs: DataFrame, extra: str | None = None, text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), spans and extra of each row of docs.

    `spans` holds the removed runs as little-endian (start, end) pairs of 64-bit integers. `extra` names
    a column of any type that Arrow has, which is passed on. With `text`, kept_text comes instead of kept and spans: the
    text without the characters that lie whole in a removed run.
    """
    given = docs.select("doc_id", utf8(F.col("text")).alias("body"), (F.col(extra) if extra else F.lit(None).cast("string")).alias("extra"))
    blocks = staged(gather(given.withColumn("doc_id", F.col("doc_id").cast("bigint")), BLOCK_BYTES), "blocks")
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(12, -(-total // BUCKET_BYTES))
    flags = staged(_shared_anchors(blocks, buckets), "flags")

    def send(row, by):
        b = _Block(open_block(row["body"], row["sizes"]), row["ids"], buckets)
        out = {"block": [], "bucket": [], "sizes": [], "ids": [], "text": []}
        for bucket, asked in b.shared(by["flags"]).items():
            pieces, least, _ = b.pieces(*asked)
            out["block"].append(row["block"])
            out["bucket"].append(bucket)
            out["sizes"].append(np.array(list(map(len, pieces)), np.int32).tobytes())
            out["ids"].append(least.tobytes())
            out["text"].append(zstandard.ZstdCompressor(3).compress(b"".join(pieces)))
        return out

    sent = with_answers(
        blocks.select("block", "ids", "sizes", "body"), flags, send,
        pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("sizes", pa.binary()), ("ids", pa.binary()), ("text", pa.binary())]),
    )

    def answer(rows):
        pieces, ids, counts = [], [], []
        for r in rows:
            got = open_block(r["text"], np.frombuffer(r["sizes"], np.int32).tolist())
            pieces += got
            ids.append(np.frombuffer(r["ids"], np.int64))
            counts.append(len(got))
        marks, at = repeats(pieces, np.concatenate(ids)), 0
        for r, n in zip(rows, counts, strict=True):
            yield {"block": [r["block"]], "bucket": [r["bucket"]], "marks": [np.packbits(np.concatenate(marks[at : at + n])).tobytes()]}
            at += n

    marks = staged(by_bucket(sent, answer, "block bigint, bucket bigint, marks binary"), "marks")
    answers = flags.withColumn("marks", F.lit(None).cast("binary")).unionByName(marks.withColumn("flags", F.lit(None).cast("binary")))

    results = {"kept_text": pa.string()} if text else {"kept": pa.binary(), "spans": pa.binary()}

    def apply(row, by):
        bodies = open_block(row["body"], row["sizes"])
        b = _Block(bodies, row["ids"], buckets)
        starts = np.cumsum(row["sizes"]) - row["sizes"]
        edge = np.zeros(sum(row["sizes"]) + 1, np.int32)
        for bucket, (doc, start, n) in b.shared(by["flags"]).items():
            pieces, least, place = b.pieces(doc, start, n)
            counts = np.array(list(map(len, pieces))) - MATCH + 1
            bits = np.unpackbits(np.frombuffer(by["marks"][bucket], np.uint8), count=int(counts.sum())).astype(bool)
            first = np.cumsum(counts) - counts
            run = np.repeat(np.arange(len(doc)), n)
            offset = np.arange(len(run)) - (np.cumsum(n) - n)[run]
            hit = bits[first[place][run] + offset] | (b.ids[doc] > least[place])[run]
            where = (starts[doc] + start)[run][hit] + offset[hit]
            np.add.at(edge, where, 1)
            np.add.at(edge, where + MATCH, -1)
        gone = np.cumsum(edge)[:-1] > 0
        out = {"doc_id": row["ids"], "n_bytes": row["sizes"], "n_removed": [], "n_spans": [], **{c: [] for c in results}}
        for body, s, size in zip(bodies, starts.tolist(), row["sizes"], strict=True):
            g = gone[s : s + size]
            change = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8))).astype(np.int64)
            out["n_removed"].append(int(np.count_nonzero(g)))
            out["n_spans"].append(len(change) // 2)
            if text:
                out["kept_text"].append(cut_characters(body, change.tobytes()))
            else:
                out["kept"].append(np.frombuffer(body, np.uint8)[~g].tobytes() if len(change) else body)
                out["spans"].append(change.tobytes())
        return out

    kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), *results.items()]
    return with_answers(blocks, answers, apply, pa.schema(kinds))


def dedupe_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of docs (doc_id, text)."""
    return dedupe(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cut_characters(body: bytes, spans: bytes) -> str:
    """The text without the characters that lie whole in a removed run."""
    edges = np.frombuffer(spans, np.int64).reshape(-1, 2).tolist()
    out, at = [], 0
    inner = lambda i: i < len(body) and 0x80 <= body[i] < 0xC0
    for s, e in edges:
        while inner(s) and s < e:  # the run starts within a character, which stays
            s += 1
        while inner(e) and e > s:  # it ends within one, which stays
            e -= 1
        out.append(body[at:s])
        at = max(at, e)
    out.append(body[at:])
    return b"".join(out).decode()
