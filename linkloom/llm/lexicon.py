"""BPE encoding and decoding through a minimal acyclic transducer.

The most frequent words of the corpus (counted over all documents) are compiled into a minimal
acyclic automaton that shares suffixes. Each transition carries how many words it passes by, so a
walk adds up to the word's number, and the number leads to the word's ids. The automaton is one
flat file, sent along with Spark's files and memory-mapped by every task. Distinct words of a batch
walk it together. Words that it doesn't hold are merged by the tokenizer's own ranks; the result is
the same either way, so the size of the lexicon never changes an id.

The text rules are those of the tokenizer file: its special strings are cut out first and become
their ids; the rest is put into NFC, lower-cased character by character and split at white space
and by kind (contraction, letters, one digit, other signs).

Rows: null or empty text has no ids and the empty string as its decoding.
"""

from __future__ import annotations

import hashlib
import json
import os
import string
import tempfile
import unicodedata
import uuid
from collections import Counter
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import map_rows, staged, text_udf, utf8

LEXICON_WORDS = 60_000
LONGEST_WORD = 48  # bytes of a word in the lexicon
#: Words that a counting task holds before it passes them on; chunks that a worker remembers.
HELD, REMEMBERED = 300_000, 1_000_000
#: Words merged at a time, and ids decoded at a time.
ROWS, DECODED = 1 << 14, 1 << 17

_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_CHUNKS = regex.compile(f"[^{_BLANK}]+")
_KINDS = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{_BLANK}\\p{{L}}\\p{{N}}]+")


def chunks(text: str) -> list[str]:
    """The normalized text's runs of anything but white space."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
    text = text.lower()
    # Python's own split knows the same blanks and four separators more.
    return _CHUNKS.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def words(chunk: str) -> list[str]:
    if chunk.isalpha():
        return [chunk]
    letters = chunk.rstrip(string.punctuation)  # "word." needs no pattern
    return [letters, chunk[len(letters) :]] if letters.isalpha() else _KINDS.findall(chunk)


class Bpe:
    """The merges of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks, self.made = {}, []
        for r, (a, b) in enumerate(pairs):
            self.ranks[self.ids[a], self.ids[b]] = r
            self.made.append(self.ids[a + b])
        # Printable Latin-1 bytes stand for themselves, the others for code points from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.inner = [self.ids[signs[b]] for b in range(256)]
        self.last = [self.ids[signs[b] + self.end] for b in range(256)]
        # The same as arrays: sorted pairs with their ranks, and all tokens after one another.
        self.width = max((self.ids | self.special).values()) + 1
        keys = np.array([a * self.width + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.ranks.values()), np.int32)[order]
        self.tokens = [b" "] * self.width
        for t, i in (self.ids | self.special).items():
            self.tokens[i] += t.encode()
        self.token_sizes = np.fromiter(map(len, self.tokens), np.int32, self.width)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: the lowest rank first, the leftmost of equals."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) > 32:
            return self._merge_long(ids)
        rank, none = self.ranks.get, len(self.made)
        pairs = [rank(p, none) for p in zip(ids, ids[1:], strict=False)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            ids[i : i + 2] = [self.made[best]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = rank((ids[i], ids[i + 1]), none)
        return ids

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], len(self.made)).astype(np.int32)

    def merge_all(self, asked: list[bytes]) -> list[bytes]:
        """`merge` of many words, as little-endian unsigned 32-bit ids; words of like length go together."""
        out = [b""] * len(asked)
        size = np.fromiter(map(len, asked), np.int64, len(asked))
        for least, most in ((1, 8), (9, 16), (17, 32)):
            at = np.flatnonzero((size >= least) & (size <= most))
            for s in range(0, len(at), ROWS):
                part = at[s : s + ROWS].tolist()
                for i, made in zip(part, self._merge_rows([asked[i] for i in part], size[part]), strict=True):
                    out[i] = made
        for i in np.flatnonzero(size > 32).tolist():
            out[i] = np.array(self.merge(asked[i]), "<u4").tobytes()
        return out

    def _merge_rows(self, asked: list[bytes], size: np.ndarray) -> list[bytes]:
        """A row for each word; in each turn every row's best pair becomes one id and the rest moves up."""
        n, wide, none = len(asked), int(size.max()), len(self.made)
        text, every = np.frombuffer(b"".join(asked), np.uint8), np.arange(n)
        row = np.repeat(every, size)
        column = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        ids = np.zeros((n, wide + 1), np.int32)
        ids[row, column] = np.array(self.inner, np.int32)[text]
        ids[every, size - 1] = np.array(self.last, np.int32)[text[np.cumsum(size) - 1]]
        rank = np.full((n, wide + 1), none, np.int32)  # of the pair that starts here
        row, column = row[column < size[row] - 1], column[column < size[row] - 1]
        rank[row, column] = self._rank(ids[row, column], ids[row, column + 1])
        made, places, left, live = np.array([*self.made, 0], np.int32), np.arange(wide + 1), size.copy(), every
        while len(live):
            ranks = rank[live]
            at = ranks.argmin(1)  # the leftmost of equals
            best = ranks[np.arange(len(live)), at]
            go = best < none
            live, at, best, ranks = live[go], at[go], best[go], ranks[go]
            up = np.minimum(places + (places > at[:, None]), wide)
            now, ranks = np.take_along_axis(ids[live], up, 1), np.take_along_axis(ranks, up, 1)
            each = np.arange(len(live))
            now[each, at] = made[best]
            left[live] -= 1
            ranks[each, at] = np.where(at + 1 < left[live], self._rank(now[each, at], now[each, np.minimum(at + 1, wide)]), none)
            k = np.flatnonzero(at > 0)
            ranks[k, at[k] - 1] = self._rank(now[k, at[k] - 1], now[k, at[k]])
            ids[live], rank[live] = now, ranks
        flat = ids[places < left[:, None]].astype("<u4").tobytes()
        ends = (np.cumsum(left) * 4).tolist()
        return [flat[e - 4 * m : e] for e, m in zip(ends, left.tolist(), strict=True)]

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """The tokens of each text's ids with a blank between them, as UTF-8."""
        flat, made, sizes = np.frombuffer(b"".join(texts), "<u4"), bytearray(), [np.zeros(0, np.int64)]
        for s in range(0, len(flat), DECODED):
            ids = flat[s : s + DECODED]
            size = self.token_sizes[ids]
            shift = self.token_starts[ids] - (np.cumsum(size) - size)
            made += self.token_bytes[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()
            sizes.append(size)
        ends = np.r_[0, np.cumsum(np.concatenate(sizes), dtype=np.int64)]
        cut = ends[np.r_[0, np.cumsum([len(t) // 4 for t in texts], dtype=np.int64)]].tolist()
        return [bytes(made[s + 1 : e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        heapify(heap)
        gone = [False] * n
        while heap:
            _, i, p = heappop(heap)
            j = after[i]
            if gone[i] or j >= n or (ids[i], ids[j]) != p:
                continue
            ids[i], gone[j], after[i] = self.made[ranks[p]], True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (q := (ids[k], ids[after[k]])) in ranks:
                    heappush(heap, (ranks[q], k, q))
        return [x for x, dead in zip(ids, gone, strict=True) if not dead]


def compile_words(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The minimal automaton of sorted, distinct, non-empty words.

    keys (state * 256 + byte, sorted), target, words passed by, and whether each state ends a word.
    """
    register: dict[tuple, int] = {}
    edges: list[dict[int, int]] = [{}]
    final = [False]
    path = [0]  # the states of the last word's letters

    def fold(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], tuple(sorted(edges[state].items())))
            same = register.setdefault(key, state)
            if same != state:
                up = edges[path[-1]]
                up[max(up)] = same
                edges[state] = {}

    before = b""
    for word in found:
        shared = len(os.path.commonprefix([word, before]))
        fold(shared)
        for byte in word[shared:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        before = word
    fold(0)
    # Words that end at or below each state, then the words that each transition passes by.
    count: dict[int, int] = {}
    stack = [(0, False)]
    while stack:
        state, ready = stack.pop()
        if ready:
            count[state] = final[state] + sum(count[t] for t in edges[state].values())
        elif state not in count:
            stack.append((state, True))
            stack.extend((t, False) for t in edges[state].values() if t not in count)
    number = {s: i for i, s in enumerate(sorted(count))}
    rows = []
    for state in sorted(count):
        passed = int(final[state])
        for byte in sorted(edges[state]):
            rows.append((number[state] * 256 + byte, number[edges[state][byte]], passed))
            passed += count[edges[state][byte]]
    table = np.array(rows, np.int64).reshape(-1, 3)
    ends = np.array([final[s] for s in sorted(count)], np.uint8)
    return table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32), ends


def save(path: str, found: list[bytes], ids: list[list[int]]) -> None:
    """One flat file: six lengths, then six arrays. `found` is sorted, `ids` in its order."""
    keys, target, passed, ends = compile_words(found)
    at = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.array([i for x in ids for i in x], np.uint32)
    with open(path, "wb") as f:
        arrays = [keys, target, passed, at, flat, ends]
        f.write(np.array([len(a) for a in arrays], np.int64).tobytes())
        for a in arrays:
            f.write(a.tobytes())


class Lexicon:
    """The memory-mapped automaton."""

    def __init__(self, path: str):
        sizes = np.fromfile(path, np.int64, 6)
        kinds, start, got = (np.int64, np.int32, np.int32, np.int32, np.uint32, np.uint8), 48, []
        for n, kind in zip(sizes, kinds, strict=True):
            got.append(np.memmap(path, kind, "r", start, (int(n),)).view(np.ndarray) if n else np.zeros(0, kind))
            start += int(n) * np.dtype(kind).itemsize
        self.keys, self.target, self.passed, self.at, self.flat, self.ends = got
        self.bytes = memoryview(self.flat).cast("B") if len(self.flat) else memoryview(b"")

    def numbers(self, asked: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for a word that isn't there. All walk a byte at a time."""
        out = np.full(len(asked), -1, np.int64)
        if not len(self.keys) or not asked:
            return out
        size = np.fromiter(map(len, asked), np.int64, len(asked))
        alive = np.flatnonzero((size > 0) & (size <= LONGEST_WORD))
        alive = alive[np.argsort(-size[alive], kind="stable")]
        text = np.frombuffer(b"".join(asked), np.uint8)
        start = np.cumsum(size) - size
        state, number = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        depth = 0
        while len(alive):
            key = state[alive] * 256 + text[start[alive] + depth]
            e = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[e] == key
            alive, e = alive[hit], e[hit]
            state[alive] = self.target[e]
            number[alive] += self.passed[e]
            depth += 1
            done = size[alive] == depth
            over = alive[done]
            over = over[self.ends[state[over]] == 1]
            out[over] = number[over]
            alive = alive[~done]
        return out

    def ids(self, number: int) -> bytes:
        return self.all_ids(np.array([number]))[0]

    def all_ids(self, numbers: np.ndarray) -> list[bytes]:
        """The ids of numbered words, as little-endian unsigned 32-bit integers."""
        starts, ends = (self.at[numbers] * 4).tolist(), (self.at[numbers + 1] * 4).tolist()
        return [self.bytes[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]


def frequent_words(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of all documents, sorted: `most` of them or, with ties, fewer.

    A histogram of the counts says which count to ask for, so that only these words reach the driver.
    """

    def count(slices):
        cut, held = Bpe(tokenizer_path).cut, Counter()

        def flush():
            found = Counter()
            for chunk, n in held.items():
                for w in words(chunk):
                    found[w] += n
            held.clear()
            return {"word": list(found), "n": list(found.values())}

        for part in slices:
            for body in part["body"]:
                text = body.decode()
                for segment in cut.split(text)[::2] if "<" in text else [text]:
                    held.update(chunks(segment))
            if len(held) > HELD:
                yield flush()
        yield flush()

    counted = map_rows(docs.select(utf8(F.col("text")).alias("body")), count, "word string, n bigint")
    short = counted.where(F.octet_length("word") <= LONGEST_WORD)
    totals = staged(short.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # Small counts one by one, large ones eight to a doubling.
    grade = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 8) + 16)
    graded = totals.groupBy(grade.alias("grade")).agg(F.count("*").alias("words"), F.min("n").alias("least"))
    least, found = None, 0
    for row in sorted(graded.collect(), reverse=True):
        found += row["words"]
        if found > most:
            break
        least = row["least"]
    if least is None:
        return []
    return sorted(r["word"].encode() for r in totals.where(F.col("n") >= least).select("word").collect())


def publish(spark: SparkSession, found: list[bytes], tokenizer_path: str) -> str:
    """Compile the words and send the file along with Spark's files; returns its name."""
    bpe = Bpe(tokenizer_path)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="llm-"), name)
    save(path, found, [np.frombuffer(i, "<u4").tolist() for i in bpe.merge_all(found)])
    spark.sparkContext.addFile(path)
    return name


class Encoder:
    """Ids and decoding of whole texts. What a chunk became is remembered for the texts to come."""

    def __init__(self, tokenizer_path: str, lexicon_path: str):
        self.bpe, self.lexicon = Bpe(tokenizer_path), Lexicon(lexicon_path)
        self.ids: dict[str, bytes] = {}

    def _word_ids(self, asked: list[str]) -> dict[str, bytes]:
        raw = [w.encode() for w in asked]
        number = self.lexicon.numbers(raw)
        known, other = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        out = dict(zip([asked[i] for i in known.tolist()], self.lexicon.all_ids(number[known]), strict=True))
        other = other.tolist()
        out.update(zip([asked[i] for i in other], self.bpe.merge_all([raw[i] for i in other]), strict=True))
        return out

    def _learn(self, new: list[str]) -> None:
        special, several = self.bpe.special, {}
        single = []
        for c in new:
            if c.isalpha():
                single.append(c)
            elif c[0] == "\0" and c[1:] in special:
                self.ids[c] = np.array([special[c[1:]]], "<u4").tobytes()
            else:
                several[c] = words(c)
        of_word = self._word_ids(list(set(single).union(*several.values())))
        for c in single:
            self.ids[c] = of_word[c]
        of = of_word.__getitem__
        for c, parts in several.items():
            self.ids[c] = b"".join(map(of, parts))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded UTF-8) of each text."""
        bpe = self.bpe
        split: list[list[str]] = []
        for text in texts:
            if "<" in text and len(parts := bpe.cut.split(text)) > 1:
                split.append([c for k, p in enumerate(parts) for c in (["\0" + p] if k % 2 else chunks(p))])
            else:
                split.append(chunks(text))
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
        self._learn(list(set().union(*split).difference(self.ids)))
        ids = self.ids.__getitem__
        made = [b"".join(map(ids, cs)) for cs in split]
        return list(zip(made, bpe.decode(made), strict=True))


@lru_cache(maxsize=1)
def _encoder(tokenizer_path: str, lexicon_path: str) -> Encoder:
    """The worker's encoder: the next task of the same job finds it with what it remembers."""
    return Encoder(tokenizer_path, lexicon_path)


def encoding(tokenizer_path: str, lexicon: str, digest: bool = True):
    """A column function: UTF-8 bytes to the number of ids and the digests of ids and decoding.

    With `digest` off: the ids (array<bigint>) and the decoded text.
    """

    def make():
        encoder = _encoder(tokenizer_path, SparkFiles.get(lexicon))

        def step(texts):
            made = encoder.encode([t.decode() for t in texts])
            if not digest:
                return {"ids": [np.frombuffer(i, np.uint32).tolist() for i, _ in made], "decoded": [d.decode() for _, d in made]}
            return {
                "n_tokens": [len(i) // 4 for i, _ in made],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in made],
                "decoded_sha256": [hashlib.sha256(d).hexdigest() for _, d in made],
            }

        return step

    return text_udf(make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else "ids array<bigint>, decoded string", 2 << 20)


def encode_rows(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS, digest: bool = True) -> DataFrame:
    """doc_id and what `encoding` makes of the text of every row."""
    name = publish(docs.sparkSession, frequent_words(docs, tokenizer_path, lexicon_words), tokenizer_path)
    return docs.select("doc_id", encoding(tokenizer_path, name, digest)(utf8(F.col("text"))).alias("e")).select("doc_id", "e.*")
