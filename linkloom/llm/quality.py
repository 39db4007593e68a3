"""Quality rules: fixed base rules and a hashed n-gram log-likelihood ratio.

Words and pairs of words are hashed into buckets. One multinomial over the buckets comes from all
documents (raw), another from trusted documents (target). Both are smoothed with equal pseudo-texts,
PSEUDO n-grams a bucket for raw and the target's share of that for target, so that a bucket which is
rare in the corpus says little and one that the trusted part lacks for its size says much:

    share = N_target / N_raw
    ratio(b) = ln((c_target(b) + PSEUDO * share) / share) - ln(c_raw(b) + PSEUDO)

A document's rate is the mean of the ratios of its n-grams. It is kept if it passes the base rules
and its rate is at least LEAST_RATE; nothing is drawn at random.

The raw counts cover all documents. Trusted rows may be a sample of TRUSTED_ROWS rows at most,
taken by the least hash of their ids.

Rows: null or wordless text has no words, fails the base rules and isn't kept; its rate is 0. With
no trusted row every rate is 0. A null id is never trusted.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_rows, text_udf, utf8

BUCKETS = 1 << 16
PSEUDO = 5.0
TRUSTED_ROWS = 20_000
LEAST_RATE = -0.25
LEAST_WORDS = 10
MOST_REPEATED = 20  # of 100 words
WINDOW = 5
#: Words whose hash a task remembers.
REMEMBERED = 300_000

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True
_INNER = np.zeros(256, bool)  # bytes that continue a character
_INNER[0x80:0xC0] = True


class _Hashes(dict):
    """word -> first 32 bits of its MD5."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = int.from_bytes(md5(word).digest()[:4], "big")
        return h


def buckets(words: list[bytes], hashes: _Hashes) -> np.ndarray:
    """The buckets of a text's words, then those of its word pairs."""
    h = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))
    return np.concatenate([h % BUCKETS, (h[:-1] * 31 + h[1:]) % BUCKETS])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key, base = ids[:n].copy(), len(number)
    top = base
    for i in range(1, WINDOW):
        if top * base >= 2**62:  # number the prefixes anew, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            top = int(key.max()) + 1
        key = key * base + ids[i : i + n]
        top *= base
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += hit
    edge[WINDOW : WINDOW + n] -= hit
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def fit_ratios(docs: DataFrame, trusted: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """The ratio of each bucket. docs: (doc_id, text); trusted: (doc_id)."""
    sample = trusted.select("doc_id").where("doc_id is not null").distinct()
    # Bounded by trusted_rows, so it may be broadcast.
    sample = F.broadcast(sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows).withColumn("good", F.lit(True)))
    marked = docs.select("doc_id", utf8(F.col("text")).alias("body")).join(sample, "doc_id", "left")

    def count(slices):
        hashes, raw, target = _Hashes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part in slices:
            for body, good in zip(part["body"], part["good"], strict=True):
                found = np.bincount(buckets(body.split(), hashes), minlength=BUCKETS) if len(body) > 1 << 18 else buckets(body.split(), hashes)
                if len(body) > 1 << 18:
                    raw += found
                    target += found if good else 0
                else:
                    np.add.at(raw, found, 1)
                    if good:
                        np.add.at(target, found, 1)
        at = np.flatnonzero(raw)
        yield {"bucket": at, "raw": raw[at], "target": target[at]}

    counted = map_rows(marked.select("body", "good"), count, "bucket int, raw bigint, target bigint")
    total = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    rows = np.array(total.collect(), dtype=np.float64).reshape(-1, 3)  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows[:, 0].astype(int)], target[rows[:, 0].astype(int)] = rows[:, 1], rows[:, 2]
    ratio = np.zeros(BUCKETS)
    if target.sum():
        share = target.sum() / raw.sum()
        ratio = np.log((target / share + PSEUDO) / (raw + PSEUDO))
    return ratio


def rating(spark, ratios: np.ndarray, least_rate: float = LEAST_RATE):
    """A column function: UTF-8 bytes to the base figures, the rate and the verdict."""
    shared = spark.sparkContext.broadcast(ratios)

    def make():
        hashes, ratio = _Hashes(), shared.value

        def step(texts):
            out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "rate")}
            for text in texts:
                words = text.split()
                count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
                out["n_words"].append(len(words))
                out["word_chars"].append(int(len(text) - count[_BLANKS | _INNER].sum()))
                out["n_symbols"].append(int(count[_SYMBOLS].sum()))
                out["n_dup_lines"].append(repeated_lines(text))
                out["n_repeat_words"].append(repeated_words(words))
                out["rate"].append(float(ratio[buckets(words, hashes)].mean()) if words else 0.0)
            n, r = np.array(out["n_words"], np.int64), np.array(out["n_repeat_words"], np.int64)
            out["base_failed"] = (n < LEAST_WORDS) | (100 * r > MOST_REPEATED * n)
            out["kept"] = ~out["base_failed"] & (np.array(out["rate"]) >= least_rate)
            return out

        return step

    return text_udf(
        make,
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, rate double, base_failed boolean, kept boolean",
    )


def rate_rows(docs: DataFrame, trusted: DataFrame, least_rate: float = LEAST_RATE) -> DataFrame:
    """doc_id, the base figures, rate, base_failed and kept of every row of docs."""
    rate = rating(docs.sparkSession, fit_ratios(docs, trusted), least_rate)
    return docs.select("doc_id", rate(utf8(F.col("text"))).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, trusted: DataFrame, least_rate: float = LEAST_RATE) -> DataFrame:
    """The rows of docs, with all their columns, that `rate_rows` keeps."""
    rate = rating(docs.sparkSession, fit_ratios(docs, trusted), least_rate)
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*own).alias("row"), rate(utf8(F.col("text"))).alias("q")).where("q.kept").select("row.*")
