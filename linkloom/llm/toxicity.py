"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-cased runs of letters and their prefixes of 3 to 7 bytes, hashed into
DIMENSIONS buckets; a bucket is present or absent. Of the buckets, the SELECTED most telling ones
(by chi-square on the training rows) enter the machine

    logit(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so an insult beside a group mention may weigh more than both alone. It is trained by Adam on
logistic loss with fixed seeds, on a sample of SAMPLE_ROWS labelled rows at most, taken by the
least hash of their ids. All rows are scored.

Rows: null or wordless text has no terms and the score of the bare w0. Labels that are null don't
train, of several labels of an id the larger counts, of several texts of an id the one whose list of
buckets is least; with no training row (or none of one class) the score is the share of label 1 (0 if none).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from linkloom.llm.common import fold, map_rows, staged, text_udf, utf8

DIMENSIONS = 1 << 18
SELECTED = 2048
LEAST_CHI2 = 15.0
SAMPLE_ROWS = 20_000
FACTORS = 8
PREFIXES = range(3, 8)
FOLDS, HELD_OUT = 5, 0
REMEMBERED = 200_000

#: Lower-cases A-Z and makes a blank of every other ASCII byte that isn't a letter.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: bytes) -> set[bytes]:
    return set(text.translate(_LETTERS).split())


def terms(word: bytes) -> list[int]:
    """The buckets of a word and of its proper prefixes."""
    made = [word, *(word[:k] + b"*" for k in PREFIXES if k < len(word))]
    return [xxh32_intdigest(t) % DIMENSIONS for t in made]


class _Terms(dict):
    """word -> its buckets, those of `chosen` only if given, as positions in it."""

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = terms(word)
        if self.chosen is not None:
            found = [self.chosen[b] for b in found if b in self.chosen]
        self[word] = made = tuple(found)
        return made


def _buckets_udf(chosen: dict[int, int] | None = None):
    def make():
        known = _Terms(chosen)

        def step(texts):
            return {"terms": [sorted({b for w in words(t) for b in known[w]}) for t in texts]}

        return step

    return text_udf(make, "terms array<int>")


@dataclass
class Machine:
    """Weights of the chosen buckets."""

    bias: float
    chosen: dict[int, int] = field(default_factory=dict)
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def score(self, present: list[int]) -> float:
        s = self.factors[present].sum(0)
        pairs = 0.5 * float((s * s).sum() - (self.factors[present] ** 2).sum())
        z = self.bias + float(self.linear[present].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[list[int]], toxic: np.ndarray, width: int, epochs: int = 12, batch: int = 512, rate: float = 0.02, decay: float = 1e-4):
    """Adam on logistic loss over rows of present positions: bias, linear weights, factors."""
    rng = np.random.default_rng(7)
    share = toxic.mean()
    bias = np.array([np.log(share / (1 - share))])
    now = [bias, np.zeros(width), rng.normal(0, 0.02, (width, FACTORS))]
    first, second, t = [np.zeros_like(p) for p in now], [np.zeros_like(p) for p in now], 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            at, t = order[start : start + batch], t + 1
            x = np.zeros((len(at), width))
            for i, r in enumerate(at):
                x[i, rows[r]] = 1
            s = x @ now[2]
            z = now[0] + x @ now[1] + 0.5 * ((s * s).sum(1) - x @ (now[2] ** 2).sum(1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[at]) / len(at)
            gx = x.T @ g
            grads = [g.sum(keepdims=True), gx + decay * now[1], x.T @ (g[:, None] * s) - now[2] * gx[:, None] + decay * now[2]]
            for k, d in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                now[k] = now[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return float(now[0][0]), now[1], now[2]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """docs: (doc_id, text); labels: (doc_id, toxic). Only rows outside the held-out fold train."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    # Bounded by sample_rows, so it may be broadcast.
    sample = F.broadcast(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "toxic", utf8(F.col("text")).alias("body"))
    found = texts.select("doc_id", "toxic", _buckets_udf()(F.col("body"))["terms"].alias("terms"))
    # One row an id, so that no repeated id outweighs others or outgrows the bound; rows meet after partial minima.
    rows = staged(found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms")), "toxicity")
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n or n1 in (0, n):
        share = n1 / n if n else 0.0
        return Machine(30.0 if share else -30.0)
    # At most DIMENSIONS groups; SELECTED rows come to the driver.
    a, b = F.col("b"), F.col("a") - F.col("b")  # with the term: toxic, not toxic
    c, d = F.lit(n1) - a, F.lit(n - n1) - b
    chi2 = n * (a * d - b * c) ** 2 / (n1 * (n - n1) * F.col("a") * F.greatest(F.lit(n) - F.col("a"), F.lit(1)))
    found = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").cast("double").alias("a"), F.sum("toxic").cast("double").alias("b"))
    best = found.select("term", chi2.alias("chi2")).where(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "term").limit(SELECTED).collect()
    chosen = {r["term"]: i for i, r in enumerate(best)}
    if not chosen:
        return Machine(float(np.log(n1 / (n - n1))))
    picked = _pick(rows, chosen).orderBy("doc_id", "toxic").collect()
    bias, linear, factors = train([r["present"] for r in picked], np.array([r["toxic"] for r in picked], float), len(chosen))
    return Machine(bias, chosen, linear, factors)


def _pick(rows: DataFrame, chosen: dict[int, int]) -> DataFrame:
    """The positions of the chosen buckets in each row's terms; SELECTED at most a row."""
    def step(slices):
        for part in slices:
            yield {"doc_id": part["doc_id"], "toxic": part["toxic"], "present": [[chosen[b] for b in x if b in chosen] for x in part["terms"]]}

    return map_rows(rows, step, "doc_id bigint, toxic int, present array<int>")


def scoring(spark: SparkSession, machine: Machine):
    """A column function: UTF-8 bytes to struct(score double)."""
    shared = spark.sparkContext.broadcast(machine)

    def make():
        m = shared.value
        known = _Terms(m.chosen)

        def step(texts):
            return {"score": [m.score(sorted({b for w in words(t) for b in known[w]})) for t in texts]}

        return step

    return text_udf(make, "score double")


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs."""
    score = scoring(docs.sparkSession, fit(docs, labels))
    scored = docs.select("doc_id", score(utf8(F.col("text")))["score"].alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that score below 0.5."""
    score = scoring(docs.sparkSession, fit(docs, labels))
    own = [F.col(f"`{c}`") for c in docs.columns]
    scored = docs.select(F.struct(*own).alias("row"), score(utf8(F.col("text")))["score"].alias("score"))
    return scored.where("score < 0.5").select("row.*")
