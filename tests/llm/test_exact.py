"""Exact duplicates by counting quotient filters against plain grouping."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import exact
from tests.llm.helpers import frame, odd_texts


@pytest.mark.parametrize("width", [64, 58, 46])
@pytest.mark.parametrize("n", [0, 1, 2, 700, 30_000])
def test_filter_keeps_values_and_counts(width, n):
    rng = np.random.default_rng(n + width)
    values = rng.integers(0, 2**width - 1, n, dtype=np.uint64)
    values[: n // 3] = values[:1] + np.arange(n // 3, dtype=np.uint64) if n else values  # a run of neighbours
    values = np.unique(values & np.uint64(2**width - 1))
    counts = rng.integers(1, 4, len(values))
    for k, big in enumerate((1 << 24, (1 << 24) + 1, 1 << 52)):
        if len(counts) > k:
            counts[k] = big
    got = exact.unpack_filter(exact.pack_filter(values, counts, width))
    assert (got[0] == values).all() and (got[1] == counts).all()


def test_filter_of_too_many_values():
    with pytest.raises(ValueError):
        exact.pack_filter(np.arange(5000, dtype=np.uint64), np.ones(5000, np.int64), 30)


def test_merge_is_lossless():
    rng = np.random.default_rng(1)
    parts = [np.unique(rng.integers(0, 500, 300, dtype=np.uint64), return_counts=True) for _ in range(9)]
    values, counts = exact.merge_sorted([exact.unpack_filter(exact.pack_filter(v, c, 64)) for v, c in parts])
    want: dict[int, int] = {}
    for v, c in parts:
        for x, y in zip(v.tolist(), c.tolist(), strict=True):
            want[x] = want.get(x, 0) + y
    assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == want and values.tolist() == sorted(want)


@pytest.mark.parametrize("partitions", [3, 150])
def test_repeated_fingerprints(spark, partitions, monkeypatch):
    """Also with more sources than one level merges."""
    rows = spark.range(0, 3000, 1, partitions).selectExpr("case when id % 3 = 0 then 77 else xxhash64(id % 1700) end as fp")
    want = {r["fp"]: r["n"] for r in rows.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").collect()}
    assert {r["fp"]: r["copies"] for r in exact.repeated_fingerprints(rows).collect()} == want


def plain(rows):
    by: dict[str, list] = {}
    for i, t in rows:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in by.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


ROWS = [*enumerate(odd_texts()), (500, "a  b"), (501, "a\nb"), (502, " a b"), (502, " a b"), (None, "only"), (None, "only"), (None, " a b")]
ROWS += [(600, "long " * 300_000), (601, "long\t" * 300_000), (602, "long " * 300_000 + "x")] + [(1000 + i, "hot") for i in range(300)]


@pytest.mark.parametrize("bounds", ["large", "small"])
def test_classes(spark, monkeypatch, bounds):
    if bounds == "small":  # the salted joins
        monkeypatch.setattr(exact, "ROUTED_BROADCAST", 0)
        monkeypatch.setattr(exact, "HOT_ROWS", 20)
    df = frame(spark, [t for _, t in ROWS], [i for i, _ in ROWS]).withColumn("mark", F.lit("x"))
    got = exact.class_rows(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(ROWS)
    assert exact.class_rows(df.where("false")).collect() == []


def test_equal_fingerprints_are_compared_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    df = frame(spark, ["a", "b", "a", "c"])
    assert sorted(map(tuple, exact.class_rows(df).collect()), key=repr) == plain([(0, "a"), (1, "b"), (2, "a"), (3, "c")])


def test_drop_copies_keeps_whole_rows(spark):
    df = frame(spark, [t for _, t in ROWS], [i for i, _ in ROWS])
    df = df.withColumns({"mark": F.create_map(F.lit("k"), "doc_id"), "at": F.timestamp_micros(F.lit(1_700_000_000_123_456)), "fp": F.lit(b"x")})
    got = exact.drop_copies(df)
    assert got.dtypes == df.dtypes
    groups = {(keep, text) for _, keep, _, _, text in plain(ROWS)}
    assert sorted((repr(r["doc_id"]) for r in got.collect())) == sorted(repr(keep) for keep, _ in groups)
    assert got.where("at <> timestamp_micros(1700000000123456) or mark['k'] <> doc_id").count() == 0
