"""The weighted hash tree."""

from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from linkloom.llm import sharding
from tests.llm.helpers import frame, odd_texts


def test_rows(spark):
    texts = odd_texts() * 3
    got = sharding.shard_rows(frame(spark, texts, [*range(len(texts) - 2), None, 7])).collect()
    assert len(got) == len(texts)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter((len((t or "").encode()) + 1, crc32((t or "").encode())) for t in texts)
    assert Counter((r["size"], r["text_crc32"]) for r in got) == sizes
    assert sharding.shard_rows(frame(spark, [])).collect() == []


def test_growth_and_weights(spark):
    ids = spark.range(6000).select(F.col("id").cast("string").alias("k"))
    tree = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 2.0}}, "b": {"r3": {3: 4.0}, "empty": {9: 0.0}}}
    heavier = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 4.0}}, "b": tree["b"]}
    k = F.col("k")
    rows = ids.select(sharding.assign(k, tree).alias("s"), sharding.assign(k, heavier).alias("h"), *[sharding.assign(k, sharding.standard_tree(n)).alias(f"n{n}") for n in (8, 9, 10)]).collect()
    share = Counter(r["s"] for r in rows)
    assert abs(share[3] / 6000 - 0.5) < 0.03 and abs(share[0] / 6000 - 0.125) < 0.02 and share[9] == 0
    for r in rows:
        # Only a's part and r2's part of it gained weight: nothing moves into b, or out of r2.
        assert r["s"] == r["h"] or (r["h"] != 3 and r["s"] != 2)
        assert r["n9"] in (r["n8"], 8) and r["n10"] in (r["n9"], 9)
