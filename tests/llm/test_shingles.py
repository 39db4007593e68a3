"""The pipeline's near-duplicate stage against brute force."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import pipeline, shingles
from tests.llm.helpers import frame, roots


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_at_jaccard(spark):
    r = random.Random(11)
    texts = [None, "", " \n", "one two", "ONE two", "one two three"]
    for g in range(12):
        base = [f"g{g}w{r.randint(0, 400)}" for _ in range(r.choice([8, 30, 120, 400]))]
        texts.append(" ".join(base))
        for _ in range(12):  # from nearly equal to far
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 20))):
                copy[r.randrange(len(copy))] = f"x{r.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    order = list(range(len(texts)))
    r.shuffle(order)
    sets = [_set(t) for t in texts]
    near = [(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    place = roots(near, range(len(texts)))
    want = {}
    for k, i in enumerate(order):
        want[place[k]] = min(want.get(place[k], i), i)
    assert len(set(place.values())) < len(texts) * 0.8
    kept = pipeline.near_duplicates(spark, frame(spark, texts, order), "")
    assert kept.columns == ["doc_id", "text", "size"]
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(want.values())
    again = frame(spark, texts[6:8] * 2 + [texts[6]], [None, 5, None, 5, 4])
    assert sorted(x["doc_id"] or -1 for x in pipeline.near_duplicates(spark, again, "").collect()) in ([4], [4, 5])
    assert pipeline.near_duplicates(spark, frame(spark, []), "").collect() == []


def test_candidates_by_the_pigeonhole_principle(spark):
    """Whatever the other fingerprints, two sets that differ in MOST bits of one are candidates."""
    rng = np.random.default_rng(3)
    prints = rng.integers(-(2**63), 2**63, (60, shingles.TABLES))
    want = set()
    for i in range(0, 60, 2):
        t = i % shingles.TABLES
        flips = rng.choice(64, shingles.MOST, replace=False)
        prints[i + 1, t] = prints[i, t] ^ np.bitwise_or.reduce(np.int64(1) << flips)
        want.add((i, i + 1))
    nodes = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(prints)], "node bigint, prints array<bigint>")
    found = shingles.candidates(shingles.probed(nodes).withColumn("root", F.col("node")), shingles.FIRST, True).collect()
    assert want <= {(r["x"], r["y"]) for r in found}
    assert all(r["key"] is None for r in found)


def test_fingerprints_of_a_similarity():
    """The differing bits of all fingerprints at a similarity of 0.8 stay below the limit, those of unlike sets don't."""
    rng = np.random.default_rng(4)
    for n in (4, 8, 40, 200):
        for _ in range(30):
            a = n // 8
            both, one, two, other = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (n, a, n // 4 - a, n))
            x, y, z = (np.array(shingles.sketch(s), np.int64) for s in (np.r_[both, one], np.r_[both, two], other))
            limit = shingles.FAR[0 if n < shingles.FEW else 1]
            assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= limit < np.bitwise_count((x ^ z).view(np.uint64)).sum()


def test_dense_group_in_rounds(spark, monkeypatch):
    """A large group of near copies, some of which link to few or none, gives its components and not its pairs."""
    monkeypatch.setattr(shingles, "CHUNK", 32)
    monkeypatch.setattr(shingles, "SMALL", 2)
    monkeypatch.setattr(shingles, "MORE", 4)
    compared = []
    verified = shingles._verified
    monkeypatch.setattr(shingles, "_verified", lambda pairs, *a: compared.append(pairs.count()) or verified(pairs, *a))
    r = random.Random(12)
    base = [f"w{r.randint(0, 9999)}" for _ in range(150)]
    texts = []
    for k in range(200):
        words = list(base)
        for _ in range(1 if k % 10 else 4):
            words[r.randrange(len(words))] = f"x{r.randint(0, 10**6)}"
        texts.append(" ".join(words))
    sets = [_set(t) for t in texts]
    near = [(i, j) for i, j in combinations(range(200), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    kept = pipeline.near_duplicates(spark, frame(spark, texts), "")
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(roots(near, range(200)).values()))
    assert sum(compared) < len(near) / 3


def test_rows_follow_the_size_of_a_group(spark, monkeypatch):
    """Near copies that mostly don't link cost a bounded number of rows each, over several blocks too."""
    monkeypatch.setattr(shingles, "MORE", 4)
    rows, staged = [], shingles.staged

    def counted(df, name, *a, **b):
        out = staged(df, name, *a, **b)
        rows.append(out.count())
        return out

    monkeypatch.setattr(shingles, "staged", counted)
    r = random.Random(13)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(w if i not in at else f"x{r.randint(0, 10**9)}" for i, w in enumerate(base)) for at in (r.sample(range(4, 146, 6), 2) for _ in range(750))]
    sets = [_set(t) for t in texts]
    near = [(i, j) for i, j in combinations(range(750), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    kept = pipeline.near_duplicates(spark, frame(spark, texts), "")
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(roots(near, range(750)).values()))
    assert sum(rows) < 2 * shingles.FIRST * shingles.TABLES * shingles.PARTS * len(texts)


def test_dense_bucket_gives_its_groups(spark):
    """A bucket with many candidates gives lists of members, each group apart, and no pairs."""
    one, other = 0x0F0F0F0F0F0F0F0F, 0x3333333300FF00FF
    rows = [(7, f ^ (1 << b), k * 100 + b, True) for k, f in enumerate((one, other)) for b in range(20)] + [(8, one, b, True) for b in range(2)]
    buckets = spark.createDataFrame(rows, "key bigint, f bigint, node bigint, own boolean")
    found = shingles.candidates(buckets).collect()
    assert sorted(sorted(r["members"]) for r in found if r["key"] == 7) == [list(range(20)), list(range(100, 120))]
    assert [(r["x"], r["y"]) for r in found if r["key"] is None] == [(0, 1)]
    assert {r["node"]: r["root"] for r in shingles.clusters(spark.createDataFrame([([3, 1],), ([5, 1],), ([9, 8],)], "members array<bigint>")).collect()} == {1: 1, 3: 1, 5: 1, 8: 8, 9: 8}
