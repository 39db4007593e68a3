"""Embedding, SimHash and passage duplicates against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from linkloom.llm import embeddings, simhash, suffix
from linkloom.llm.common import components
from tests.llm.helpers import frame, odd_texts, roots


def test_components(spark):
    r = random.Random(4)
    pairs = [(r.randint(-50, 150), r.randint(-50, 150)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = roots(pairs, {n for p in pairs for n in p})
    assert {n: got.get(n, n) for n in want} == want


def test_vector_links(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)  # so that blocks of a bucket are tried
    rng = np.random.default_rng(5)
    vectors = list(rng.normal(size=(150, 24)))
    for k in range(6):
        center = rng.normal(size=24)
        vectors += [center + rng.normal(size=24) * 0.15 * (k % 3) for _ in range(60 if k == 1 else 12)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    rows += [(900 + i, rows[i][1]) for i in range(20)] + [(5, rows[5][1])]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] * 24]
    df = spark.createDataFrame(rows + [(2000 + i, v) for i, v in enumerate(odd)] + [(3000, [1.0, 2.0]), (3001, [2.0, 4.0])], "vec_id bigint, embedding array<float>").repartition(3)
    got = embeddings.link_rows(df).collect()
    unit = np.array([v for _, v in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [i for i, _ in rows]
    root = roots([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)], set(ids))
    want = sorted((i, int(n), root[i], root[i] == i) for i, n in zip(ids, near.sum(1), strict=True))
    want += [(2000 + i, 0, 2000 + i, True) for i in range(6)] + [(3000, 1, 3000, True), (3001, 1, 3000, False)]
    assert sorted(tuple(r) for r in got) == want
    assert embeddings.link_rows(df.where("vec_id < 0")).collect() == []


def test_recall_just_above_the_threshold():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    z = 0.951 * x + np.sqrt(1 - 0.951**2) * y
    a, b = embeddings.buckets(x), embeddings.buckets(z)
    found = ((b == a[:, :, :1]).any(2) | (a == b[:, :, :1]).any(2)).any(1)
    assert found.mean() > 0.97


@pytest.mark.parametrize("dim", [64, 256, 768])
@pytest.mark.parametrize("cosine", [0.9501, 0.97])
def test_planted_pairs_by_width(dim, cosine):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(1500, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = embeddings.buckets(x), embeddings.buckets(cosine * x + np.sqrt(1 - cosine**2) * y)
    found = ((b == a[:, :, :1]).any(2) | (a == b[:, :, :1]).any(2)).any(1)
    assert found.mean() >= 0.995


def test_fingerprint():
    def plain(text):
        words = text.lower().split()
        if not words:
            return 0
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for t in [x.encode() for x in odd_texts() if x is not None]:
        assert simhash.fingerprint(t) == plain(t)


def test_fingerprint_hash_is_spark_s(spark):
    texts = ["a b c d", "x", "Ünï code words here"]
    got = [r[0] for r in frame(spark, texts).orderBy("doc_id").select(F.xxhash64("text")).collect()]
    assert got == [simhash.signed(xxh64_intdigest(t.encode(), 42)) for t in texts]


def test_links_of_fingerprints(spark):
    rng = np.random.default_rng(0)
    prints = set()
    for center in rng.integers(0, 2**63 - 1, 25):
        for _ in range(25):
            x = int(center)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            prints.add(simhash.signed(x))
    df = spark.createDataFrame([(x,) for x in prints], "f bigint")
    got = [(r["a"], r["b"]) for r in simhash.links(df).collect()]
    near = [(a, b) for a, b in combinations(prints, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in got)
    assert roots(got, prints) == roots(near, prints)


def test_thresholds_keep_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (50, 64)).astype(np.uint8)
    p = np.clip(rng.random(64), 0.01, 0.99)
    groups = [list(range(0, 20)), list(range(20, 44)), list(range(44, 64))]
    for n in (10, 10**6, 10**10):
        t = simhash.thresholds(bits, groups, p, n)
        assert (t.sum(1) == 4 - 3 + 1).all() and (t >= -1).all()


def test_simhash_groups(spark):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [base, base + " end", base.upper(), None, "", " \n", "one", "One", "quite another text of some words"] + odd_texts()[10:40]
    ids = [*range(10, 10 + len(texts))]
    texts += [base, "x y z"]
    ids += [None, None]
    rows = simhash.group_rows(frame(spark, texts, ids)).collect()
    prints = [simhash.fingerprint((t or "").encode()) for t in texts]
    assert sorted(r["fingerprint"] for r in rows) == sorted(f"{p:016x}" for p in prints)
    near = [(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    place = roots(near, range(len(texts)))
    want = {}
    for k, i in enumerate(ids):
        if i is not None:
            want[place[k]] = min(want.get(place[k], i), i)
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows)
    assert got == sorted((i or -1, want.get(place[k], -1)) for k, i in enumerate(ids))
    kept = simhash.keep_first(frame(spark, texts + [base], ids + [10])).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == sorted(want.get(p, -1) for p in set(place.values()))
    assert set(kept[0].asDict()) == {"doc_id", "text", "size"}
    assert simhash.group_rows(frame(spark, [])).collect() == []


def _brute(docs):
    first = {}
    for i, b in docs:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, suffix.LAST), suffix.LAST if i is None else i)
    out = []
    for i, b in docs:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (suffix.LAST if i is None else i):
                gone[p : p + 50] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("small", [True, False, "hot"])
def test_repeated_passages(spark, monkeypatch, small):
    if small == "hot":
        monkeypatch.setattr(suffix, "HOT_TEXTS", 2)
    if small:
        for name, value in (("BLOCK_BYTES", 3000), ("BUCKET_BYTES", 4000), ("BATCH_WINDOWS", 300), ("CHUNK_BYTES", 700)):
            monkeypatch.setattr(suffix, name, value)
    r = random.Random(5)

    def noise(n):
        return "".join(r.choice("abcdefgh \n") for _ in range(n))

    shared = [noise(200) for _ in range(12)]
    texts, ids = [], []
    for i in range(250):
        t = ""
        for _ in range(r.randint(0, 5)):
            kind = r.random()
            if kind < 0.4:
                s = r.randint(0, 100)
                t += r.choice(shared)[s : s + r.randint(30, 100)]
            elif kind < 0.5:
                t += "é" * r.randint(10, 80)
            elif kind < 0.6:
                t += "ab" * r.randint(10, 60) + "\0" * r.randint(0, 60)
            else:
                t += noise(r.randint(1, 90))
        texts.append(t if r.random() < 0.98 else None)
        ids.append(r.choice([None, i, i, i, r.randint(0, 250)]))
    texts, ids = texts + texts[:20], ids + ids[:20]
    df = spark.createDataFrame([(i, t, str(k)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "doc_id bigint, text string, k string").repartition(3)
    got = {int(x["extra"]): x for x in suffix.dedupe(df, "k").collect()}
    bodies = [(t or "").encode() for t in texts]
    for k, gone in enumerate(_brute(list(zip(ids, bodies, strict=True)))):
        assert got[k]["kept"] == np.frombuffer(bodies[k], np.uint8)[~gone].tobytes()
        assert (got[k]["doc_id"], got[k]["n_bytes"], got[k]["n_removed"]) == (ids[k], len(bodies[k]), gone.sum())
        assert got[k]["n_spans"] == np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1)
    assert suffix.dedupe_rows(df.where("doc_id < 0")).collect() == []


def _sharing_a_phrase(n):
    """Documents of which most hold one phrase of 41 bytes in surroundings of their own, and some repeat others."""
    r = random.Random(9)
    phrase = "a phrase shorter than any passage that goes"[:41]
    out = []
    for i in range(n):
        left, right = ("".join(r.choice("abcdefgh ") for _ in range(40)) for _ in range(2))
        out.append(left + phrase + right if i % 50 else out[r.randrange(i)][:70] + left if i else left)
    return out


def test_phrase_in_most_documents(spark):
    texts = _sharing_a_phrase(6000)
    bodies = [t.encode() for t in texts]
    want = _brute(list(enumerate(bodies)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {x["doc_id"]: x for x in suffix.dedupe(df).collect()}
    assert len(got) == len(texts)
    assert sum(gone.any() for gone in want) > 100
    for i, gone in enumerate(want):
        assert got[i]["kept"] == np.frombuffer(bodies[i], np.uint8)[~gone].tobytes()


def test_windows_of_a_hot_anchor_spread():
    bodies = [t.encode() for t in _sharing_a_phrase(6000)]
    block = suffix._Block(bodies, list(range(6000)), 12)
    assert block.texts().max() > suffix.HOT_TEXTS
    hot = {k: block.texts()[p] > suffix.HOT_TEXTS for k, p in block.parts()}
    flags = lambda marks: {k: np.packbits(np.r_[np.ones(len(m), bool), m]).tobytes() for k, m in marks.items()}
    whole = block.shared(flags({k: m & False for k, m in hot.items()}))
    split = block.shared(flags(hot))
    count = lambda asked: {k: int(n.sum()) for k, (_, _, n) in asked.items()}
    assert sum(count(whole).values()) == sum(count(split).values()) == sum(len(b) - 49 for b in bodies if len(b) >= 50)
    beyond = {k: n for k, n in count(split).items() if k >= 12}
    assert len(beyond) == 12 * suffix.SPLIT
    assert max(beyond.values()) < 2 * sum(beyond.values()) / len(beyond)
    # Equal windows meet in one bucket.
    home = {}
    for k, (doc, start, n) in split.items():
        if k >= 12:
            assert (n == 1).all()
            for d, s in zip(doc.tolist(), start.tolist(), strict=True):
                assert home.setdefault(bodies[d][s : s + 50], k) == k


def test_cut_characters():
    body = "aéb".encode()
    spans = lambda *x: np.array(x, np.int64).tobytes()
    assert suffix.cut_characters(body, spans(0, 2)) == "éb"
    assert suffix.cut_characters(body, spans(2, 4)) == "aé"
    assert suffix.cut_characters(body, spans(1, 3)) == "ab"
    assert suffix.cut_characters(body, spans()) == "aéb"
