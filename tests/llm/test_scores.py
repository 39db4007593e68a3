"""Quality, toxicity, license and language-model scores against plain versions."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import licenses, ppm, quality, toxicity
from tests.llm.helpers import frame, odd_texts


def _plain_base(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    chars = sum(c not in " \t\n\r\x0b\x0c" for c in text)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_rules(spark):
    texts = odd_texts() + ["a b c d e f a b c d e g", "x\nx\n\nx y\n \n \n", " ".join(f"w{i % 7}" for i in range(50))]
    rows = quality.rate_rows(frame(spark, texts), frame(spark, []).select("doc_id")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, repeats = _plain_base(texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert r["kept"] == (not r["base_failed"]) and r["rate"] == 0  # nothing is trusted here


def test_many_distinct_words():
    words = [str(i).encode() for i in range(9000)]
    assert quality.repeated_words(words + words[:6]) == 12


def test_rate(spark):
    r = random.Random(1)
    clean = [" ".join(r.choice("the of a and house tree walks runs sees".split()) + str(r.randint(0, 3)) for _ in range(200)) for _ in range(60)]
    junk = [" ".join(r.choice("BUY NOW CHEAP DEAL".split()) + "!" * r.randint(1, 9) + str(r.randint(0, 30)) for _ in range(200)) for _ in range(30)]
    texts = clean + junk
    trusted = frame(spark, [None] * 30).select("doc_id")
    got = {x["doc_id"]: x for x in quality.rate_rows(frame(spark, texts), trusted).collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert not any(got[i]["kept"] for i in range(60, 90))
    raw, target = Counter(), Counter()
    split = [quality.buckets(t.encode().split(), quality._Hashes()).tolist() for t in texts]
    for i, b in enumerate(split):
        raw.update(b)
        target.update(b if i < 30 else [])
    share = sum(target.values()) / sum(raw.values())
    for i in (3, 50, 70):
        want = np.mean([math.log((target[b] / share + 5) / (raw[b] + 5)) for b in split[i]])
        assert got[i]["rate"] == pytest.approx(want)
    kept = quality.keep_good(frame(spark, texts), trusted)
    assert kept.columns == ["doc_id", "text", "size"] and kept.count() == 60
    assert quality.rate_rows(frame(spark, []), trusted).collect() == []


def _toxic_corpus():
    r = random.Random(2)
    filler = [f"word{i}" for i in range(300)]
    texts, toxic = [], []
    for i in range(900):
        words = r.sample(filler, 40)
        bad = i % 5 == 0
        if bad:  # an insult beside a group; either alone is harmless
            words[3:5] = ["grumbles", "zorgfolk"]
        elif i % 5 == 1:
            words[3] = "grumbles"
        elif i % 5 == 2:
            words[7] = "zorgfolk"
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def test_pairs_of_terms(spark):
    texts, toxic = _toxic_corpus()
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)], "doc_id bigint, toxic int")
    rows = toxicity.score_rows(frame(spark, texts), labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(900) if crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.97
    kept = toxicity.drop_toxic(frame(spark, texts), labels)
    assert kept.columns == ["doc_id", "text", "size"]
    assert kept.count() == sum(1 - r["predicted"] for r in rows)


def test_toxicity_of_odd_rows(spark):
    texts = odd_texts()
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] < 1e-6 for r in toxicity.score_rows(frame(spark, texts), none).collect()} == {True}
    labels = spark.createDataFrame([(0, None), (1, 1), (None, 1), (2, 0), (2, 0)], "doc_id bigint, toxic int")
    rows = toxicity.score_rows(frame(spark, texts, [None, *range(1, len(texts))]), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_rows(frame(spark, []), labels).collect() == []


def test_repeated_ids_train_once(spark):
    texts, toxic = _toxic_corpus()
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)], "doc_id bigint, toxic int")
    ids = list(range(len(texts)))
    once = toxicity.fit(frame(spark, texts), labels)
    hot = next(i for i in ids if toxic[i])
    often = toxicity.fit(frame(spark, texts + [texts[hot]] * (len(texts) // 2), ids + [hot] * (len(texts) // 2)), labels)
    assert often.chosen == once.chosen
    assert often.bias == once.bias and (often.linear == once.linear).all() and (often.factors == once.factors).all()


def test_toxicity_of_a_long_text(spark):
    texts, toxic = _toxic_corpus()
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)], "doc_id bigint, toxic int")
    machine = toxicity.fit(frame(spark, texts), labels)
    long = "plain words of no harm " * 50_000 + " ".join(texts[:50])  # over 1 MB
    other = [long, None, "", long]
    score = toxicity.scoring(spark, machine)
    rows = frame(spark, other).select("doc_id", score(toxicity.utf8(toxicity.F.col("text")))["score"].alias("score")).collect()
    present = {b for w in toxicity.words(long.encode()) for b in toxicity.terms(w) if b in machine.chosen}
    want = machine.score(sorted(machine.chosen[b] for b in present))
    bare = machine.score([])
    assert {r["doc_id"]: r["score"] for r in rows} == pytest.approx({0: want, 1: bare, 2: bare, 3: want})


def test_machine_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = toxicity.Machine(0.3, {}, rng.normal(size=6), rng.normal(size=(6, 4)))
    z = 0.3 + sum(m.linear[i] for i in (0, 2, 5)) + sum(m.factors[i] @ m.factors[j] for i, j in ((0, 2), (0, 5), (2, 5)))
    assert m.score([0, 2, 5]) == pytest.approx(1 / (1 + math.exp(-z)))


def _plain_license(text):
    import re

    def words(x):
        return re.sub("[^a-z0-9]+", " ", x.lower()).split()

    def pairs(x):
        w = words(x)
        return set(zip(w, w[1:], strict=False))

    units = [text, *text.split("\n"), *re.split(r"[.!?]+(?=\s|$)|\n", text), *re.split(r"\n\s*\n", text)]
    best = (0.0, None)
    for u in units:
        a = pairs(u)
        for name, t in licenses.TEMPLATES:
            b = pairs(t)
            d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if d >= 0.8 and (-d, name) < (-best[0], best[1] or "~"):
                best = (d, name)
    return best


def test_licenses(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    half = mit.split()
    texts = odd_texts() + [
        mit, mit.upper(), "Some text.\n\n" + mit.replace(". ", ".\n") + "\n\nMore of it.", " ".join(half[: len(half) // 2]), "We say: Released under the MIT License. Really.",
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT license", "licensed under cc by sa 4 0", " ".join(half[:-12]), "license " * 300,
    ]
    rows = licenses.scan(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        dice, name = _plain_license(texts[r["doc_id"]] or "")
        assert (r["license"], r["dice"]) == (name, pytest.approx(dice))
    both = next(r for r in rows if r["doc_id"] == len(texts) - 4)
    assert both["licenses"] == "CC-BY-NC-4.0,MIT" and both["n_matches"] == 2
    assert licenses.scan(frame(spark, [])).collect() == []


def test_needed_pairs(spark):
    """A text with two thirds of a template's bigrams, whichever, has one of the needed pairs; hashes are Spark's."""
    r = random.Random(4)
    ready = [licenses.template_bigrams(t) for _, t in licenses.TEMPLATES]
    needed = set(licenses.needed_pairs(ready, 2 / 3))
    texts, wanted = [], []
    for pairs in ready:
        least = math.ceil(2 * len(pairs) / 3)
        assert len(pairs) - len(needed & {*pairs}) < least
        for _ in range(20):
            assert needed & {*r.sample(pairs, least)}
    for a, b in [*r.sample(sorted(needed), 40), ("the", "of"), ("x", "licensed")]:
        for text in (f"so {a} {b} on", f"{a}.\n\t{b}", f"x{a} {b}", f"{a} {b}x", f"{a} x {b}"):
            texts.append(text.upper())
            words = licenses.WORDS.findall(text)
            wanted.append(any(p in needed for p in zip(words, words[1:], strict=False)))
    pattern = licenses.pairs_pattern(sorted(needed))
    rows = frame(spark, texts).select("doc_id", F.regexp_like(F.lower("text"), F.lit(pattern)).alias("hit")).collect()
    assert [x["hit"] for x in sorted(rows, key=lambda x: x["doc_id"])] == wanted
    hashed = spark.range(1).select(F.xxhash64(F.lit("mit"), F.lit("license")).alias("h")).first()["h"]
    assert hashed == licenses.pair_hash("mit", "license")


def test_licenses_in_several_parts(spark):
    r = random.Random(9)
    other = lambda n: " ".join(f"w{r.randint(0, 5000)}" for _ in range(n))
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    cut = [mit.index("The above copyright"), mit.index("THE SOFTWARE IS PROVIDED")]
    parts = [mit[: cut[0]].strip(), mit[cut[0] : cut[1]].strip(), mit[cut[1] :].strip()]
    gpl = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and len(t) > 100)
    split = "\n\n".join(parts)
    texts = [
        f"{other(150)}.\n\nMIT License\n\nCopyright 2020 A\n\n{split}\n\n{other(200)}.",
        f"{other(40)}. {gpl} {other(60)}.",
        f"{other(80)}.\n{split}\n{other(90)}.\nReleased under the MIT License.\n{other(50)}.\n{split}\n{other(9)}.",
        "\n\n".join([other(120), *parts[:1], other(150)]),
        f"{other(30)}.\nReleased under\nthe MIT License.\n{other(30)}.",
    ]
    rows = sorted(licenses.scan(frame(spark, texts)).collect(), key=lambda x: x["doc_id"])
    assert [x["license"] for x in rows] == ["MIT", "GPL-3.0", "MIT", None, "MIT"]
    assert [x["n_matches"] for x in rows] == [1, 1, 3, 0, 1]
    assert [x["unit"] for x in rows] == ["window", "window", "sentence", None, "window"]
    assert rows[0]["dice"] == rows[1]["dice"] == rows[4]["dice"] == 1


def test_published_texts(spark):
    clauses = [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "3. Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ]
    rest = next(t for n, t in licenses.TEMPLATES if n == "BSD-2-Clause" and len(t) > 100).split("provided with the distribution.")[1].strip()
    by_name = {n: t for n, t in licenses.TEMPLATES if len(t) > 1000}
    ahead, after = "Copyright 2021 Acme and others\n\n", "\n\n" + " ".join(f"w{i}" for i in range(200))
    texts = [ahead + "\n\n".join([*clauses, rest]) + after, ahead + "\n\n".join([*clauses[:3], rest]) + after]
    texts += [ahead + by_name[n].replace(". ", ".\n") + after for n in ("Apache-2.0", "Unlicense")]
    rows = sorted(licenses.scan(frame(spark, texts)).collect(), key=lambda x: x["doc_id"])
    assert [x["licenses"] for x in rows] == ["BSD-3-Clause", "BSD-2-Clause", "Apache-2.0", "Unlicense"]


def _plain_ppm(docs):
    def norm(t):
        return b" ".join((t or "").encode().lower().split()) + b"\n"

    trained = [t for i, t in docs if crc32(str(i).encode()) % 7 != 2]
    seen, count = defaultdict(Counter), Counter()
    for t in trained:
        b = bytes(5) + norm(t)
        for p in range(5, len(b)):
            for k in range(6):
                seen[b[p - k : p]][b[p]] += 1
        count.update([*(t or "").encode().lower().split(), "end"])
    n, v, out = sum(count.values()), len(count), {}
    for i, t in docs:
        b, score = bytes(5) + norm(t), 0.0
        for p in range(5, len(b)):
            gone = set()
            for k in range(5, -1, -1):
                c = seen.get(b[p - k : p])
                if c is None:
                    continue
                total, kinds = sum(x for s, x in c.items() if s not in gone), len(c.keys() - gone)
                if b[p] in c:
                    score += math.log10(c[b[p]] / (total + kinds))
                    break
                score += math.log10(kinds / (total + kinds)) if kinds else 0
                gone |= set(c)
            else:
                score -= math.log10(256 - len(gone))
        words = [*(t or "").encode().lower().split(), "end"]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)
        out[i] = (crc32(str(i).encode()) % 7 == 2, len(words), sum(count[w] > 0 for w in words), n, base, score)
    return out


@pytest.mark.parametrize("small", [True, False])
def test_partial_matching(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK_BYTES", 900), ("BUCKET_BYTES", 400), ("SORTED", 300)):
            monkeypatch.setattr(ppm, name, value)
    texts = odd_texts()[:80] + ["the cat sat on the mat and the hat"] * 6
    rows = ppm.score_rows(frame(spark, texts)).collect()
    want = _plain_ppm(list(enumerate(texts)))
    assert len(rows) == len(texts)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4]) and r["score"] == pytest.approx(w[5])


def test_partial_matching_without_training(spark):
    held = [i for i in range(60) if crc32(str(i).encode()) % 7 == 2]
    rows = ppm.score_rows(frame(spark, ["ab"] * len(held), held)).collect()
    assert {round(r["score"], 9) for r in rows} == {round(3 * math.log10(1 / 256), 9)}
    assert {(r["train_tokens"], r["n_known"]) for r in rows} == {(0, 0)}
    assert ppm.score_rows(frame(spark, [])).collect() == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(8)
    bodies = [bytes(rng.integers(97, 101, 60).astype(np.uint8)) + b"\n" for _ in range(20)]
    g, n = ppm.distinct(ppm.grams(bodies))
    key, count = ppm.distinct((g >> np.uint64(32)) << np.uint64(8) | g & np.uint64(255), n)
    low = ppm.low_levels((key >> np.uint64(8)) << np.uint64(32) | key & np.uint64(255), count)
    for context in (b"abcda", b"zzabc", b"zzzzz", b"\0\0\0ab"):
        asked = np.array([int.from_bytes(context[::-1] + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** ppm.costs(asked, g, n, low)).sum() == pytest.approx(1)
