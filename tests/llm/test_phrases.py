"""Collocations by dynamic itemset counting against counting every n-gram."""

import random
import re
from collections import Counter

import pytest

from linkloom.llm import phrases
from tests.llm.helpers import odd_texts

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, share, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, p), a in found.items():
        if len(p) == 3:
            for part in (p[:2], p[1:]):
                around[lang, part] = max(around[lang, part], a)
    by: dict[str, list] = {}
    for (lang, p), a in found.items():
        if not around[lang, p] or 100 * around[lang, p] < share * a:
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in by.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


def texts(seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["The", "THE", "é", "a\x1cb", "日本", "x" * 300]
    made = [" ".join(r.choice(words) if r.random() < 0.5 else words[int(r.random() ** 4 * 12)] for _ in range(r.randint(0, 80))) for _ in range(150)]
    made = [t.replace("w3", "w3" + r.choice([" ", ".", ", ", "\n", "\t", " ?"])) for t in made]
    # Each of these comes late, in one text, over and over.
    return made + ["tic tic tic tac " * 40, "new york city " * 25 + "new york. " * 12, *odd_texts(), None, ""]


@pytest.mark.parametrize("slots", [phrases.CHUNK, 1 << 20])
@pytest.mark.parametrize(("shards", "least", "top"), [(1, 3, 40), (3, 4, 2000), (5, 10, 7)])
def test_phrases(spark, slots, shards, least, top):
    rows = [(("en", "fr", None)[i % 3], t, "x", 5) for i, t in enumerate(texts(shards))]
    rows += rows[:20] + [("one", "many words " * 4000, "x", 1)] * 2
    df = spark.createDataFrame(rows, "lang string, text string, phrase string, n int").repartition(4)
    found = phrases.frequent_phrases(df, least, shards, slots, slots)
    got = phrases.ranked(phrases.collocations(found, 50), ["lang"], phrases.ORDER, top)
    got = got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == plain([r[:2] for r in rows], least, 50, top)


def test_slots_shared_by_most_phrases_change_nothing(spark, monkeypatch):
    """Sixteen slots: nearly every phrase is started by others."""
    monkeypatch.setattr(phrases, "CHUNK", 8)
    rows = [("en", t) for t in texts(9)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = phrases.frequent_phrases(df, 5, 3, 16, 16).where("size > 0")
    want = Counter()
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert {r["phrase"]: r["n"] for r in found.collect()} == {p: n for p, n in want.items() if n >= 5}


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    rows = [("en", 0, "", 9 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)]
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint")).first()
    assert got["score"] == 10**6 * (big - 1) ** 2 // (2 * big * (big + 1))


def test_no_rows(spark):
    got = phrases.top_phrases(spark.createDataFrame([], "lang string, text string"))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.collect() == []
