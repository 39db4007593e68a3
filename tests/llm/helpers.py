"""Small brute-force helpers of the operator tests."""

from __future__ import annotations

import random


def roots(pairs, nodes):
    """The smallest node that each node reaches over the pairs."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def odd_texts():
    """Texts with unusual blanks, signs, repeats and special strings."""
    r = random.Random(3)
    fixed = [
        None, "", "  ", "\n\n", "Hello WORLD's it'll 12345 !!!???", "a<|endoftext|>B <|startoftext|>x<|endoftext", "ΑΣ ΣΑΣ. İstanbul ǅ ß ﬁ",
        "é Å \x1c\x1dabc \x85   d​x", "日本語 🙂🙂 ½²³", "=" * 300 + " " + "aB" * 200, "\0null \0", "don't DON'T 'S 'st ''s", "x " * 500,
    ]
    signs = "abcXYZ'’stldmrev \n\t.,!09é́Σ 　<|>#🙂ñß"
    return fixed + ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(200)]


def frame(spark, texts, ids=None):
    """(doc_id, text) and a clashing extra column, over a few partitions."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "x") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, size string").repartition(3)
