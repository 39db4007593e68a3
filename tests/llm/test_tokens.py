"""The transducer lexicon and the packing against the tokenizers library."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkloom.llm import lexicon, packing
from tests.llm.helpers import frame, odd_texts

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size", [0, 5, 100_000])
def test_encode_as_the_library(spark, size):
    texts = odd_texts() + ["the cat and the hat sat"] * 5
    got = {r["doc_id"]: r for r in lexicon.encode_rows(frame(spark, texts), WORDS, size, digest=False).collect()}
    library = Tokenizer.from_file(WORDS)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_automaton_numbers_its_words(tmp_path):
    r = random.Random(1)
    found = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 7))).encode() for _ in range(400)})
    lexicon.save(str(tmp_path / "x"), found, [[i, i + 1] for i in range(len(found))])
    got = lexicon.Lexicon(str(tmp_path / "x"))
    assert got.numbers(found).tolist() == list(range(len(found)))
    assert np.frombuffer(got.ids(7), np.uint32).tolist() == [7, 8]
    others = [b"", b"d", b"abcabcabcabc", *(w + b"z" for w in found[:20])]
    assert got.numbers(others).tolist() == [-1] * len(others)
    assert len(got.ends) < len(found)  # suffixes are shared


def test_merging_many_words_as_one_by_one():
    r, bpe = random.Random(5), lexicon.Bpe(WORDS)
    found = [bytes(r.choice(b"etaoin shrdlu\xc3\xa9\x00\xff'9") for _ in range(n % 45 + 1)) for n in range(3000)]
    found += [b"a" * n for n in range(1, 70)] + [b"the", b"the"]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_all(found)] == [bpe.merge(w) for w in found]
    assert bpe.merge_all([]) == []


@pytest.mark.parametrize("chunk", ["word.", "word'", "'s", "it's", "a1.", "don't!?", "...", "x²", "é,", "'ll.", "l'"])
def test_words_of_a_chunk(chunk):
    assert lexicon.words(chunk) == lexicon._KINDS.findall(chunk)


def test_encode_long_null_and_repeated_rows(spark):
    long = "".join(f"word{i % 977} 'tis über{i % 89}-" + ("x" * 300 if i % 5000 == 0 else "") for i in range(60_000))  # over 1 MB
    texts = [long, None, "", long, "<|endoftext|>" * 3]
    rows = spark.createDataFrame([(7 if i < 2 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    library = Tokenizer.from_file(WORDS)
    got = Counter((x["doc_id"], tuple(x["ids"]), x["decoded"]) for x in lexicon.encode_rows(rows, WORDS, 50, digest=False).collect())
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    want = Counter((7 if i < 2 else None, tuple(x), library.decode(x, skip_special_tokens=False)) for i, x in enumerate(ids))
    assert got == want


def test_empty_tables(spark):
    none = frame(spark, [])
    assert lexicon.encode_rows(none, WORDS).collect() == []
    assert packing.pack_rows(none, BYTES).collect() == []


def test_pieces_and_sequences(spark):
    texts = odd_texts() + ["word " * 700, "other " * 30] * 4
    got = packing.pack_rows(frame(spark, texts), BYTES, 256).collect()
    library = Tokenizer.from_file(BYTES)
    ids = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert sum(r["length"] for r in got) == sum(map(len, ids))
    by_sequence = {}
    for r in got:
        own = ids[r["doc_id"]]
        piece = np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(own), crc32(piece))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256


def test_full_pieces_meet_a_broadcast_table(spark):
    """A third of all pieces has one length; they find their slots without a shuffle on it."""
    texts = ["word " * 3000] * 20 + [None, ""] + [f"text {i} " * i for i in range(40)]
    made = packing.pack_rows(frame(spark, texts, [5] * 20 + list(range(42))), BYTES, 256)
    got = made.collect()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 256
    library = Tokenizer.from_file(BYTES)
    assert sum(r["length"] for r in got) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_shortest_pack_first():
    r = random.Random(2)
    histogram = dict(Counter(min(2048, int(r.expovariate(1 / 400)) + 1) for _ in range(50_000)))
    found = packing.patterns(histogram)
    placed = Counter()
    for pattern, n in found:
        assert sum(pattern) <= 2048
        assert list(pattern) == sorted(pattern, reverse=True)
        for size in pattern:
            placed[size] += n
    assert placed == histogram
    tokens = sum(k * n for k, n in histogram.items())
    assert tokens / 2048 / sum(n for _, n in found) > 0.99
    covered = {}
    for size, lo, hi, *_ in packing.slots(found):
        covered.setdefault(size, []).append((lo, hi))
    for size, ranges in covered.items():
        ranges.sort()
        assert ranges[0][0] == 0 and ranges[-1][1] == histogram[size]
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert packing.patterns({}) == []
