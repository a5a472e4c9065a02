import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mediacat.llm import packing
from mediacat.llm.tables import written

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, number int, size string, sequence int"


def best_fit(sizes, limit):
    """Sequences of best fit, falling, one document at a time."""
    gaps, opened = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect_left(gaps, size)
        gap = gaps.pop(at) if at < len(gaps) else limit
        opened += gap == limit
        if gap > size:
            insort(gaps, gap - size)
    return opened


def checked(rows, limit):
    """Number of sequences, each without gaps or overlaps and within the limit."""
    sequences = defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


def pieces_of(spark, sizes):
    return written(spark.createDataFrame(list(enumerate(sizes)), "number long, length long").repartition(4))


CASES = {
    "uniform": lambda c: [c.randint(1, 2048) for _ in range(3000)],
    "one length held by most": lambda c: [700] * 1500 + [648] * 600 + [c.randint(1, 100) for _ in range(400)],
    "thirds": lambda c: [c.randint(600, 760) for _ in range(1500)] + [c.randint(1030, 1300) for _ in range(500)],
    "sand": lambda c: [1] * 3000 + [2048] * 20 + [2047] * 50 + [1500] * 100,
    "halves": lambda c: [1024] * 501,
    "one": lambda c: [5],
}


@pytest.mark.parametrize("case", CASES)
def test_as_few_sequences_as_best_fit(spark, monkeypatch, case):
    """Many small ranges: at most one sequence in a hundred more than one document at a time gives."""
    monkeypatch.setattr(packing, "RANGE_ROWS", 400)
    sizes = CASES[case](random.Random(3))
    pieces = pieces_of(spark, sizes)
    placed = pieces.join(packing.place(pieces), "number").collect()
    assert Counter(r.number for r in placed) == Counter(range(len(sizes)))
    n = checked([(r.sequence, r.offset, r.length) for r in placed], 2048)
    assert -(-sum(sizes) // 2048) <= n <= best_fit(sizes, 2048) * 1.01 + 1


def plain(docs, path, limit):
    machine, out = Tokenizer.from_file(path), Counter()
    for name, text, *_ in docs:
        ids = np.array(machine.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), limit)):
            out[name, k, at, len(ids[at : at + limit]), zlib.crc32(ids[at : at + limit].tobytes())] += 1
    return out


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_equal_the_library(spark, monkeypatch, path):
    """Nulls, empty and very long texts, special strings, odd spaces and letters, repeated rows, clashing column names."""
    monkeypatch.setattr(packing, "SLICE_BYTES", 5_000)
    chance = random.Random(5)
    alphabet = ["Straße.", "été,", "don't", "I'm", "a1b2", "…", "İstanbul", "é́x", "日本語", "🙂🙂.", "<|endoftext|>", "x<|startoftext|>y", " z",
                "ÄÖÜ!?", "ÿ;", "w.w.w", "hello", "world."]
    docs = [(i, " ".join(chance.choices(alphabet, k=k)), 1, "x", 2) for i, k in enumerate([1, 3, 50, 300, 20, 20, 700])]
    docs += [(90, chance.choice(" \n\t").join(chance.choices(alphabet, k=6000)), 1, None, 2), (91, "ab" * 6000, 1, "", 0)]
    docs += [(None, None, 1, "x", 2), (8, "", 1, "x", 2), (9, " \n", 1, "x", 2), (1, "again and again", 1, "x", 2), (1, "again and again", 1, "x", 2)]
    got = packing.pack(spark.createDataFrame(docs, SCHEMA).repartition(3), path, limit=64).collect()
    assert Counter(tuple(r)[:5] for r in got) == plain(docs, path, 64)
    total = sum(r.length for r in got)
    assert -(-total // 64) <= checked([(r.sequence_id, r.offset, r.length) for r in got], 64) <= -(-total // 64) + 3


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.pack(docs, WORDS).collect()
    assert Counter(tuple(r)[:5] for r in got) == plain([(r.doc_id, r.text) for r in docs.collect()], WORDS, 2048)
    assert checked([(r.sequence_id, r.offset, r.length) for r in got], 2048) <= best_fit([r.length for r in got], 2048) + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), WORDS).collect() == []
