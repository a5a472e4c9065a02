"""Token counts of whole texts, as a tokenizer's own library gives them.

A text of more than ``chunk`` characters is encoded in chunks that overlap. The offsets of
two neighbouring encodings are compared in the overlap, and they are spliced at a stable
boundary: a place after white space, around which both have the same tokens. White space
ends every word, special string and normalisation of the tokenizer, so tokens on one side
do not depend on the other. If no such place is found the overlap is doubled, up to the
whole chunk. By the same rule the words of a shorter text are counted one by one, each
distinct word of a slice once.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Repeated rows come out
once for each row. Input columns with the name of a result column give way to it.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .rows import appended
from .words import split_words, sums, text_bytes

CHUNK = 32_768
OVERLAP = 1_024
GUARD = 48
LIMIT = 2048
SPACE = " \t\n\v\f\r"
ENCODED_AT_ONCE = 4_096

RESULT = "n_bytes long, n_tokens long, over_limit boolean"


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoded:
    """Tokens of text[begin:end] by number, first and last character."""

    def __init__(self, machine, text: str, begin: int, end: int):
        found = machine.encode(text[begin:end], add_special_tokens=False)
        self.begin, self.end = begin, end
        spans = np.array(found.offsets, np.int64).reshape(-1, 2) + begin
        self.rows = np.column_stack([np.array(found.ids, np.int64), spans])

    def between(self, begin: int, end: int) -> np.ndarray:
        """Tokens that start at or after ``begin`` and before ``end``."""
        return self.rows[np.searchsorted(self.rows[:, 1], begin) : np.searchsorted(self.rows[:, 1], end)]


def stable_boundary(text: str, left: Encoded, right: Encoded) -> int | None:
    """A place in the overlap after white space, with the same tokens around it in both encodings."""
    low, high = right.begin, left.end
    middle = (low + high) // 2
    places = [p for p in range(low + 1, high) if text[p - 1] in SPACE]
    for p in sorted(places, key=lambda p: abs(p - middle)):
        around = max(low, p - GUARD), min(high, p + GUARD)
        inner = [x for x in around]
        # What the chunks' ends have cut up is no evidence: look from white space to white space.
        while inner[0] > low and inner[0] < p and text[inner[0] - 1] not in SPACE:
            inner[0] += 1
        while inner[1] < high and inner[1] > p and text[inner[1] - 1] not in SPACE:
            inner[1] -= 1
        if around[0] == low:
            inner[0] = next((q for q in range(low + 1, p) if text[q - 1] in SPACE), p)
        if around[1] == high:
            inner[1] = next((q for q in range(high - 1, p, -1) if text[q - 1] in SPACE), p)
        if inner[0] < inner[1] and np.array_equal(left.between(*inner), right.between(*inner)):
            return p
    return None


def spliced(machine, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a long text from overlapping chunks."""
    left, counted, total = Encoded(machine, text, 0, min(chunk, len(text))), 0, 0
    while left.end < len(text):
        lap = overlap
        while True:
            begin = max(left.begin, left.end - lap)
            right = Encoded(machine, text, begin, min(len(text), left.end + chunk))
            if begin == left.begin:  # the overlap is all of the chunk: it is replaced
                break
            place = stable_boundary(text, left, right)
            if place is not None and place > counted:
                total += len(left.between(counted, place))
                counted = place
                break
            lap *= 2
        left = right
    return total + len(left.between(counted, len(text) + 1))


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
                 chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """Rows of ``docs`` with the columns of ``RESULT``; ``path`` is a tokenizers file every executor has."""

    def begin():
        machine = tokenizer(path)

        def of_words(vocabulary: list[bytes]) -> np.ndarray:
            out = np.zeros(len(vocabulary), np.int64)
            for at in range(0, len(vocabulary), ENCODED_AT_ONCE):
                some = [w.decode() for w in vocabulary[at : at + ENCODED_AT_ONCE]]
                found = machine.encode_batch_fast(some, add_special_tokens=False)
                out[at : at + len(some)] = [len(x) for x in found]
            return out

        def measure(texts: pa.Array) -> list[pa.Array]:
            size = np.diff(text_bytes(texts)[1])
            characters = np.nan_to_num(np.asarray(pc.utf8_length(texts).to_numpy(zero_copy_only=False), float))
            huge = np.flatnonzero(characters > chunk)
            short = texts.filter(pa.array(characters <= chunk)) if len(huge) else texts
            words = split_words(short, lower=False)
            counts = np.zeros(len(texts), np.int64)
            if words.n:
                counts[characters <= chunk] = sums(of_words(words.vocabulary)[words.codes], words.texts)
            for i in huge.tolist():
                counts[i] = spliced(machine, texts[i].as_py(), chunk, overlap)
            return [pa.array(size.astype(np.int64)), pa.array(counts), pa.array(counts > limit)]

        return measure

    return appended(docs, text, RESULT, begin, keep, limit=16 << 20)
