"""Token numbers of whole texts, as a tokenizer's own library gives them.

White space ends every word of a tokenizer that :func:`splits_at_space` has tried, so each
distinct word of a slice is encoded once and its numbers are put in place for every
occurrence. Words of Latin letters with punctuation behind them, of a tokenizer that cuts
there too, are looked up by their letters alone. Any other tokenizer gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import NOT_SPACE, split_words, text_bytes

ENCODED_AT_ONCE = 4_096

# Letters that are one character in every normal form, punctuation no alternative below joins
# with a letter, and the pattern of pre-tokenisers that cut between the two.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
TAIL = ".,;:!?"
CUTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def splits_at_space(machine) -> bool:
    """Whether texts with white space between them encode as they do alone."""
    some = ["word", "Été,", "a1", "<|endoftext|>", "...", "don't", "1 x", "é́", "日本"]
    alone = {w: machine.encode(w, add_special_tokens=False).ids for w in some}
    return all(
        machine.encode(f"{a}{space}{b}", add_special_tokens=False).ids == alone[a] + alone[b]
        for a in some for b in some for space in (" ", "\n", "\t ", " \r\n")
    ) and all(machine.encode(s + "word" + s, add_special_tokens=False).ids == alone["word"] for s in (" ", "\n\n"))


def flattened(numbers: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    return np.fromiter(chain.from_iterable(numbers), np.uint32, int(sizes.sum())), sizes


def gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that ``codes`` name, one after another; run i has ``sizes[i]`` numbers."""
    took = sizes[codes]
    ends = np.cumsum(took)
    return flat[np.repeat((np.cumsum(sizes) - sizes)[codes] - ends + took, took) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Numbers of texts; ``path`` is a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.machine = Tokenizer.from_file(path)
        self.by_word = splits_at_space(self.machine)
        self.known: dict[str, list[int]] = {}
        self.shape = None
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        steps = [s.get("type") for s in (parts.get("normalizer") or {}).get("normalizers", [])]
        cuts = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if self.by_word and steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in cuts] == ["Split", "ByteLevel"] \
                and cuts[0]["pattern"] == {"Regex": CUTS} and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed":
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            letters = [c for c in map(chr, range(256)) if re.match(f"[{LETTERS}]", c)]
            self.letters = {ord(c): level.pre_tokenize_str(self.machine.normalizer.normalize_str(c))[0][0] for c in letters}
            self.shape = f"^[{LETTERS}]+$"

    def of_parts(self, parts: list[str], plain: bool) -> list[list[int]]:
        """Numbers of distinct strings; those of plain letters skip the normaliser, which ``letters`` stands for."""
        if plain:
            known, tokens, letters = self.known, self.machine.model.tokenize, self.letters
            if len(known) > 1 << 20:  # bounded memory in a task
                known.clear()
            for part in parts:
                if part not in known:
                    known[part] = [t.id for t in tokens(part.translate(letters))]
            return [known[part] for part in parts]
        out = []
        for at in range(0, len(parts), ENCODED_AT_ONCE):
            out += [x.ids for x in self.machine.encode_batch_fast(parts[at : at + ENCODED_AT_ONCE], add_special_tokens=False)]
        return out

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words in a row, and how many each has."""
        words = words.cast(pa.string())
        if self.shape is None:
            return flattened(self.of_parts(words.to_pylist(), False))
        stems = pc.ascii_rtrim(words, characters=TAIL)
        plain = pc.match_substring_regex(stems, self.shape)
        stems = pc.if_else(plain, stems, words)
        tail = np.asarray(pc.subtract(pc.binary_length(words), pc.binary_length(stems)))
        # Each word is its stem and its tail; the tails are few, and end in the empty one.
        heads, ends = stems.dictionary_encode(), np.full(len(words), -1)
        ends_known: dict[str, int] = {}
        for long in np.unique(tail[tail > 0]).tolist():
            which = np.flatnonzero(tail == long)
            found = pc.utf8_slice_codeunits(words.take(pa.array(which)), start=-long).dictionary_encode()
            number = np.array([ends_known.setdefault(t, len(ends_known)) for t in found.dictionary.to_pylist()])
            ends[which] = number[np.asarray(found.indices)]
        distinct, number = heads.dictionary, np.asarray(heads.indices)
        easy = np.asarray(pc.match_substring_regex(distinct, self.shape))
        numbers: list = [None] * len(distinct)
        for kind in (True, False):
            which = np.flatnonzero(easy == kind)
            for i, ids in zip(which.tolist(), self.of_parts(distinct.take(pa.array(which)).to_pylist(), kind)):
                numbers[i] = ids
        flat, sizes = flattened(numbers + self.of_parts(list(ends_known), False) + [[]])
        ends = np.where(ends < 0, len(ends_known), ends) + len(distinct)
        pairs = np.column_stack([number, ends]).ravel()
        return gathered(flat, sizes, pairs), sizes[number] + sizes[ends]

    def of_texts(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts in a row, ``end`` after each, and where each text begins."""
        if not self.by_word:
            ids = [self.machine.encode(t or "", add_special_tokens=False).ids + end for t in texts.to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            return np.array([i for x in ids for i in x], np.uint32), bounds
        words = split_words(texts, lower=False)
        if not words.n:
            return np.tile(np.array(end, np.uint32), len(texts)), np.arange(len(texts) + 1) * len(end)
        flat, sizes = self.of_words(words.encoded.dictionary)
        flat, sizes = np.append(flat, np.array(end, np.uint32)), np.append(sizes, len(end))
        codes = np.insert(words.codes, words.texts[1:], len(sizes) - 1)
        last = words.texts[1:] + np.arange(len(texts))
        return gathered(flat, sizes, codes), np.concatenate([[0], np.cumsum(sizes[codes])[last]]).astype(np.int64)

    def of_text(self, text: pa.Array, end: list[int], segment: int) -> np.ndarray:
        """Numbers of one very long text, from segments that end in white space."""
        data, _ = text_bytes(text)
        if not self.by_word or len(data) <= segment:
            return self.of_texts(text, end)[0]
        out, at = [], 0
        while at < len(data):
            stop = min(len(data), at + segment)
            while stop < len(data) and NOT_SPACE[data[stop]]:
                stop += 1
            part = pa.array([data[at:stop].tobytes()], pa.binary()).cast(pa.string())
            out.append(self.of_texts(part, [])[0])
            at = stop
        return np.concatenate([*out, np.array(end, np.uint32)])
