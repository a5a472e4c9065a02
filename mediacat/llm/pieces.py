"""Encoding texts to the pieces of a SentencePiece model and back.

A text is cut into marked words: a run of blanks and what follows up to the next run.
No piece goes beyond one, so each distinct word of a slice is encoded once. The words are
sorted, which walks their trie depth-first: the forward states of the characters a word
has in common with the one before are kept, and only the rest is computed.

The forward state of a prefix is, for a unigram model, its best score and the last piece of
the best segmentation (Viterbi). A BPE model's scores are merge ranks, and the best sum of
them is not what its library gives. There the state is the last piece that merging leaves:
the one piece whose neighbour before it is the last piece of the shorter prefix, and which
stays apart from that neighbour when the two are merged alone. It depends on the prefix
only, so it is shared in the same way.

Defined cases: null and empty texts have no pieces and decode to an empty text. A text's own
mark (U+2581) decodes to a blank, as in the library. Repeated
rows come out once for each row. Input columns with the name of a result column give way to it.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .rows import appended
from .words import text_bytes

MARK = "▁"
# A piece that is not in the model costs this much more than the rarest one (fixed value of the library).
UNKNOWN_COST = 10.0
# Lengths of the pieces that any three characters may end.
SHORT = (2, 1)
# Bytes of text that share a trie: the larger, the fewer words are encoded again.
SLICE = 12 << 20


@dataclass
class Model:
    """Pieces with scores. ``kind`` is "bpe" or "unigram"."""

    kind: str
    scores: dict[str, float]
    numbers: dict[str, int]
    bytes_at: list[int]  # numbers of the pieces for the 256 bytes; empty without byte pieces
    unknown: int
    surfaces: list[bytes]  # bytes of each number, the mark as a blank
    longest: int = 0
    apart: dict[tuple[str, str], bool] = field(default_factory=dict)
    whole: dict[str, bool] = field(default_factory=dict)
    # Lengths of the pieces of three characters or more by the last three of them, longest first.
    endings: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def merged(self, text: str) -> list[str]:
        """Pieces of a text by merging: the pair of best score first, the leftmost of equals."""
        pieces, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                both = pieces[i] + pieces[after[i]]
                if both in self.scores:
                    heapq.heappush(queue, (-self.scores[both], i, both))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            if not pieces[i] or after[i] >= n or pieces[i] + pieces[after[i]] != both:
                continue
            gone = after[i]
            pieces[i], pieces[gone] = both, ""
            after[i] = after[gone]
            if after[gone] < n:
                before[after[gone]] = i
            offer(before[i])
            offer(i)
        return [p for p in pieces if p]

    def stays(self, left: str, right: str) -> bool:
        """Whether merging leaves two pieces apart from each other."""
        found = self.apart.get((left, right))
        if found is None:
            found = self.apart[left, right] = self.merged(left + right) == [left, right]
        return found

    def made(self, piece: str) -> bool:
        """Whether merging makes a piece out of its characters."""
        found = self.whole.get(piece)
        if found is None:
            found = self.whole[piece] = self.merged(piece) == [piece]
        return found

    def ids(self, piece: str) -> list[int]:
        number = self.numbers.get(piece)
        if number is not None:
            return [number]
        return [self.bytes_at[b] for b in piece.encode()] if self.bytes_at else [self.unknown]


def load(path: str, kind: str = "bpe") -> Model:
    """A model file. Its texts must be taken as they are, with one blank put before them."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=path)
    if held.normalize(" aBéﬁ  \t") != f"{MARK}{MARK}aBéﬁ{MARK}{MARK}\t":
        raise ValueError("only models that do not normalise texts are supported")
    scores, numbers, by_byte, surfaces = {}, {}, {}, []
    for i in range(held.vocab_size()):
        piece = held.id_to_piece(i)
        if held.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
            surfaces.append(bytes([int(piece[3:5], 16)]))
        elif held.is_control(i) or held.is_unknown(i) or held.is_unused(i):
            surfaces.append(b"")
        else:
            scores[piece], numbers[piece] = held.get_score(i), i
            surfaces.append(piece.replace(MARK, " ").encode())
    return model(kind, scores, numbers, [by_byte[b] for b in range(256)] if by_byte else [], held.unk_id(), surfaces)


def model(kind, scores, numbers, bytes_at, unknown, surfaces) -> Model:
    for piece in scores:
        if MARK in piece.lstrip(MARK) or piece.startswith(MARK * 2) and piece.strip(MARK):
            raise ValueError(f"piece {piece!r} goes beyond a word")
    sizes: dict[str, set[int]] = {}
    for piece in scores:
        if len(piece) > 2:
            sizes.setdefault(piece[-3:], set()).add(len(piece))
    endings = {end: (*sorted(some, reverse=True), 2, 1) for end, some in sizes.items()}
    return Model(kind, scores, numbers, bytes_at, unknown, surfaces, max(map(len, scores), default=1), endings=endings)


def forward(model: Model, words: list[str]) -> list[list[str]]:
    """Pieces of each word; ``words`` in sorted order. States of common prefixes are used again."""
    # State i: the last piece of the first i characters, and the score up to there.
    last: list[str] = [""]
    score: list[float] = [0.0]
    out, previous = [], ""
    worst = min(model.scores.values(), default=0.0) - UNKNOWN_COST
    for word in words:
        same = 0
        for a, b in zip(word, previous):
            if a != b:
                break
            same += 1
        del last[same + 1 :], score[same + 1 :]
        for end in range(same + 1, len(word) + 1):
            if model.kind == "bpe":
                last.append(last_merged(model, word, end, last))
                score.append(0.0)
            else:
                piece, value = best_scored(model, word, end, score, worst)
                last.append(piece)
                score.append(value)
        pieces, at = [], len(word)
        while at:
            pieces.append(last[at])
            at -= len(last[at])
        out.append(pieces[::-1])
        previous = word
    return out


def last_merged(model: Model, word: str, end: int, last: list[str]) -> str:
    scores, whole, apart = model.scores, model.whole, model.apart
    for size in model.endings.get(word[end - 3 : end], SHORT) if end > 2 else SHORT:
        if size > end:
            continue
        piece = word[end - size : end]
        if piece in scores and (whole.get(piece) or model.made(piece)):
            left = last[end - size]
            if not left or apart.get((left, piece)) or left not in scores or model.stays(left, piece):
                return piece
    return word[end - 1]  # in no piece: its bytes


def best_scored(model: Model, word: str, end: int, score: list[float], worst: float) -> tuple[str, float]:
    best = word[end - 1], score[end - 1] + worst
    for size in range(min(model.longest, end), 0, -1):
        piece = word[end - size : end]
        if piece in model.scores and score[end - size] + model.scores[piece] > best[1]:
            best = piece, score[end - size] + model.scores[piece]
    return best


def marked_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All marked words of the texts, and the first of each text and the end; control bytes stand alone."""
    data, bounds = text_bytes(texts)
    some = np.diff(bounds) > 0
    # One blank before each text that is not empty.
    data = np.insert(data, bounds[:-1][some], 32)
    bounds = bounds + np.concatenate([[0], np.cumsum(some)])
    blank, control = data == 32, data < 32
    start = np.zeros(len(data), bool)
    start[1:] = (blank[1:] & ~blank[:-1]) | control[1:] | control[:-1]
    start[bounds[:-1][some]] = True
    at = np.flatnonzero(start)
    array = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)])
    return array.dictionary_encode(), np.searchsorted(at, bounds)


def encode_words(model: Model, words: list[bytes]) -> list[list[int]]:
    """Numbers of the pieces of each marked word."""
    texts = [w.decode().replace(" ", MARK) for w in words]
    runs = [len(t) - len(t.lstrip(MARK)) for t in texts]
    # Blanks before the last of a run take no part in the word: pieces of several marks hold nothing else.
    order = sorted(range(len(texts)), key=lambda i: texts[i][max(runs[i] - 1, 0) :])
    pieces = forward(model, [texts[i][max(runs[i] - 1, 0) :] for i in order])
    out: list[list[int]] = [[]] * len(words)
    for i, found in zip(order, pieces):
        if runs[i] > 1:
            tail = found if found[0] != MARK else found[1:]
            blanks = MARK * (runs[i] if found[0] == MARK else runs[i] - 1)
            found = (model.merged(blanks) if model.kind == "bpe" else forward(model, [blanks])[0]) + tail
        out[i] = [n for p in found for n in model.ids(p)]
    return out


def encode_texts(model: Model, texts: pa.Array) -> pa.ListArray:
    """Numbers of the pieces of each text."""
    words, bounds = marked_words(texts)
    by_word = pa.array(encode_words(model, words.dictionary.to_pylist()), pa.list_(pa.int32()))
    taken = by_word.take(words.indices)
    at = np.asarray(taken.offsets) - taken.offsets[0].as_py()
    return pa.ListArray.from_arrays(pa.array(at[bounds].astype(np.int32)), taken.flatten())


def decode_texts(model: Model, ids: pa.ListArray) -> pa.Array:
    """The text of each list of numbers."""
    surface = pa.array(model.surfaces, pa.binary())
    taken = surface.take(ids.flatten())
    data, at = text_bytes(taken)
    counts = np.diff(np.asarray(ids.offsets))
    bounds = at[np.concatenate([[0], np.cumsum(counts)])]
    # The blank that was put before a text goes again.
    gone = bounds[:-1][(np.diff(bounds) > 0) & (data[np.minimum(bounds[:-1], max(len(data) - 1, 0))] == 32)] if len(data) else np.zeros(0, int)
    short = np.zeros(len(bounds), np.int64)
    short[np.searchsorted(bounds, gone, side="right")] = 1
    data, bounds = np.delete(data, gone), bounds - np.cumsum(short)
    return pa.Array.from_buffers(pa.string(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, kind: str = "bpe",
           slice_bytes: int = SLICE) -> DataFrame:
    """Rows of ``docs`` with ``n_pieces`` and ``piece_ids``; ``slice_bytes`` of text share a trie."""

    def begin():
        held = load(path, kind)

        def measure(texts: pa.Array) -> list[pa.Array]:
            ids = encode_texts(held, texts)
            return [pa.array(np.diff(np.asarray(ids.offsets)).astype(np.int64)), ids]

        return measure

    return appended(docs, text, "n_pieces long, piece_ids array<int>", begin, keep, slice_bytes)


def decode(rows: DataFrame, path: str, ids: str = "piece_ids", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows with ``text`` made from the numbers in ``ids``; a null list gives an empty text."""
    names = [c for c in (rows.columns if keep is None else keep) if c != text]

    def run(batches):
        held = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(len(names))
                lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32())) if lists.null_count else lists
                lists = pa.ListArray.from_arrays(pa.array(np.asarray(lists.offsets) - lists.offsets[0].as_py(), pa.int32()), lists.flatten())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], decode_texts(held, lists)], [*names, text])

    chosen = rows.select(*[f"`{c}`" for c in names], rows[ids].cast("array<int>").alias("__ids"))
    schema = rows.select(*[f"`{c}`" for c in names]).schema.add(text, "string")
    return chosen.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, kind: str = "bpe") -> DataFrame:
    """Rows of ``docs`` with ``n_pieces``, ``ids_sha256`` (of the numbers as little-endian 32-bit ones) and ``restored``:
    whether decoding gives the text again."""

    def begin():
        held = load(path, kind)

        def measure(texts: pa.Array) -> list[pa.Array]:
            ids = encode_texts(held, texts)
            at, flat = np.asarray(ids.offsets), ids.flatten().to_numpy().astype("<i4")
            digests = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            same = pc.equal(decode_texts(held, ids), texts.fill_null(""))
            return [pa.array(np.diff(at).astype(np.int64)), pa.array(digests, pa.string()), same]

        return measure

    return appended(docs, text, "n_pieces long, ids_sha256 string, restored boolean", begin, keep, SLICE)
