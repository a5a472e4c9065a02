"""Scoring texts with a small causal self-attention model over subword ids, trained with numpy.

Words are cut to the pieces of a SentencePiece model. The probability of a piece is that of
its class given the pieces before it, which the attention model gives, times its share of
the class, which is counted over all training texts. The most frequent pieces are classes of
their own. How words are spelled is counted too: inside a word the probability is mixed with that of the training words
with the same pieces so far, and a word's first piece, half with that of all first pieces. All beginnings of training words count: words stand in the order of
their pieces, so those that begin alike stand together, and only beginnings that go over the edge of a chunk of words are put together by the driver.
A text is scored in overlapping windows: each window after the first has
``WINDOW - STRIDE`` positions that were scored before and are context only, so every token is scored once.

The attention model starts as the unigram model of the classes. It is trained on the windows of all
training documents, whose blocks are dealt out to ``ROUNDS`` rounds by a hash, each block to one: in a round each task
trains a copy on its windows, and the copies are averaged by a grouped aggregation. Only averaged weights, whose number is fixed, reach the driver.

The base score is that of a unigram model of whole words. Documents are kept as blocks with
a vocabulary each; the words of the vocabularies, not all tokens, are counted and joined
with the corpus counts. A block and the counts of its words meet in one sort and are read in a stream, a block at a time.

Defined cases: a null text is empty and has only its end. Repeated rows are learned from and
returned as often as they occur. A null id has no checksum: the row is for training. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .words import mix, split_words, text_slices

WINDOW, STRIDE = 32, 24
WIDTH = 16
CLASSES, OWN_CLASS = 128, 112
BUCKETS, OWN_BUCKET = 2048, 1536
ROUNDS = 3
BATCH = 64
RATE = 0.02
BLOCK_BYTES = 4 << 20
BOS, EOS = 1, 2
CHUNK, DEPTH = 1 << 18, 16
# Blocks are long rows: without these, the writer and readers hold a hundred of them and more at once.
FILES = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4,
         "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}
TRUST, CONTEXT = 0.95, 0.5
AHEAD = np.where(np.tril(np.ones((WINDOW, WINDOW))) > 0, 0, -np.inf).astype(np.float32)  # a position sees itself and those before


def is_held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


# ---- blocks of documents ----


def planes(codes: np.ndarray) -> bytes:
    """Numbers as all their first bytes, then all their second ones, and so on: the higher ones compress well."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(held: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def packed(*columns: pa.Array) -> bytes:
    """Columns as one value: lists in a stream of rows that mostly have none are dear."""
    with pa.BufferOutputStream() as out:
        batch = pa.RecordBatch.from_arrays(list(columns), [str(k) for k in range(len(columns))])
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        return out.getvalue().to_pybytes()


def unpacked(held: bytes) -> list[pa.Array]:
    with pa.ipc.open_stream(held) as reader:
        return reader.read_next_batch().columns


def blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents in blocks: word numbers, the words they stand for and how often training texts of the block have them."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                words = split_words(rows.column(2))
                held = np.asarray(rows.column(1).to_numpy(zero_copy_only=False), bool)
                train = ~np.repeat(held, words.counts)
                codes = words.codes.astype(np.int32) if words.n else np.zeros(0, np.int32)
                vocabulary = words.vocabulary if words.n else []
                seen = np.bincount(codes[train], minlength=len(vocabulary))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([vocabulary], pa.list_(pa.binary())), pa.array([seen.astype(np.int64)], pa.list_(pa.int64())),
                    pa.array([packed(rows.column(0), rows.column(1), pa.array(words.texts.astype(np.int64)[1:]))], pa.binary()),
                    pa.array([rows.column(1)], pa.list_(pa.bool_())),
                    pa.array([words.texts.astype(np.int64)], pa.list_(pa.int64())), pa.array([planes(codes)], pa.binary()),
                ], ["block", "words", "seen", "head", "held", "texts", "codes"])
                number += 1

    schema = "block long, words array<binary>, seen array<long>, head binary, held array<boolean>, texts array<long>, codes binary"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), is_held_out(doc_id).alias("held"), F.col(text).alias("text"))
    return written(rows.mapInArrow(run, schema), **FILES)


def word_counts(held: DataFrame) -> DataFrame:
    """(word, n): training tokens of each word, 0 of one that only held-out texts have."""
    each = held.select(F.explode(F.arrays_zip("words", "seen")).alias("w")).select("w.words", "w.seen")
    return each.groupBy(F.col("words").alias("word")).agg(F.sum("seen").alias("n"))


# ---- the vocabulary of pieces ----


def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_kind(size: int) -> str:
    """Numbers for the pieces of a model; their bytes have the order of the pieces."""
    return ">u2" if size <= 1 << 16 else ">i4"


def times_kind(total: int) -> str:
    return "<i4" if total < 1 << 31 else "<i8"


def as_bytes(values: np.ndarray, offsets: np.ndarray, kind: str) -> pa.Array:
    """Lists of numbers as bytes."""
    held = values.astype(kind)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * held.itemsize).astype(np.int32)), pa.py_buffer(held.tobytes())])


def as_lists(held: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that bytes hold, all in a row, and where those of each row begin, and the end."""
    _, offsets, data = held.buffers()
    at = np.frombuffer(offsets, np.int32)[held.offset : held.offset + len(held) + 1].astype(np.int64) if len(held) else np.zeros(1, np.int64)
    size = np.dtype(kind).itemsize
    some = np.frombuffer(data, np.uint8)[at[0] : at[-1]].tobytes() if data is not None else b""
    return np.frombuffer(some, kind).astype(np.int64), (at - at[0]) // size


def cut_words(counts: DataFrame, path: str) -> DataFrame:
    """(word, n, pieces): each word is cut once."""

    def run(batches):
        machine = processor(path)
        for batch in batches:
            cut = word_pieces(machine, batch.column(0).to_pylist())
            pieces = as_bytes(cut.values.to_numpy(zero_copy_only=False), np.asarray(cut.offsets), piece_kind(machine.vocab_size()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pieces], ["word", "n", "pieces"])

    return counts.mapInArrow(run, "word binary, n long, pieces binary")


def piece_counts(words: DataFrame, size: int) -> DataFrame:
    """(piece, n): pieces of all training words."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids, offsets = as_lists(batch.column(1), piece_kind(size))
            np.add.at(total, ids, np.repeat(batch.column(0).to_numpy(), np.diff(offsets)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

    return words.select("n", "pieces").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Class, share of its class (log) and input bucket of each piece."""

    def __init__(self, counts: np.ndarray, begins: np.ndarray | None = None):
        """``begins`` are the pieces that begin a word or end a text; no class has them together with others, but for their own."""
        begins = np.zeros(len(counts), bool) if begins is None else begins
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        smooth = counts + 0.5
        self.classes = np.where(rank < OWN_CLASS, rank, 0)
        tail = np.argsort(rank)[OWN_CLASS:]
        groups = [g for g in (tail[begins[tail]], tail[~begins[tail]]) if len(g)]
        first, bins = OWN_CLASS, (CLASSES - OWN_CLASS) // max(len(groups), 1)
        for group in groups:
            mass = np.cumsum(smooth[group])
            self.classes[group] = first + np.minimum((mass / mass[-1] * bins).astype(np.int64), bins - 1)
            first += bins
        self.begins, self.beginning = begins, np.bincount(self.classes[begins], minlength=CLASSES) > 0
        first_counts = np.where(begins, counts, 0.0)
        self.firsts = first_counts / max(first_counts.sum(), 1.0)
        total = np.bincount(self.classes, weights=smooth, minlength=CLASSES)
        self.share = np.log(smooth / total[self.classes]).astype(np.float32)
        self.start = np.log(np.maximum(total, 0.5) / total.sum()).astype(np.float32)
        ids = np.arange(len(counts))
        self.bucket = np.where(rank < OWN_BUCKET, rank, OWN_BUCKET + ids * 2654435761 % (BUCKETS - OWN_BUCKET))


# ---- the model ----

SHAPES = {"embed": (BUCKETS, WIDTH), "place": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH),
          "o": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,)}


def first_weights(start: np.ndarray) -> dict[str, np.ndarray]:
    chance = np.random.default_rng(7)
    weights = {name: (chance.standard_normal(shape) * 0.2).astype(np.float32) for name, shape in SHAPES.items()}
    weights["place"] *= 0.5
    weights["out"] *= 0.05
    weights["bias"] = start.copy()
    return weights


def attend(w: dict[str, np.ndarray], inputs: np.ndarray):
    """States of a batch of windows of input buckets, and what the gradient needs."""
    x = w["embed"][inputs] + w["place"]
    q, k, v = x @ (w["q"] / np.float32(WIDTH**0.5)), x @ w["k"], x @ w["v"]
    weight = q @ k.transpose(0, 2, 1)
    weight += AHEAD
    weight -= weight.max(axis=2, keepdims=True)
    np.exp(weight, out=weight)
    weight /= weight.sum(axis=2, keepdims=True)
    mixed = weight @ v
    return x + mixed @ w["o"], (x, q, k, v, weight, mixed)


def class_logs(w: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each target class, and the probabilities of all."""
    logits = states.reshape(-1, WIDTH) @ w["out"]
    logits += w["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    at = targets.ravel()
    own = logits[np.arange(len(at)), at].copy()
    np.exp(logits, out=logits)
    total = logits.sum(axis=1)
    return (own - np.log(total)).reshape(targets.shape), logits / total[:, None]


def gradient(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean loss over the real positions."""
    states, (x, q, k, v, weight, mixed) = attend(w, inputs)
    _, p = class_logs(w, states, targets)
    p[np.arange(len(p)), targets.ravel()] -= 1
    p *= (real.ravel() / max(real.sum(), 1))[:, None].astype(np.float32)
    flat = states.reshape(-1, WIDTH)
    g = {"out": flat.T @ p, "bias": p.sum(axis=0)}
    d_state = (p @ w["out"].T).reshape(states.shape)
    g["o"] = mixed.reshape(-1, WIDTH).T @ d_state.reshape(-1, WIDTH)
    d_mixed = d_state @ w["o"].T
    d_weight = d_mixed @ v.transpose(0, 2, 1)
    d_v = weight.transpose(0, 2, 1) @ d_mixed
    d_score = weight * (d_weight - (d_weight * weight).sum(axis=2, keepdims=True))
    d_q, d_k = d_score @ k, d_score.transpose(0, 2, 1) @ q
    scale = np.float32(WIDTH**0.5)
    rows = x.reshape(-1, WIDTH)
    g["q"], g["k"], g["v"] = rows.T @ d_q.reshape(-1, WIDTH) / scale, rows.T @ d_k.reshape(-1, WIDTH), rows.T @ d_v.reshape(-1, WIDTH)
    d_x = d_state + d_q @ w["q"].T / scale + d_k @ w["k"].T + d_v @ w["v"].T
    g["place"] = d_x.sum(axis=0)
    g["embed"] = np.zeros_like(w["embed"])
    order = np.argsort(inputs, axis=None, kind="stable")
    sorted_inputs = inputs.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_inputs[1:] != sorted_inputs[:-1]]))
    g["embed"][sorted_inputs[first]] = np.add.reduceat(d_x.reshape(-1, WIDTH)[order], first, axis=0)
    return g


def train_copy(w: dict[str, np.ndarray], windows, rate: float = RATE) -> int:
    """Adam steps over batches of (inputs, targets, real); gives the number of real positions."""
    moment = {k: np.zeros_like(x) for k, x in w.items()}
    square = {k: np.zeros_like(x) for k, x in w.items()}
    total = 0
    for step, (inputs, targets, real) in enumerate(windows, 1):
        for name, g in gradient(w, inputs, targets, real).items():
            moment[name] = 0.9 * moment[name] + 0.1 * g
            square[name] = 0.98 * square[name] + 0.02 * g * g
            w[name] -= (rate * (moment[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.98**step)) + 1e-7)).astype(np.float32)
        total += int(real.sum())
    return total


# ---- texts to windows ----


def word_pieces(machine, vocabulary: list[bytes]) -> pa.ListArray:
    return pa.array(machine.encode([w.decode() for w in vocabulary], num_threads=1), pa.list_(pa.int32()))


def token_rows(by_word: pa.ListArray, codes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts in a row, each text's end after it, and the first of each text and the end."""
    taken = by_word.take(pa.array(codes))
    at = np.asarray(taken.offsets)
    bounds = (at[texts] - at[0]).astype(np.int64)
    ids = taken.flatten().to_numpy(zero_copy_only=False)
    return np.insert(ids, bounds[1:], EOS), bounds + np.arange(len(bounds))


def windows(bounds: np.ndarray, size: int, chance: np.random.Generator | None = None):
    """Batches of at most ``size`` windows, in random order if ``chance`` is given: (text, places of the tokens, which of them to score)."""
    total = np.diff(bounds)
    count = 1 + np.maximum(0, -(-(total - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(total)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    if chance is not None:
        order = chance.permutation(len(owner))
        owner, nth = owner[order], nth[order]
    offset = np.arange(WINDOW)
    for a in range(0, len(owner), size):
        own, k = owner[a : a + size], nth[a : a + size]
        at = (bounds[own] + k * STRIDE)[:, None] + offset
        end = bounds[own + 1][:, None]
        real = (at < end) & ((k == 0)[:, None] | (offset >= WINDOW - STRIDE))
        yield own, np.minimum(at, end - 1), real


def before_each(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each one, BOS before the first of a text."""
    previous = np.concatenate([[BOS], ids[:-1]])
    previous[bounds[:-1][bounds[:-1] < len(ids)]] = BOS
    return previous


def training_windows(batches, path: str, vocabulary: Vocabulary):
    """Batches of (inputs, targets, real): every window of the training documents of some blocks, in random order in a block."""
    machine = processor(path)
    for batch in batches:
        for i in range(batch.num_rows):
            block, words, held, texts, codes = (batch.column(k)[i] for k in range(5))
            ids, bounds = token_rows(word_pieces(machine, words.values.to_pylist()), from_planes(codes.as_py()), np.asarray(texts.values))
            train, size = ~np.asarray(held.values.to_numpy(zero_copy_only=False), bool), np.diff(bounds)
            ids, bounds = ids[np.repeat(train, size)], np.concatenate([[0], np.cumsum(size[train])])
            if len(ids):
                previous = before_each(ids, bounds)
                for _, at, real in windows(bounds, BATCH, np.random.default_rng(block.as_py())):
                    yield vocabulary.bucket[previous[at]], vocabulary.classes[ids[at]], real


def trained(held_blocks: DataFrame, path: str, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    spark = held_blocks.sparkSession
    weights = first_weights(vocabulary.start)
    for turn in range(ROUNDS):
        held = spark.sparkContext.broadcast((weights, vocabulary))
        share = held_blocks.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == turn).select("block", "words", "held", "texts", "codes")

        def run(batches, held=held):
            start, known = held.value
            w = {k: x.copy() for k, x in start.items()}
            n = train_copy(w, training_windows(batches, path, known))
            if n:
                flat = np.concatenate([w[k].ravel() for k in SHAPES]).astype(float) * n
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), n))], ["at", "value", "n"])

        rows = share.mapInArrow(run, "at long, value double, n long").groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value"))
        found = rows.toPandas().sort_values("at")  # a row for each weight, of a fixed number
        if not len(found):
            continue
        flat, at = found["value"].to_numpy(np.float32), 0
        for name, shape in SHAPES.items():
            size = int(np.prod(shape))
            weights[name] = flat[at : at + size].reshape(shape)
            at += size
    return weights


def folded(w: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Weights for scoring: products of neighbouring matrices, and the bias as factors."""
    pairs = w["q"] @ w["k"].T / np.float32(WIDTH**0.5)
    return w["embed"], w["place"], pairs, w["v"] @ w["o"], w["out"], w["bias"], np.exp(w["bias"])


def window_logs(parts: tuple[np.ndarray, ...], inputs: np.ndarray, targets: np.ndarray, beginning: np.ndarray | None = None):
    """Log probability of the target classes, as ``attend`` and ``class_logs`` have it, in fewer steps; with
    ``beginning``, also that of all those classes."""
    embed, place, pairs, values, out, bias, factors = parts
    x = embed[inputs] + place
    weight = (x @ pairs) @ x.transpose(0, 2, 1)
    weight += AHEAD
    weight -= weight.max(axis=2, keepdims=True)
    np.exp(weight, out=weight)
    mixed = weight @ np.concatenate([x @ values, np.ones((*x.shape[:2], 1), np.float32)], axis=2)
    states = (x + mixed[:, :, :-1] / mixed[:, :, -1:]).reshape(-1, WIDTH)
    logits, at = states @ out, targets.ravel()
    high = (logits + bias).max(axis=1) if logits.size and np.abs(logits).max() > 60 else None
    if high is not None:
        logits += bias - high[:, None]
        own = logits[np.arange(len(at)), at]
        factors = np.ones_like(factors)
    else:
        own = logits[np.arange(len(at)), at] + bias[at]
    held = np.exp(logits, out=logits) @ np.stack([factors, factors * (0 if beginning is None else beginning)], axis=1)
    logs = (own - np.log(held[:, 0])).reshape(targets.shape)
    return logs if beginning is None else (logs, (held[:, 1] / held[:, 0]).reshape(targets.shape))


def text_scores(weights, vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray, spelling: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """Log10 probability of each text. ``spelling`` has, of each token, whether it begins a word or ends the text, the share of
    the training words with the same pieces before it that go on so (of a first one: that ended), and how far to trust that."""
    parts = folded(weights)
    inputs, targets = vocabulary.bucket[before_each(ids, bounds)].astype(np.int32), vocabulary.classes[ids].astype(np.int32)
    logs, begin = np.zeros(len(ids)), np.zeros(len(ids))
    for _, at, real in windows(bounds, 256):
        found, share = window_logs(parts, inputs[at], targets[at], vocabulary.beginning.astype(np.float32))
        logs[at[real]], begin[at[real]] = found[real], share[real]
    logs += vocabulary.share[ids]
    if spelling is not None:
        first, so, trust = spelling
        first = first & vocabulary.begins[ids]
        # The attention model's part of what begins words is shared out by itself and by the count of first pieces.
        own, begin = np.exp(logs), np.maximum(begin, 1e-30)
        next_word = (trust * so + (1 - trust) * begin) * ((1 - CONTEXT) * vocabulary.firsts[ids] + CONTEXT * np.minimum(own / begin, 1.0))
        inside = np.where(first, 0.0, trust * so)
        logs = np.where(first, np.log(np.maximum(next_word, 1e-300)), np.logaddexp(np.log(np.maximum(inside, 1e-300)), logs + np.log1p(-trust)))
    return np.add.reduceat(logs, bounds[:-1]) / np.log(10) if len(ids) else np.zeros(0)


# ---- how words are spelled ----


def prefix_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of the pieces of a word up to each one; 0 from the piece ``DEPTH`` on."""
    size, keys = np.diff(offsets), np.zeros(len(ids), np.uint64)
    held = np.zeros(len(size), np.uint64)
    for k in range(min(DEPTH, int(size.max(initial=0)))):
        some = np.flatnonzero(size > k)
        held[some] = mix(held[some] * np.uint64(0x9E3779B97F4A7C15) + ids[offsets[some] + k].astype(np.uint64) + np.uint64(1))
        keys[offsets[some] + k] = held[some]
    return keys


def end_keys(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ np.uint64(0xD6E8FEB86659FD93))


def spelled(words: DataFrame, size: int, total_words: int) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """(word, n, pieces, times): how many training words begin with a word's first piece, first two and so on, and how many
    are it, in chunks of words in the order of their pieces; and the beginnings that several chunks have, by their hash,
    sorted, and how often each occurs. ``size`` is the number of pieces of the model.

    Words that begin alike stand together, so a chunk shares no beginnings with others but those of its first and its last word.
    """

    pieces_as, times_as = piece_kind(size), times_kind(total_words)

    def counted(held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        n = rows.column(1).to_numpy()
        ids, offsets = as_lists(rows.column(2), pieces_as)
        long, keys = np.diff(offsets), prefix_keys(ids, offsets)
        whole = np.flatnonzero((long > 0) & (long <= DEPTH))
        ends = np.zeros(len(long), np.uint64)
        ends[whole] = end_keys(keys[offsets[1:][whole] - 1])
        # The keys of a word one after another, its end last.
        at = offsets + np.arange(len(offsets))
        all_keys = np.zeros(at[-1], np.uint64)
        last = at[1:] - 1
        inside = np.ones(len(all_keys), bool)
        inside[last] = False
        all_keys[inside], all_keys[last] = keys, ends
        some, code = np.unique(all_keys, return_inverse=True)
        total = np.zeros(len(some), np.int64)
        np.add.at(total, code, np.repeat(n, long + 1))
        total[some == 0] = 0
        edge = np.unique(np.concatenate([all_keys[at[k] : at[k + 1]] for k in (0, len(long) - 1)]))
        edge = edge[edge > 0]
        edges = [list(zip(edge.view(np.int64).tolist(), total[np.searchsorted(some, edge)].tolist()))] + [None] * (len(long) - 1)
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, as_bytes(total[code], at, times_as), pa.array([e and [{"key": k, "n": m} for k, m in e] for e in edges], pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())])))],
            ["word", "n", "pieces", "times", "edges"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield from counted(held)
                held, n = [], 0
        if held:
            yield from counted(held)

    ordered = words.repartitionByRange("pieces").sortWithinPartitions("pieces")
    rows = written(ordered.mapInArrow(run, "word binary, n long, pieces binary, times binary, edges array<struct<key: long, n: long>>"))
    over = rows.where("edges is not null").select(F.inline("edges")).groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("m")).where("m > 1")
    found = over.select("key", "n").toPandas()  # some for each chunk
    keys = found["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return rows.drop("edges"), (keys[order], found["n"].to_numpy(np.int64)[order])


def times(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How often each key occurs: as the table has it, or else ``own``."""
    known, n = table
    if not len(known):
        return own
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, n[at], own)


def spelling_of(by_word: pa.ListArray, codes: np.ndarray, texts: np.ndarray, own: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """What :func:`text_scores` takes, for the tokens of :func:`token_rows`; counted once for each word of the vocabulary.
    ``own`` and ``table`` are what :func:`spelled` gives, the times of all words in a row."""
    offsets = np.asarray(by_word.offsets)
    keys = prefix_keys(by_word.values.to_numpy(zero_copy_only=False), offsets)
    size = np.diff(offsets)
    stop = np.zeros(len(own), bool)
    stop[np.cumsum(size + 1) - 1] = True
    n, ended_words = times(table, keys, own[~stop]), own[stop]
    ends, whole = np.zeros(len(keys), np.int64), np.flatnonzero(size > 0)
    last = offsets[1:][whole] - 1
    ends[last] = times(table, end_keys(keys[last]), ended_words[whole])
    first = np.zeros(len(keys), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    trust = TRUST * n / (n + 1)
    before = np.concatenate([np.zeros(1, n.dtype), n[:-1]])
    so = np.where(first, 0.0, n / np.maximum(before, 1))
    trust_before = np.where(first, 0.0, np.concatenate([[0.0], trust[:-1]]))
    ended = np.concatenate([ends / np.maximum(n, 1), [0.0]])
    trust_end = np.concatenate([trust, [0.0]])
    # Places of the pieces in the vocabulary's list; ends of texts are there as EOS.
    places = pa.ListArray.from_arrays(by_word.offsets, pa.array(np.arange(len(keys))))
    at, bounds = token_rows(places, codes, texts)
    stops = np.zeros(len(at), bool)
    stops[bounds[1:] - 1] = True
    at = np.where(stops, len(keys), at)
    begins = np.append(first, True)[at]
    previous = np.concatenate([[len(keys)], at[:-1]])
    previous[bounds[:-1]] = len(keys)  # nothing ended before a text
    return begins, np.where(begins, ended[previous], np.append(so, 0.0)[at]), np.where(begins, trust_end[previous], np.append(trust_before, 0.0)[at])


# ---- all of it ----


def by_block(batches):
    """Rows sorted by block, as one table for each block."""
    held, last = [], None
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                if held and block[a] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = block[a]
    if held:
        yield pa.Table.from_batches(held)


def score(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    spark, held = docs.sparkSession, blocks(docs, doc_id, text)
    machine = processor(path)
    counts = written(cut_words(word_counts(held), path))
    whole = counts.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = held.select(F.explode("held").alias("h")).where("not h").count()
    tokens, distinct = whole.n + ends, whole.v + (ends > 0)
    pieces = np.zeros(machine.vocab_size())
    for piece, n in piece_counts(counts, len(pieces)).collect():  # a row for each piece of the model at most
        pieces[piece] = n
    pieces[EOS] += ends
    begins = np.array([i == EOS or machine.id_to_piece(i).startswith("\u2581") for i in range(len(pieces))])
    vocabulary = Vocabulary(pieces, begins)
    words, edges = spelled(counts, len(pieces), whole.n)
    model = spark.sparkContext.broadcast((trained(held, path, vocabulary), vocabulary, edges))

    # A block comes before its words, whose counts follow one by one: no row grows with what a block holds beside its texts.
    each = held.select("block", F.posexplode("words").alias("at", "word")).join(words, "word").select("block", "at", "n", "pieces", "times")
    rows = held.select("block", F.lit(-1).alias("at"), "head", "codes").unionByName(each, allowMissingColumns=True)
    placed = rows.repartition("block").sortWithinPartitions("block", "at")
    under = tokens + 0.5 * (distinct + 1)
    pieces_as, times_as = piece_kind(len(pieces)), times_kind(whole.n)

    def run(batches):
        weights, vocab, over = model.value
        for rows in by_block(batches):
            doc_ids, held, texts = unpacked(rows.column("head")[0].as_py())
            texts, codes = np.concatenate([[0], texts.to_numpy()]), from_planes(rows.column("codes")[0].as_py())
            known = rows.slice(1).select(["n", "pieces", "times"]).combine_chunks()
            n, cut, own = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in known.columns)
            n = n.to_numpy()
            logs = np.concatenate([[0.0], np.cumsum(np.log10((n + 0.5) / under)[codes])])
            seen = np.concatenate([[0], np.cumsum((n > 0)[codes])])
            total = np.diff(texts) + 1
            base = logs[texts[1:]] - logs[texts[:-1]] + np.log10((ends + 0.5) / under)
            found = seen[texts[1:]] - seen[texts[:-1]] + (ends > 0)
            by_word = pa.ListArray.from_arrays(*(pa.array(x.astype(np.int32)) for x in as_lists(cut, pieces_as)[::-1]))
            ids, bounds = token_rows(by_word, codes, texts)
            scores = text_scores(weights, vocab, ids, bounds, spelling_of(by_word, codes, texts, as_lists(own, times_as)[0], over))
            yield pa.RecordBatch.from_arrays([
                doc_ids, held, pa.array(total.astype(np.int64)), pa.array(found.astype(np.int64)),
                pa.array(np.full(len(total), tokens, np.int64)), pa.array(base), pa.array(scores),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return placed.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
