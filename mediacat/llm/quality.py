"""Quality rules: counts of a text, and its n-grams' likelihood in trusted text against the corpus.

Words and pairs of adjacent words are hashed to buckets. Two multinomials are counted over
the buckets: one from trusted documents, one from every document. The score of a text is
the mean over its n-grams of log p(trusted) - log p(corpus); a document is kept if it
passes the base rules and its score is at least ``least``.

The trusted sample is the only bounded one: of the labelled rows with quality 1 and
toxic 0, the ``trusted`` documents of smallest hash. The corpus counts take every row. What
reaches the driver is a row for each bucket.

Defined cases: a text that is null, empty or white space has no words and fails the base
rules. A label that is null or names no document counts for nothing; a document with several
labels is trusted if one of them says so. Repeated rows are counted and returned as often
as they occur. With no trusted document all scores are 0. Columns of the input that have
the name of a result column give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import appended
from .words import Words, mix, split_words, sums, text_bytes, text_slices

BUCKETS = 1 << 15
TRUSTED = 20_000
LEAST = -0.09
PRIOR = 5.0  # added to the trusted count of a bucket and to the one its share of the corpus lets expect

# Fixed values.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
          " base_failed boolean, score double, kept boolean")


def numbered(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 on for the values of an array, equal for equal ones."""
    return pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def repeated_words(words: Words) -> np.ndarray:
    """For each text, its words in 3-word windows that it has twice or more."""
    marked = np.zeros(words.n, bool)
    if words.n >= 3:
        codes = words.codes.astype(np.int64)
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        first = np.flatnonzero(owner[2:] == owner[:-2])
        if len(first):
            size = codes.max() + 1
            pair = numbered(codes[first] * size + codes[first + 1])
            triple = numbered(pair * size + codes[first + 2])
            window = numbered(triple * len(words.counts) + owner[first])
            again = first[np.bincount(window)[window] > 1]
            for k in range(3):
                marked[again + k] = True
    return sums(marked, words.texts)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """For each text, its lines with a word that are equal to an earlier one."""
    data, bounds = text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    # A text has a line more than line breaks; a line starts after each break and with each text.
    starts = np.sort(np.concatenate([breaks + 1, bounds[:-1]]))
    at = starts - np.searchsorted(breaks, starts)
    kept = data[data != 10]
    at = np.append(at, len(kept)).astype(np.int32)
    lines = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(kept)])
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    worded = sums(~blank[kept], at.astype(np.int64)) > 0
    per_text = np.diff(np.concatenate([[0], np.cumsum(1 + sums(data == 10, bounds))]))
    owner = np.repeat(np.arange(len(per_text)), per_text)[worded]
    distinct = np.unique(codes[worded] * len(per_text) + owner) % max(len(per_text), 1)
    size = len(per_text)
    return np.bincount(owner, minlength=size) - np.bincount(distinct, minlength=size)


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and of every pair of adjacent words of the whole slice."""
    if not words.n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words.vocabulary), np.uint64)[words.codes]
    mask = np.uint64(BUCKETS - 1)
    single = (mix(hashed) & mask).astype(np.int64)
    pairs = (mix(hashed[:-1] * np.uint64(3) + hashed[1:]) & mask).astype(np.int64)
    return single, pairs


def inner_pairs(words: Words) -> np.ndarray:
    """Flags of the adjacent pairs that lie within one text."""
    inside = np.ones(max(words.n - 1, 0), bool)
    last = words.texts[1:-1] - 1
    inside[last[(last >= 0) & (last < len(inside))]] = False
    return inside


def gram_counts(docs: DataFrame, text: str, trusted: str) -> DataFrame:
    """(bucket, corpus, trusted): n-grams of all rows, and of the rows with the flag ``trusted``."""

    def run(batches):
        corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for rows in text_slices(batch):
                words = split_words(rows.column(0), lower=False)
                single, pairs = grams(words)
                flag = np.repeat(np.asarray(rows.column(1).to_numpy(zero_copy_only=False), bool), words.counts)
                inside = inner_pairs(words)
                corpus += np.bincount(single, minlength=BUCKETS) + np.bincount(pairs[inside], minlength=BUCKETS)
                inside &= flag[:-1] if len(flag) else False
                target += np.bincount(single[flag], minlength=BUCKETS) + np.bincount(pairs[inside], minlength=BUCKETS)
        some = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(corpus[some]), pa.array(target[some])], ["bucket", "corpus", "trusted"])

    rows = docs.select(F.col(text).alias("text"), F.col(trusted).alias("trusted"))
    counted = rows.mapInArrow(run, "bucket long, corpus long, trusted long")
    return counted.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))


def ratios(counts: DataFrame) -> np.ndarray:
    """log p(trusted) - log p(corpus) for each bucket, drawn to 0 where few trusted n-grams are expected."""
    corpus, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, t in counts.collect():  # a row for each bucket at most
        corpus[bucket], trusted[bucket] = n, t
    if not trusted.sum():
        return np.zeros(BUCKETS)
    expected = corpus * (trusted.sum() / corpus.sum())
    return np.log((trusted + PRIOR) / (expected + PRIOR))


def trusted_documents(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    return good.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def apply_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                keep: list[str] | None = None, least: float = LEAST, bound: int = TRUSTED) -> DataFrame:
    """Rows of ``docs`` with the columns of ``RESULT``; ``keep`` names the input columns that stay."""
    good = trusted_documents(labels, bound).select(F.col("doc_id").alias("id"), F.lit(True).alias("trusted"))
    flagged = (docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
               .join(F.broadcast(good), "id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")))
    model = docs.sparkSession.sparkContext.broadcast(ratios(gram_counts(flagged, "text", "trusted")))

    def begin():
        ratio = model.value

        def measure(texts: pa.Array) -> list[pa.Array]:
            words = split_words(texts, lower=False)
            n, byte_bounds = words.counts, words.at[words.texts]
            repeated = repeated_words(words)
            single, pairs = grams(words)
            total = np.zeros(words.n)
            total += ratio[single]
            if words.n > 1:
                total[:-1] += np.where(inner_pairs(words), ratio[pairs], 0.0)
            cumulated = np.concatenate([[0.0], np.cumsum(total)])
            score = (cumulated[words.texts[1:]] - cumulated[words.texts[:-1]]) / np.maximum(2 * n - 1, 1)
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)
            return [
                pa.array(n.astype(np.int64)), pa.array(sums((words.data & 0xC0) != 0x80, byte_bounds)),
                pa.array(sums(SYMBOLS[words.data], byte_bounds)), pa.array(repeated_lines(texts).astype(np.int64)),
                pa.array(repeated), pa.array(failed), pa.array(score), pa.array(~failed & (score >= least)),
            ]

        return measure

    return appended(docs, text, RESULT, begin, keep)
