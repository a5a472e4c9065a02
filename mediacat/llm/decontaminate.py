"""Benchmark decontamination: a generalised suffix automaton of the test items.

A window is ``size`` consecutive words of an item; an item of fewer words, but not none, is
one window. The words of a document are streamed through the automaton, which holds the
length of the longest run of item words that ends at each word. A word inside an
occurrence of a window is hit.

The items are a stated query set. They are dealt out in blocks of at most ``block_chars``
characters; one block's automaton is held by a task at a time, and the documents pass the
blocks one after another.

Defined cases: null and empty texts have no words. Items without id or words never
occur; repeated items count once. Repeated documents come out once for each row. Without
items nothing is hit. Input columns with the name of a result column give way to it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import appended
from .tables import stored
from .words import ALPHANUMERIC, release, split_words, text_slices

SIZE = 10
BLOCK_CHARS = 8 << 20
# A document goes if a hit span is this long or hit words have this share; shorter spans are cut out.
MAX_SPAN = 13
MAX_COVERAGE = 0.2

RESULT = "n_words long, n_hit long, spans array<struct<first:int,last:int>>, items array<string>"


class Automaton:
    """States of all runs of item words, each with the longest run, its longest other suffix and its steps."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.size, self.words = size, {}
        self.steps, self.suffix, self.longest = [{}], [-1], [0]
        coded = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        n = len(self.steps)
        self.items: list[set[str]] = [set() for _ in range(n)]
        self.short: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for name, codes in coded:
            at = 0
            for i, code in enumerate(codes):
                at = self.steps[at][code]
                if i + 1 >= size:
                    self.items[self.window_state(at)].add(name)
            if len(codes) < size:
                self.short[at].append((len(codes), name))
        pairs = {a * len(self.words) + b for _, codes in coded for a, b in zip(codes, codes[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.least = min([size] + [len(codes) for _, codes in coded])
        self.has_short = self.least < size

    def adjacent(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the words of each pair follow each other in some item."""
        if not len(self.pairs):
            return np.zeros(len(left), bool)
        key = left * len(self.words) + right
        return self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key

    def _new(self, longest: int, steps: dict[int, int], suffix: int) -> int:
        self.longest.append(longest)
        self.steps.append(steps)
        self.suffix.append(suffix)
        return len(self.steps) - 1

    def _split(self, at: int, code: int, to: int) -> int:
        """The state of the run ``at`` + ``code``, apart from longer runs that ``to`` also stands for."""
        if self.longest[to] == self.longest[at] + 1:
            return to
        twin = self._new(self.longest[at] + 1, dict(self.steps[to]), self.suffix[to])
        self.suffix[to] = twin
        while at >= 0 and self.steps[at].get(code) == to:
            self.steps[at][code] = twin
            at = self.suffix[at]
        return twin

    def _extend(self, last: int, code: int) -> int:
        if code in self.steps[last]:
            return self._split(last, code, self.steps[last][code])
        new, at = self._new(self.longest[last] + 1, {}, 0), last
        while at >= 0 and code not in self.steps[at]:
            self.steps[at][code] = new
            at = self.suffix[at]
        if at >= 0:
            self.suffix[new] = self._split(at, code, self.steps[at][code])
        return new

    def window_state(self, at: int) -> int:
        """The state of the last ``size`` words of a run that ends in ``at``."""
        while self.longest[self.suffix[at]] >= self.size:
            at = self.suffix[at]
        return at

    def stream(self, codes: list[int], offset: int, found: set[str], spans: list[list[int]]) -> None:
        """Add the items that occur in ``codes``, and the spans of hit words moved by ``offset``."""
        at = length = 0
        for i, code in enumerate(codes):
            while at and code not in self.steps[at]:
                at = self.suffix[at]
                length = self.longest[at]
            if code not in self.steps[at]:
                continue
            at, length = self.steps[at][code], length + 1
            reach = 0
            if length >= self.size:
                found |= self.items[self.window_state(at)]
                reach = self.size
            if self.has_short:
                state = at
                while state > 0:
                    for n, name in self.short[state]:
                        if n <= length:
                            found.add(name)
                            reach = max(reach, n)
                    state = self.suffix[state]
            if reach:
                add_span(spans, offset + i - reach + 1, offset + i)


def add_span(spans: list[list[int]], first: int, last: int) -> None:
    """Join a span that ends last to those before it."""
    while spans and spans[-1][1] >= first - 1:
        first = min(first, spans.pop()[0])
    spans.append([first, last])


def automaton(held, size: int) -> Automaton:
    names, texts = held.value
    words = split_words(pa.array(texts, pa.string()), ALPHANUMERIC)
    listed = [words.vocabulary[c] for c in words.codes] if words.n else []
    at = words.texts.tolist()
    return Automaton([(name, listed[a:b]) for name, a, b in zip(names, at, at[1:])], size)


def find(machine: Automaton, texts: pa.Array) -> tuple[np.ndarray, list[list[list[int]]], list[list[str]]]:
    """Words, spans of hit words and occurring items of each text."""
    words = split_words(texts, ALPHANUMERIC)
    n = len(words.counts)
    spans, items = [[] for _ in range(n)], [set() for _ in range(n)]
    if words.n:
        known = np.fromiter((machine.words.get(w, -1) for w in words.vocabulary), np.int64)[words.codes]
        # Only runs whose adjacent words are adjacent in some item can hold a window.
        owner = np.repeat(np.arange(n), words.counts)
        step = (known[1:] >= 0) & (known[:-1] >= 0) & (owner[1:] == owner[:-1])
        at = np.flatnonzero(step)
        step[at] = machine.adjacent(known[at], known[at + 1])
        begin, end = known >= 0, known >= 0
        begin[1:] &= ~step
        end[:-1] &= ~step
        first, last = np.flatnonzero(begin), np.flatnonzero(end)
        enough = last - first + 1 >= machine.least
        for a, b in zip(first[enough].tolist(), last[enough].tolist()):
            doc = owner[a]
            machine.stream(known[a : b + 1].tolist(), a - int(words.texts[doc]), items[doc], spans[doc])
    return words.counts, spans, [sorted(x) for x in items]


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               keep: list[str] | None = None, size: int = SIZE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` with the columns of ``RESULT``: word numbers of the hit spans, and the occurring items."""
    spark = docs.sparkSession
    listed = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).where("name is not null and text is not null")
    blocks = max(1, math.ceil((listed.agg(F.sum(F.length("text"))).first()[0] or 0) / block_chars))
    listed = listed.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    columns = docs.columns if keep is None else keep
    needed, found = list(dict.fromkeys([*columns, text])), docs
    for block in range(blocks):
        # One block of the stated query set, bounded by block_chars.
        rows = listed.where(F.col("block") == block).select("name", "text").collect()
        held = spark.sparkContext.broadcast(([r.name for r in rows], [r.text for r in rows]))
        found = one_block(found, text, held, size, needed if block + 1 < blocks else columns, merge=block > 0)
        if block + 1 < blocks:
            found = stored(found)
    return found


def one_block(docs: DataFrame, text: str, held, size: int, keep: list[str], merge: bool) -> DataFrame:
    if merge:
        docs = docs.withColumnsRenamed({"n_hit": "old_hit", "spans": "old_spans", "items": "old_items"})
        keep = [*[c for c in keep if c not in ("n_words", "n_hit", "spans", "items")], "old_spans", "old_items"]

    def begin():
        machine = automaton(held, size)

        def measure(texts: pa.Array) -> list[pa.Array]:
            n, spans, items = find(machine, texts)
            hit = [sum(b - a + 1 for a, b in s) for s in spans]
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            return [pa.array(n.astype(np.int64)), pa.array(hit, pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], kind), pa.array(items, pa.list_(pa.string()))]

        return measure

    found = appended(docs, text, RESULT, begin, keep)
    if merge:
        # Hit words of both: spans that touch are joined in the order of their first words.
        joined = F.aggregate(
            F.array_sort(F.concat("old_spans", "spans")), F.expr("cast(array() as array<struct<first:int,last:int>>)"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.element_at(done, -1)["last"] >= s["first"] - 1),
                F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                    F.element_at(done, -1)["first"].alias("first"),
                    F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last")))),
            ).otherwise(F.concat(done, F.array(s))))
        found = (found.withColumn("spans", joined)
                 .withColumn("items", F.array_sort(F.array_union("old_items", "items")))
                 .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1))
                 .drop("old_spans", "old_items"))
    return found


def without_spans(texts: pa.Array, spans: list[list[tuple[int, int]]]) -> list[str | None]:
    """Texts without the words of their spans and what stands between these words."""
    words = split_words(texts, ALPHANUMERIC)
    ends = words.starts + np.diff(words.at)
    bounds = np.concatenate([[0], np.cumsum([0 if t is None else len(t.encode()) for t in texts.to_pylist()])])
    out = []
    for k, (text, cut) in enumerate(zip(texts.to_pylist(), spans)):
        if cut:
            raw, base, kept, at = text.encode(), bounds[k], [], 0
            for first, last in cut:
                kept.append(raw[at : words.starts[words.texts[k] + first] - base])
                at = ends[words.texts[k] + last] - base
            text = b"".join([*kept, raw[at:]]).decode()
        out.append(text)
    return out


def clean(found: DataFrame, text: str = "text", max_span: int = MAX_SPAN, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Of the rows of ``find_items``: those over no limit, with their hit spans cut from the text."""
    longest = F.coalesce(F.array_max(F.transform("spans", lambda s: s["last"] - s["first"] + 1)), F.lit(0))
    rest = found.where((longest < max_span) & (F.col("n_hit") <= max_coverage * F.col("n_words")))
    columns, at, spans_at = rest.columns, rest.columns.index(text), rest.columns.index("spans")

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, text):
                spans = [[(s["first"], s["last"]) for s in x] for x in batch.column(spans_at).to_pylist()]
                if any(spans):
                    held = batch.column(at)
                    cut = [without_spans(held.slice(i, 1), [s])[0] if s else held[i].as_py() for i, s in enumerate(spans)]
                    batch = batch.set_column(at, text, pa.array(cut, pa.string()))
                yield pa.RecordBatch.from_arrays(batch.columns, columns)
            release()

    return rest.mapInArrow(run, rest.schema)


def cleaned(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE,
            max_span: int = MAX_SPAN, max_coverage: float = MAX_COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``clean`` of ``find_items`` with the columns of ``docs``; one pass, and one worker a task, where the items are one block."""
    listed = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).where("name is not null and text is not null")
    if (listed.agg(F.sum(F.length("text"))).first()[0] or 0) > block_chars:
        return clean(find_items(docs, items, text, item_id, item_text, None, size, block_chars), text, max_span, max_coverage).select(*docs.columns)
    rows = listed.collect()  # block_chars at most
    held = docs.sparkSession.sparkContext.broadcast(([r.name for r in rows], [r.text for r in rows]))
    columns, at = docs.columns, docs.columns.index(text)

    def run(batches):
        machine = automaton(held, size)
        for whole in batches:
            for batch in text_slices(whole, text):
                n, spans, _ = find(machine, batch.column(at))
                lengths = [[last - first + 1 for first, last in s] for s in spans]
                good = [max(x, default=0) < max_span and sum(x) <= max_coverage * k for x, k in zip(lengths, n.tolist())]
                if any(spans):
                    texts = batch.column(at)
                    cut = [without_spans(texts.slice(i, 1), [s])[0] if s and ok else texts[i].as_py() for i, (s, ok) in enumerate(zip(spans, good))]
                    batch = batch.set_column(at, text, pa.array(cut, pa.string()))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns], columns)
            release()

    return docs.mapInArrow(run, docs.schema)
