"""Best-fit packing of whole documents into sequences of bounded length.

Documents become token numbers with an end mark; only longer ones are cut. A piece of more
than half a sequence opens one: no two of those share. The others are placed class by class,
largest first, in rounds. The classes are those that go two, three ... to a sequence, so what
a class's own sequences leave free holds no other document of it:

* documents of the class and gaps are sorted by size, falling, in ranges over many tasks;
* each task sweeps its range and gives every document the least gap that holds it (its
  successor in size); what is left of a gap is a gap again, in its place in the order;
* documents that found none and gaps that took none meet across the ranges by rank: in the
  order of sizes the document takes the nearest gap before it. Only counts for each range go
  through the driver;
* gaps shrink by what they took, and a second sweep goes over them and the documents left,
  which now open a sequence where they find no gap.

Ties in size are broken by number, so a length that a third of all documents have is spread
over ranges like any other.

Defined cases: a null or empty text is the end mark alone. Repeated rows are documents of
their own. Nothing in gives nothing out. Columns other than the two named play no part.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import written
from .token_ids import Encoder
from .words import text_slices

LIMIT = 2048
END = 0
#: A class ends at the sequence's length by each of these; documents of a 32nd or less are one class.
CLASSES = (2, 3, 4, 5, 6, 8, 16, 32)
#: Rows of a range: what is swept at a time, and what may be held in gaps. A task writes some ranges to one file.
RANGE_ROWS = 50_000
RANGES_A_FILE, LEAST_FILES = 32, 8
SLICE_BYTES = 8 << 20

PIECES = "number long, doc_id long, piece int, start long, length long, ids_crc32 long"
RESULT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

# What a row of a sweep is: a placed document, one that found no gap, a gap that the documents of later
# ranges fit (with the slots it has for them), and any other gap.
PLACED, UNPLACED, OPEN, GAP = range(4)
SWEPT = "what int, range int, rank long, slots long, number long, size long, sequence long, offset long"


def cut_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END) -> DataFrame:
    """Pieces of at most ``limit`` tokens of every document (``PIECES``), numbered over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = Encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows in text_slices(batch, "text", SLICE_BYTES):
                names, texts = rows.column(0).to_pylist(), rows.column(1)
                if texts.nbytes > SLICE_BYTES and len(texts) == 1:
                    flat = encoder.of_text(texts, [end], SLICE_BYTES)
                    bounds = np.array([0, len(flat)])
                else:
                    flat, bounds = encoder.of_texts(texts, [end])
                data, out = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B"), []
                for name, first, last in zip(names, bounds[:-1].tolist(), bounds[1:].tolist()):
                    for piece, at in enumerate(range(first, last, limit)):
                        stop = min(at + limit, last)
                        out.append((number, name, piece, at - first, stop - at, zlib.crc32(data[4 * at : 4 * stop])))
                        number += 1
                columns = zip(*out) if out else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, PIECES)


def sweep(limit: int, opening: bool):
    """Best fit over one range: rows of (size, document or gap, number, range), sizes falling.

    ``held`` has the gaps of each size that are still there, ``sizes`` those sizes in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, sizes, rank, least = None, {}, [], 0, limit

        def add(size: int, sequence: int) -> None:
            if size in held:
                held[size].append(sequence)
            elif size:
                held[size] = [sequence]
                insort(sizes, size)

        for batch in batches:
            out = []
            for size, is_document, number, part in zip(*(c.to_pylist() for c in batch.columns)):
                least = size
                if not is_document:
                    add(size, number)
                    continue
                at = bisect_left(sizes, size)
                if at < len(sizes):
                    gap = sizes[at]
                    sequence = held[gap].pop()
                    if not held[gap]:
                        del held[gap], sizes[at]
                elif opening:
                    gap, sequence = limit, number
                else:
                    out.append((UNPLACED, part, rank, None, number, size, None, None))
                    rank += 1
                    continue
                out.append((PLACED, part, None, None, number, size, sequence, limit - gap))
                add(gap - size, sequence)
            yield table_of(out)
        slot, out = 0, []
        for size in sizes:
            for sequence in held[size]:
                slots = size // least if size >= least and not opening else 0
                out.append((OPEN if slots else GAP, part if slots else None, slot, slots, None, size, sequence, None))
                slot += slots
                if len(out) == 10_000:
                    yield table_of(out)
                    out = []
        yield table_of(out)

    return run


def table_of(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in SWEPT.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32() if kind == "int" else pa.int64()) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields])


def ranges(rows: int) -> int:
    """Ranges for so many rows: two at least, and beyond 20,000 larger ones rather than more."""
    return max(2, min(rows // RANGE_ROWS, max(20_000, rows // (20 * RANGE_ROWS))))


def kept(rows: DataFrame, n: int) -> DataFrame:
    """A sweep's rows as a stored table; the ranges of ``n`` rows share files."""
    return written(rows.coalesce(max(LEAST_FILES, ranges(n) // RANGES_A_FILE)))


def swept(docs: DataFrame, gaps: DataFrame, least: int, rows: int, limit: int, opening: bool) -> DataFrame:
    """One sweep of documents (number, size) over gaps (sequence, size) as a stored table (``SWEPT``).

    Gaps of ``least`` or less hold no document and are passed on as they are, so the last
    table has all gaps there are.
    """
    both = docs.select("size", F.lit(1).alias("is_document"), "number").union(
        gaps.where(F.col("size") > least).select("size", F.lit(0), F.col("sequence")))
    order = [F.desc("size"), F.asc("is_document"), F.asc("number")]
    placed = both.repartitionByRange(ranges(rows), *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    out = placed.mapInArrow(sweep(limit, opening), SWEPT)
    return kept(out.union(row_of(gaps.where(F.col("size") <= least), GAP, size="size", sequence="sequence")), rows)


def row_of(rows: DataFrame, what: int, **values) -> DataFrame:
    """Rows in the form of ``SWEPT``, null where nothing is told."""
    fields = [f.split() for f in SWEPT.split(", ")]
    told = {"what": F.lit(what)} | {name: F.col(v) if isinstance(v, str) else v for name, v in values.items()}
    return rows.select(*[told.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


class Meeting:
    """Which ranks of unplaced documents of a range take which slots of an earlier one.

    ``counts`` has a row for each range with its unplaced documents and open slots. A range's
    gaps lie before those of all later ranges, so the last range with free slots is nearest.
    ``found`` has the runs that meet, ``taken`` and ``used`` what each range has spent.
    """

    def __init__(self, counts: list):
        self.found, self.taken, self.used, stack = [], {}, {}, []
        for row in sorted(counts, key=lambda r: r["range"]):
            rank = 0
            while rank < row["unplaced"] and stack:
                gaps, slot, free = stack.pop()
                n = min(free, row["unplaced"] - rank)
                self.found.append((row["range"], rank, rank + n, gaps, slot))
                rank, self.used[gaps] = rank + n, slot + n
                if free > n:
                    stack.append((gaps, slot + n, free - n))
            self.taken[row["range"]] = rank
            if row["slots"]:
                stack.append((row["range"], 0, row["slots"]))

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        spent = [(p, n, self.used.get(p, 0)) for p, n in self.taken.items()]
        return (spark.createDataFrame(self.found, "range int, first long, last long, gaps int, slot long"),
                spark.createDataFrame(spent, "range int, taken long, used long"))


def met(found: DataFrame, meeting: Meeting, rows: int, limit: int) -> DataFrame:
    """Rows of a sweep after its unplaced documents and open gaps have met (stored, ``SWEPT``).

    A gap has as many slots as it holds documents of its range's least size, and later
    documents are no larger, so whatever takes its slots fits. The broadcast tables have a
    row for each range, and for each run of ranks that meet: two for each range at most.
    """
    meet, spent = meeting.tables(found.sparkSession)
    of_range = found.join(F.broadcast(spent), "range")
    docs = (
        found.where(F.col("what") == UNPLACED).join(F.broadcast(meet), "range").where("rank >= first and rank < last")
        .select("gaps", (F.col("slot") + F.col("rank") - F.col("first")).alias("at"), "number", F.col("size").alias("length"))
    )
    slots = (
        of_range.where((F.col("what") == OPEN) & (F.col("rank") < F.col("used")))
        .select(F.col("range").alias("gaps"), "sequence", "size",
                F.explode(F.expr("sequence(rank, least(rank + slots, used) - 1)")).alias("at"))
    )
    # A gap has fewer slots than its size, so the rows of a sequence are few. It may have got none of its slots' documents.
    pairs = slots.join(docs, ["gaps", "at"])
    before = Window.partitionBy("sequence").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("sequence")
    pairs = pairs.withColumn("ahead", F.coalesce(F.sum("length").over(before), F.lit(0))) \
        .withColumn("all", F.sum("length").over(whole)).withColumn("last", F.col("at") == F.max("at").over(whole))
    placed = row_of(pairs, PLACED, number="number", size="length", sequence="sequence", offset=limit - F.col("size") + F.col("ahead"))
    shrunk = row_of(pairs.where("last"), GAP, size=F.col("size") - F.col("all"), sequence="sequence")
    # Of an open gap that has met nothing, and of all other rows, nothing changes; those passed on have no range.
    gone = (F.col("what") == UNPLACED) & (F.col("rank") < F.col("taken")) | (F.col("what") == OPEN) & (F.col("rank") < F.col("used"))
    rest = found.join(F.broadcast(spent), "range", "left").where(~F.coalesce(gone, F.lit(False)))
    return kept(rest.select(*placed.columns).union(placed).union(shrunk), rows)


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(number, sequence, offset) of every piece; ``pieces`` is a stored table with ``number`` and ``length``."""
    unplaced, is_gap, half = F.col("what") == UNPLACED, F.col("what").isin(OPEN, GAP), limit // 2
    large = pieces.where(F.col("length") > half)  # class 0
    placed = [large.select("number", F.col("number").alias("sequence"), F.lit(0).cast("long").alias("offset"))]
    gaps = large.where(F.col("length") < limit).select(F.col("number").alias("sequence"), (limit - F.col("length")).alias("size"))
    per_class = sum((F.when(F.col("length") <= limit // k, 1).otherwise(0) for k in CLASSES), F.lit(0))
    sizes = {r["class"]: r["n"] for r in pieces.groupBy(per_class.alias("class")).agg(F.count("*").alias("n")).collect()}
    n_gaps = sizes.get(0, 0)
    for number in sorted(set(sizes) - {0}):
        docs = pieces.where(per_class == number).select("number", F.col("length").alias("size"))
        rows, least = sizes[number], limit // CLASSES[number] if number < len(CLASSES) else 0
        for opening in (False, True):
            found = swept(docs, gaps, least, rows + n_gaps, limit, opening)
            left = 0
            if not opening:
                counts = found.where("range is not null").groupBy("range").agg(
                    F.count_if(unplaced).alias("unplaced"), F.sum(F.when(F.col("what") == OPEN, F.col("slots")).otherwise(0)).alias("slots")).collect()
                meeting = Meeting(counts)
                if meeting.found:
                    found = met(found, meeting, rows + n_gaps, limit)
                left = sum(r["unplaced"] for r in counts) - sum(meeting.taken.values())
            placed.append(found.where(F.col("what") == PLACED).select("number", "sequence", "offset"))
            docs, gaps = found.where(unplaced).select("number", "size"), found.where(is_gap & (F.col("size") > 0)).select("sequence", "size")
            rows, n_gaps = left, n_gaps + left
            if not left:
                break
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row for each piece with its sequence and its place there (``RESULT``)."""
    pieces = written(cut_pieces(docs, path, doc_id, text, limit))
    return pieces.join(place(pieces, limit), "number").withColumnRenamed("sequence", "sequence_id").select(*RESULT)
