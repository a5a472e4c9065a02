"""SRT text: render, parse, check."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.timecode import timecode_to_millis, timecode_to_seconds, to_millis, to_timecode
from ..session import kept
from .ordered import gather_blocks, next_value
from .transcript import segment_block

DOCUMENT = ["author", "permlink", "language"]
# Start of a cue, seen from the end of the one before it.
CUE_BOUNDARY = r"\n\n(?=\d+\n\d{2,}:\d{2}:\d{2},\d{3} --> \d{2,}:\d{2}:\d{2},\d{3}\n)"
CUE_FORM = r"^(\d+)\n(\d{2,}:\d{2}:\d{2},\d{3}) --> (\d{2,}:\d{2}:\d{2},\d{3})\n([\s\S]*)$"


def cue_body() -> Column:
    """A cue without its number: timing line, text, blank line."""
    return F.concat(
        to_timecode(F.col("start_s")), F.lit(" --> "), to_timecode(F.col("end_s")), F.lit("\n"),
        strip(F.coalesce("text", F.lit(""))), F.lit("\n\n"),
    )


def subtitle_path() -> Column:
    return F.concat("author", F.lit("/"), "permlink", F.lit("."), "language", F.lit(".srt"))


def render_documents(
    cues: DataFrame, keys: Sequence[str] = DOCUMENT, order: Sequence[str] = ("seg_idx",),
    block: Column | None = None,
) -> DataFrame:
    """One SRT text per document, cues numbered from 1.

    Cues are gathered per block of a document, so a very long video is spread over many
    tasks; a document's number offsets follow from the block lists when they are put
    together. The finished text is one value and so at most what a row can hold;
    :func:`render_parts` gives the same text in bounded pieces.
    """
    at = segment_block() if block is None else block
    blocks = gather_blocks(cues, keys, list(order), at, cue_body())
    bodies = F.flatten(
        F.transform(F.array_sort(F.collect_list(F.struct("_block", "items"))), lambda b: b["items"])
    )
    return blocks.groupBy(*keys).agg(bodies.alias("_bodies")).select(
        *keys,
        F.array_join(
            F.transform("_bodies", lambda body, i: F.concat((i + 1).cast("string"), F.lit("\n"), body)), ""
        ).alias("srt"),
        F.size("_bodies").cast("bigint").alias("cue_count"),
    )


def render_parts(
    cues: DataFrame, keys: Sequence[str] = DOCUMENT, order: Sequence[str] = ("seg_idx",),
    block: Column | None = None, without: DataFrame | None = None,
) -> DataFrame:
    """The SRT text in ordered pieces (``part``, ``srt``), each of one block of cues.

    The blocks are kept in the shared folder, so the cues are made and gathered once: their
    numbers follow from one small row for each block. Documents of ``without`` (distinct keys) are left out there, so
    their cues need not be found by a join of their own.
    """
    keys = list(keys)
    at = segment_block() if block is None else block
    blocks = kept(gather_blocks(cues, keys, list(order), at, cue_body()), "blocks")
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select(*keys, "_block", F.size("items").alias("_n")).select(
        *keys, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if without is not None:
        before = before.join(without.select(*keys), keys, "left_anti")
    numbered = F.transform("items", lambda body, i: F.concat((F.col("_before") + i + 1).cast("string"), F.lit("\n"), body))
    return blocks.join(before, [*keys, "_block"]).select(
        *keys, F.col("_block").alias("part"), F.array_join(numbered, "").alias("srt"))


def _pieces(srt: Column) -> Column:
    """A file cut where cues start: line ends as newlines, no byte order mark, no blank lines around."""
    plain = F.regexp_replace(F.regexp_replace(srt, r"\r\n?", "\n"), r"\A\x{FEFF}?\n*", "")
    return F.split(F.regexp_replace(plain, r"\n\n\z", ""), CUE_BOUNDARY)


def _cue_texts(srt: Column) -> Column:
    """Texts of the cues of one file; the closing blank line of each is left out."""
    return F.filter(_pieces(srt), lambda c: c.rlike(CUE_FORM))


def unparsed(documents: DataFrame, keys: Sequence[str] = DOCUMENT) -> DataFrame:
    """Pieces of files that are no cue: (keys, ``at``, ``piece``), for the user to look at."""
    found = documents.select(*keys, F.posexplode_outer(_pieces(F.col("srt"))).alias("at", "piece"))
    return found.where((F.col("piece") != "") & ~F.col("piece").rlike(CUE_FORM))


def parse_documents(documents: DataFrame, keys: Sequence[str] = DOCUMENT) -> DataFrame:
    """SRT texts back to cues. A map over files: one file is one row."""
    def group(i: int) -> Column:
        return F.regexp_extract("_cue", CUE_FORM, i)

    cues = F.posexplode_outer(_cue_texts(F.col("srt")))
    lines = documents.select(*keys, cues.alias("seg_idx", "_cue")).where(F.col("_cue").isNotNull())
    return lines.select(
        *keys, F.col("seg_idx").cast("bigint").alias("seg_idx"),
        group(1).try_cast("bigint").alias("cue_no"),
        timecode_to_seconds(group(2)).alias("start_s"), timecode_to_seconds(group(3)).alias("end_s"),
        timecode_to_millis(group(2)).alias("start_ms"), timecode_to_millis(group(3)).alias("end_ms"),
        strip(group(4)).alias("text"),
    )


def document_quality(documents: DataFrame, keys: Sequence[str] = DOCUMENT) -> DataFrame:
    """Cue, blank and overlap counts of each file, and whether it has any cue.

    A report, never a filter. Counted inside the row that holds the file.
    """
    cue = F.transform(
        _cue_texts(F.col("srt")),
        lambda c: F.struct(
            timecode_to_millis(F.regexp_extract(c, CUE_FORM, 2)).alias("start_ms"),
            timecode_to_millis(F.regexp_extract(c, CUE_FORM, 3)).alias("end_ms"),
            (strip(F.regexp_extract(c, CUE_FORM, 4)) == "").alias("blank"),
        ),
    )
    n = F.size("_cues")
    overlapping = F.filter(
        F.zip_with(
            "_cues", F.slice("_cues", F.lit(2), n),
            lambda a, b: F.coalesce(a["end_ms"] > b["start_ms"], F.lit(False)),
        ),
        lambda x: x,
    )
    return documents.select(*keys, cue.alias("_cues")).select(
        *keys,
        n.cast("bigint").alias("cue_count"),
        F.size(F.filter("_cues", lambda c: c["blank"])).cast("bigint").alias("empty_count"),
        F.size(overlapping).cast("bigint").alias("overlap_count"),
        (n > 0).alias("is_valid"),
    )


def overlaps(cues: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seg_idx",),
             block: Column | None = None) -> DataFrame:
    """Flag every cue that ends after the next one starts."""
    at = segment_block() if block is None else block
    timed = cues.withColumn("start_ms", to_millis(F.col("start_s"))).withColumn(
        "end_ms", to_millis(F.col("end_s"))
    )
    ahead = next_value(timed, keys, list(order), at, "start_ms", "next_start_ms")
    return ahead.withColumn(
        "is_overlap", F.coalesce(F.col("end_ms") > F.col("next_start_ms"), F.lit(False))
    )


def with_content_id(documents: DataFrame) -> DataFrame:
    """Content hash of each text: equal files get equal ids."""
    return documents.withColumn("subtitle_cid", F.sha2("srt", 256))


def _carried(n_keys: int):
    """Sorted pieces through one digest after another; a piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sha = schema = None
        size = pieces = 0
        for batch in batches:
            schema, out = batch.schema, []
            for *found, text in zip(*(batch.column(i).to_pylist() for i in [*range(n_keys), n_keys + 1])):
                if found != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest(), size, pieces))
                    key, sha, size, pieces = found, hashlib.sha256(), 0, 0
                data = (text or "").encode()
                sha.update(data)
                size, pieces = size + len(data), pieces + 1
            yield _named(out, schema, n_keys)
        if key is not None:
            yield _named([(*key, sha.hexdigest(), size, pieces)], schema, n_keys)

    return run


def _named(rows: list[tuple], schema: pa.Schema, n_keys: int) -> pa.RecordBatch:
    kinds = [*[schema.field(i).type for i in range(n_keys)], pa.string(), pa.int64(), pa.int64()]
    names = [*[schema.field(i).name for i in range(n_keys)], "subtitle_cid", "n_bytes", "n_parts"]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def content_ids(parts: DataFrame, keys: Sequence[str] = DOCUMENT, part: str = "part", text: str = "srt") -> DataFrame:
    """Content hash, bytes and number of pieces of each document from its ordered pieces.

    The hash is that of the whole text, which is never put together: a document's pieces come
    from many tasks and stream in their order through one digest.
    """
    placed = parts.select(*keys, F.col(part).alias("_part"), F.col(text).alias("_text")).repartition(*keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields[: len(keys)])
    return placed.sortWithinPartitions(*keys, "_part").mapInArrow(
        _carried(len(keys)), f"{kinds}, subtitle_cid string, n_bytes long, n_parts long")
