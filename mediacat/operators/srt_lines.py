"""Cues of SRT files of any size: the files are read in byte ranges, line by line.

A range that ends inside a cue needs nothing of its neighbour's text but its first lines, and
what follows a range's last cue start belongs to that cue. So lines are looked at range by
range, and one small row for each range carries over: the first two lines, and how many cues
began. A cue is put together from its own lines only; no file is ever one value.

What is a cue is as in :mod:`.srt`: a number, a timing line and text, at the beginning of a file
or after a blank line. Pieces that are no cue are kept apart (:func:`unparsed_lines`), among them a
number and a timing line with which a file breaks off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.timecode import timecode_to_millis, timecode_to_seconds

FILE = ["author", "permlink", "language"]
SCHEMA = "value string, author string, permlink string, language string"
# The lines that begin a cue.
NUMBER = r"^\d+$"
TIMING = r"^(\d{2,}:\d{2}:\d{2},\d{3}) --> (\d{2,}:\d{2}:\d{2},\d{3})$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files under ``author=…/permlink=…/language=…``: (file, range, line number in it, line).

    Line ends of every kind are taken off. A range begins where the file system cuts a file;
    lines of one range come in their order in one task.
    """
    lines = spark.read.schema(SCHEMA).text(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    return lines.select(*FILE, "file", "range", F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _ahead(lines: DataFrame) -> DataFrame:
    """Lines with the two that follow each, over the bounds of ranges."""
    inside = W.partitionBy("file", "range").orderBy("at")
    heads = lines.withColumn("_n", F.row_number().over(inside)).where("_n <= 2").groupBy("file", "range").agg(
        F.array_sort(F.collect_list(F.struct("_n", "line"))).alias("_head"))
    # The next range may have but one line; a list of the heads that follow holds the two that count.
    later = W.partitionBy("file").orderBy("range").rowsBetween(1, 2)
    follow = heads.select(
        "file", "range", F.slice(F.flatten(F.collect_list(F.transform("_head", lambda h: h["line"])).over(later)), 1, 2).alias("_follow"))
    placed = lines.withColumn("_next", F.lead("line").over(inside)).withColumn("_after", F.lead("line", 2).over(inside)) \
        .withColumn("_left", F.lead(F.lit(1), 1).over(inside).isNull().cast("int") + F.lead(F.lit(1), 2).over(inside).isNull().cast("int"))
    found = placed.join(follow, ["file", "range"])
    first, second = F.get("_follow", F.lit(0)), F.get("_follow", F.lit(1))
    return (
        found.withColumn("_next", F.when(F.col("_left") == 2, first).otherwise(F.col("_next")))
        .withColumn("_after", F.when(F.col("_left") == 2, second).when(F.col("_left") == 1, first).otherwise(F.col("_after")))
        .drop("_left", "_follow")
    )


def pieces(lines: DataFrame) -> DataFrame:
    """Lines with the number of the piece of their file they are in (``piece``), from 0.

    A piece begins at the first line of a file that is not blank, and after every blank line
    that a number and a timing line follow.
    """
    begins = F.col("_next").rlike(NUMBER) & F.col("_after").rlike(TIMING) & (F.col("line") == "")
    marked = _ahead(lines).withColumn("_ends", F.coalesce(begins, F.lit(False)).cast("long"))
    up_to = W.partitionBy("file", "range").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    # One row for each range: the cues that began before it.
    offsets = marked.groupBy("file", "range").agg(F.sum("_ends").alias("_n")).select(
        "file", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    counted = marked.withColumn("_inside", F.coalesce(F.sum("_ends").over(up_to), F.lit(0))).join(offsets, ["file", "range"])
    return counted.select(*FILE, "file", "range", "at", "line", (F.col("_before") + F.col("_inside")).alias("piece"))


def _texts(lines: DataFrame) -> DataFrame:
    """One row for each piece: its text without the blank line that ends it."""
    held = F.transform(F.array_sort(F.collect_list(F.struct("range", "at", "line"))), lambda p: p["line"])
    joined = pieces(lines).groupBy(*FILE, "file", "piece").agg(held.alias("_lines"))
    n = F.size("_lines")
    kept = F.slice("_lines", F.lit(1), F.when(F.element_at("_lines", -1) == "", n - 1).otherwise(n))
    text = F.regexp_replace(F.array_join(kept, "\n"), r"\A\x{FEFF}?\n*", "")
    return joined.select(*FILE, "file", "piece", text.alias("_text")).withColumn("_lines", F.split("_text", "\n", 3))


def _is_cue() -> Column:
    line = lambda i: F.coalesce(F.get("_lines", F.lit(i)), F.lit(""))
    return line(0).rlike(NUMBER) & line(1).rlike(TIMING) & F.get("_lines", F.lit(2)).isNotNull()


def parse_lines(lines: DataFrame) -> DataFrame:
    """Cues of all files, as :func:`.srt.parse_documents` gives them for texts; ``seg_idx`` numbers a file's cues from 0."""
    cues = _texts(lines).where(_is_cue())
    timing = lambda i: F.regexp_extract(F.get("_lines", F.lit(1)), TIMING, i)
    return cues.select(
        *FILE, "piece", F.get("_lines", F.lit(0)).try_cast("bigint").alias("cue_no"),
        timecode_to_seconds(timing(1)).alias("start_s"), timecode_to_seconds(timing(2)).alias("end_s"),
        timecode_to_millis(timing(1)).alias("start_ms"), timecode_to_millis(timing(2)).alias("end_ms"),
        strip(F.get("_lines", F.lit(2))).alias("text"),
    )


def unparsed_lines(lines: DataFrame) -> DataFrame:
    """Pieces that are no cue: (file's keys, ``piece``, ``text``)."""
    return _texts(lines).where(~_is_cue() & (F.col("_text") != "")).select(*FILE, "piece", F.col("_text").alias("text"))
