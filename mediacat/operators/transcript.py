"""Timed transcripts: cue splitting, corrections, text and duration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed_values import MAX_WORDS, SENTENCE_END
from ..functions.text import corrected, strip
from ..sources.catalog import KEY
from .ordered import block_of, join_facts, join_texts, number_rows

CUE = ["raw_seg", "cue_in_seg"]


def words_of(raw_segments: DataFrame) -> DataFrame:
    """Raw segments to flat words, numbered inside their segment."""
    flat = raw_segments.select(*KEY, "raw_seg", F.posexplode_outer("words").alias("word_in_seg", "w"))
    return flat.where(F.col("w").isNotNull()).select(
        *KEY, "raw_seg", "word_in_seg", "w.word", "w.start_s", "w.end_s"
    )


def split_segments(raw_segments: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Cut long raw segments at sentence ends and otherwise every ``max_words`` words.

    All of it happens inside the row that holds the segment, so it needs no shuffle:
    word numbers that end a sentence give the sentence ranges, each range gives the
    first word of its cues, and neighbouring first words give the slices. Segments of
    at most ``max_words`` words stay whole; blank pieces of a cut segment are dropped.
    """
    def ends_sentence(i: Column) -> Column:
        return strip(F.element_at(F.col("_word"), i)).rlike(SENTENCE_END)

    def following(starts: str) -> Column:
        """Each start's successor; the last one is followed by the end of the segment."""
        return F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.col("_n") + 1))

    def piece(first: Column, after: Column) -> Column:
        return F.struct(
            F.element_at(F.col("_from"), first).alias("start_s"),
            F.element_at(F.col("_to"), after - 1).alias("end_s"),
            strip(F.array_join(F.slice("_word", first, after - first), "")).alias("text"),
        )

    whole = raw_segments.select(
        *KEY, "raw_seg", "start_s", "end_s", "text", F.col("words.word").alias("_word"),
        F.col("words.start_s").alias("_from"), F.col("words.end_s").alias("_to"),
        F.coalesce(F.size("words"), F.lit(0)).alias("_n"),
    ).withColumn("_long", F.col("_n") > max_words)
    inner_ends = F.filter(F.sequence(F.lit(1), F.col("_n") - 1), ends_sentence)
    sentences = F.concat(F.array(F.lit(1)), F.transform(inner_ends, lambda i: i + 1))
    first_words = F.flatten(
        F.zip_with("_sentences", following("_sentences"), lambda a, b: F.sequence(a, b - 1, F.lit(max_words)))
    )
    pieces = F.filter(
        F.zip_with("_starts", following("_starts"), piece), lambda cue: cue["text"] != ""
    )
    kept = F.array(F.struct("start_s", "end_s", strip(F.coalesce("text", F.lit(""))).alias("text")))
    return (
        whole.withColumn("_sentences", F.when(F.col("_long"), sentences))
        .withColumn("_starts", F.when(F.col("_long"), first_words))
        .withColumn("_cues", F.when(F.col("_long"), pieces).otherwise(kept))
        # The outer form keeps Spark from adding a second evaluation of the array as a filter.
        .select(*KEY, "raw_seg", F.posexplode_outer("_cues").alias("cue_in_seg", "_cue"))
        .where(F.col("_cue").isNotNull())
        .select(*KEY, "raw_seg", F.col("cue_in_seg").cast("bigint").alias("cue_in_seg"), "_cue.*")
    )


def split_words(words: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The same cues from flat timed words, one row per word in ``word_idx`` order.

    Whatever a segment's length, no task holds it whole: words are gathered once per block of
    a segment and cut inside the row that holds the block, one row per block links the blocks,
    and only the pieces of segments with several blocks are put together again. ``first_word`` is
    the place of a cue's first word in its segment (from 1) and so the order of the cues.
    """
    seg = [*KEY, "raw_seg"]
    held = F.sort_array(F.collect_list(F.struct("word_idx", "word", "start_s", "end_s")))
    # Words without a key are in no segment. Said column by column, all readers of the gathered words share one shuffle.
    placed = words.withColumn("_block", block_of("word_idx"))
    for column in [*seg, "_block"]:
        placed = placed.where(F.col(column).isNotNull())
    ends = F.filter(
        F.transform("_w", lambda w, i: F.when(strip(w["word"]).rlike(SENTENCE_END), i + 1)), lambda i: i.isNotNull()
    )
    gathered = placed.groupBy(*seg, "_block").agg(held.alias("_w")).withColumn("_n", F.size("_w")).withColumn("_ends", ends)
    whole = W.partitionBy(*seg).orderBy("_block")
    before = whole.rowsBetween(W.unboundedPreceding, -1)
    # The blocks of the segments that have more than one.
    links = (
        gathered.select(*seg, "_block", F.col("_n").cast("bigint").alias("_n"), F.array_max("_ends").alias("_last_end"))
        .withColumn("_total", F.sum("_n").over(W.partitionBy(*seg)))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_earlier_end", F.max(F.col("_offset") + F.col("_last_end")).over(before))
        .where("_total > _n").select(*seg, "_block", "_offset", "_total", "_earlier_end")
    )
    n, offset = F.col("_n"), F.coalesce("_offset", F.lit(0)).cast("int")
    # Where the first cue of the block starts, at 1 or in an earlier block.
    running = F.coalesce("_earlier_end", F.lit(0)).cast("int") - offset
    first = running + F.call_function("div", -running, F.lit(max_words)).cast("int") * max_words + 1
    starts = F.concat(F.array(first), F.transform(F.filter("_ends", lambda i: i < n), lambda i: i + 1))

    def following(column: str) -> Column:
        return F.concat(F.slice(column, F.lit(2), F.size(column)), F.array(n + 1))

    cut = F.flatten(F.zip_with("_runs", following("_runs"), lambda a, b: F.sequence(a, b - 1, F.lit(max_words))))

    def piece(a: Column, b: Column) -> Column:
        at = F.greatest(a, F.lit(1))
        return F.struct((offset + a).cast("bigint").alias("first_word"), F.slice("_w", at, b - at).alias("_w"))

    linked = gathered.join(links, [*seg, "_block"], "left").withColumn("_total", F.coalesce("_total", "_n"))
    pieces = (
        linked.withColumn("_runs", F.when(F.col("_total") > max_words, starts).otherwise(F.array(1 - offset)))
        .withColumn("_starts", F.when(F.col("_total") > max_words, cut).otherwise(F.col("_runs")))
        .withColumn("_pieces", F.zip_with("_starts", following("_starts"), piece))
        .select(*seg, "_block", "_total", F.col("_offset").isNotNull().alias("_several"), F.explode_outer("_pieces").alias("_piece"))
        .select(*seg, "_block", "_total", "_several", "_piece.*")
    )
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_w"))), lambda p: p["_w"]))
    several = pieces.where("_several").groupBy(*seg, "first_word").agg(joined.alias("_w"), F.max("_total").alias("_total"))
    cues = pieces.where("not _several").drop("_block", "_several").unionByName(several)
    text = strip(F.array_join(F.transform("_w", lambda w: w["word"]), ""))
    return (
        cues.select(
            *seg, "first_word", F.element_at("_w", 1)["start_s"].alias("start_s"), F.element_at("_w", -1)["end_s"].alias("end_s"),
            text.alias("text"), "_total",
        )
        .where((F.col("_total") <= max_words) | (F.col("text") != "")).drop("_total")
    )


def cue_block() -> Column:
    """Ordering block of split cues: a few hundred raw segments."""
    return block_of("raw_seg", 512)


def segment_block() -> Column:
    return block_of("seg_idx")


def number_cues(cues: DataFrame) -> DataFrame:
    """Give split cues one running index per video (``seg_idx`` from 0)."""
    numbered = number_rows(cues, KEY, CUE, cue_block(), "_no")
    return numbered.select(*KEY, (F.col("_no") - 1).alias("seg_idx"), "start_s", "end_s", "text")


def apply_corrections(segments: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    return segments.withColumn("text", corrected(F.col("text"), rules))


def spoken_cues(
    raw_segments: DataFrame, videos: DataFrame, rules: Sequence[tuple[str, str]], max_words: int = MAX_WORDS,
) -> DataFrame:
    """Corrected cues of the given videos (one row for each key).

    Cues move to their videos, and not the timed words they are cut from, which are several times as long.
    """
    cues = split_segments(raw_segments, max_words)
    return apply_corrections(join_facts(cues, videos.select(*KEY), KEY, cue_block(), "left_semi", raw_segments), rules)


def within(segments: DataFrame, seconds: float | None) -> DataFrame:
    """Segments that start before a limit; no limit keeps all."""
    return segments.where(F.col("start_s") < F.lit(float(seconds))) if seconds else segments


def transcript_text(
    segments: DataFrame, order: Sequence[str] = ("seg_idx",), block: Column | None = None,
    seconds: float | None = None, name: str = "transcript",
) -> DataFrame:
    """The texts of a video joined by one blank, in order."""
    kept = within(segments, seconds)
    at = segment_block() if block is None else block
    return join_texts(kept, KEY, list(order), at, F.col("text"), " ", name)


def cue_rank() -> Column:
    """Place of a split cue as one number, which keeps aggregates over it hash-based."""
    return F.shiftleft("raw_seg", 32) + F.col("cue_in_seg")


def video_duration(segments: DataFrame, order: Column | None = None) -> DataFrame:
    """Duration is the end of the last segment in order (not the greatest end)."""
    last = F.col("seg_idx") if order is None else order
    return segments.groupBy(*KEY).agg(F.max_by("end_s", last).alias("duration_s")).select(
        *KEY, "duration_s",
        (F.col("duration_s") / 60.0).alias("duration_min"),
        F.bround("duration_s").cast("int").alias("video_duration_seconds"),
    )
