"""The monitoring view: totals, backlogs, recent activity, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import iso
from ..functions.fixed_values import (
    AUDIO, EMBED, FEED_COMPLETED, FEED_PENDING, LEGACY, PAGE_MAX, RECENT_PER_TYPE,
)
from ..operators.ordered import position
from ..operators.selection import flag_creators, type_flags
from ..sinks.lists import queue_flags
from ..sinks.ordered_table import By, OrderedTable
from ..session import shared_folder
from ..sources.catalog import KEY, catalog_rank


def processed_type() -> Column:
    """Type of a processed video from its flags; a missing flag counts as not set."""
    audio = F.coalesce("is_audio", F.lit(False))
    embed = F.coalesce("is_embed", F.lit(False))
    return F.when(audio, AUDIO).when(embed, EMBED).otherwise(LEGACY)


def _type_totals(available: DataFrame, videos: DataFrame) -> DataFrame:
    """Per type: available, processed, pending (never below zero) and subtitle files."""
    tagged = available.select(
        "video_type", F.lit(1).alias("a"), F.lit(0).alias("p"), F.lit(0).cast("bigint").alias("s")
    ).unionByName(videos.select(
        processed_type().alias("video_type"), F.lit(0).alias("a"), F.lit(1).alias("p"),
        F.col("lang_count").alias("s"),
    ))
    return tagged.groupBy("video_type").agg(
        F.sum("a").alias("available"), F.sum("p").alias("processed"), F.sum("s").alias("subtitles")
    ).withColumn("pending", F.greatest(F.lit(0), F.col("available") - F.col("processed")))


def backlog_counts(available: DataFrame, videos: DataFrame) -> DataFrame:
    """Per type: available, processed and their difference, never below zero."""
    return _type_totals(available, videos).drop("subtitles")


def backlog_exact(available: DataFrame, videos: DataFrame) -> DataFrame:
    """Per type: available videos that have no subtitle record."""
    open_items = available.select(*KEY, "video_type").join(videos.select(*KEY), KEY, "left_anti")
    return open_items.groupBy("video_type").agg(F.count("*").alias("pending"))


def language_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("language").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language")


def stats_summary(available: DataFrame, videos: DataFrame, tags: DataFrame) -> DataFrame:
    """One row of totals: three rows of per-type counts and one tag count, laid side by side."""
    tagged = tags.select(*KEY).distinct().agg(F.count("*").alias("n")).select(
        F.lit("tagged").alias("video_type"), "n"
    )
    rows = _type_totals(available, videos).unionByName(tagged, allowMissingColumns=True)

    def at(kind: str, column: str):
        return F.coalesce(F.sum(F.when(F.col("video_type") == kind, F.col(column))), F.lit(0))

    def every(column: str):
        return F.coalesce(F.sum(column), F.lit(0))

    return rows.agg(
        every("processed").alias("total_processed"), every("subtitles").alias("total_subtitles"),
        at("tagged", "n").alias("total_tagged"), every("available").alias("total_available"),
        *[at(kind, "available").alias(f"total_{kind}") for kind in (LEGACY, EMBED, AUDIO)],
        *[at(kind, "processed").alias(f"processed_{kind}") for kind in (LEGACY, EMBED, AUDIO)],
        every("pending").alias("pending"),
        *[at(kind, "pending").alias(f"pending_{kind}") for kind in (LEGACY, EMBED, AUDIO)],
    )


def stats_json(summary: DataFrame, generated_at: str, start_date: str) -> DataFrame:
    fields = [F.lit(start_date or "all").alias("start_date"), *summary.columns,
              F.lit(generated_at).alias("generated_at")]
    return summary.select(F.to_json(F.struct(*fields)).alias("stats"))


def processed_since(videos: DataFrame, since: Column) -> DataFrame:
    return videos.where(F.col("created_at") >= since).agg(F.count("*").alias("n_processed"))


def run_summary(run_log: DataFrame) -> DataFrame:
    """Totals of the batch items of a run; excluded items count in the total only."""
    return run_log.where(F.col("source") == "batch").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("outcome") == "success").alias("successful"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )


def _run_facts(rows: DataFrame) -> list[Column]:
    """Processing time and length of an item, where its rows carry them (see ``with_processing_times``)."""
    return [
        (F.col(c) if c in rows.columns else F.lit(None)).cast("int").alias(c)
        for c in ("processing_seconds", "video_duration_seconds")
    ]


def _feed_row(rows: DataFrame, state, languages, lang_count, display_date: str) -> DataFrame:
    return rows.select(
        *KEY, state.alias("state"), "is_embed", "is_audio", languages.alias("languages"),
        lang_count.cast("bigint").alias("lang_count"), F.col(display_date).alias("display_date"), *_run_facts(rows),
    )


def _without_languages(rows: DataFrame, state, display_date: str) -> DataFrame:
    return _feed_row(rows, state, F.lit(""), F.lit(0), display_date)


def display_date():
    return F.coalesce("updated_at", "created_at")


def recent_completed(videos: DataFrame, limit: int = FEED_COMPLETED) -> DataFrame:
    newest = videos.orderBy(F.desc("updated_at"), *KEY).limit(limit)
    shown = newest.withColumn("display_date", display_date())
    return _feed_row(shown, F.lit("complete"), F.array_join("languages", ","), F.col("lang_count"), "display_date")


def recent_candidates(available: DataFrame, per_type: int = RECENT_PER_TYPE) -> DataFrame:
    """Newest rows of each catalog: one top-k per catalog."""
    def newest(kind: str) -> DataFrame:
        return (
            available.where(F.col("video_type") == kind).select(*KEY, "video_type", "created_at")
            .orderBy(F.desc_nulls_last("created_at"), *KEY).limit(per_type)
        )

    return newest(LEGACY).unionByName(newest(EMBED)).unionByName(newest(AUDIO))


def recent_pending(
    available: DataFrame, videos: DataFrame, queue: DataFrame, current: DataFrame,
    creators: DataFrame, limit: int = FEED_PENDING,
) -> DataFrame:
    """Newest candidates that are not processed, queued or in work. The candidates are
    limited before the exclusions and again after them; that order is part of the meaning.

    The few candidates are stored, so the catalogs are read once. They go to the large
    tables as a broadcast (one top-k per catalog bounds them), and only hits come back.
    """
    shared_folder(available.sparkSession)
    candidates = recent_candidates(available).checkpoint()
    taken = videos.select(*KEY).unionByName(queue.select(*KEY)).unionByName(current.select(*KEY))
    hits = taken.join(F.broadcast(candidates.select(*KEY)), KEY, "left_semi").distinct()
    left = flag_creators(candidates.join(hits, KEY, "left_anti"), creators)
    flagged = left.select(*KEY, "video_type", "created_at", "is_priority", *type_flags())
    kept = flagged.orderBy(F.desc_nulls_last("created_at"), catalog_rank(), *KEY).limit(limit)
    state_name = F.when(F.col("is_priority"), "prioritized").otherwise("pending")
    return _without_languages(kept, state_name, "created_at")


FINISHED_SECTION = 3


def activity_feed(
    available: DataFrame, catalogs: DataFrame, videos: DataFrame, queue: DataFrame,
    current: DataFrame, creators: DataFrame,
) -> DataFrame:
    """Item in work, queue, newest finished and newest pending, with a section number."""
    sections = [
        _without_languages(current, F.lit("processing"), "started_at"),
        _without_languages(queue_flags(queue, catalogs), F.lit("prioritized"), "requested_at"),
        recent_completed(videos),
        recent_pending(available, videos, queue, current, creators),
    ]
    numbered = [s.withColumn("section", F.lit(i)) for i, s in enumerate(sections, start=1)]
    feed = numbered[0]
    for section in numbered[1:]:
        feed = feed.unionByName(section)
    return feed


def feed_pending(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("state") != "complete")


def feed_complete(videos: DataFrame) -> DataFrame:
    """The finished section of the feed alone: the others are not computed."""
    return recent_completed(videos).withColumn("section", F.lit(FINISHED_SECTION))


def processed_page(
    videos: DataFrame, page: int = 1, per_page: int = 50
) -> DataFrame:
    """One page of processed videos, newest first, and whether there is a next page.

    One row more than the page is taken: it exists exactly when there is more. Pages are
    cut by row positions, so the rows before one are never sent to one task.
    """
    size = min(int(per_page), PAGE_MAX)
    skip = (page - 1) * size
    order = [F.desc("updated_at"), F.col("author"), F.col("permlink")]
    placed = position(videos, order, "_p")
    rows = placed.where(F.col("_p").between(skip + 1, skip + size + 1)).drop("_p")
    place = W.orderBy(*order)  # at most size + 1 rows
    rows = (
        rows.withColumn("_n", F.row_number().over(place))
        .withColumn("has_more", F.max("_n").over(W.partitionBy()) > size)
        .where(F.col("_n") <= size).drop("_n")
    )
    return rows.select(
        F.lit(page).alias("page"), *KEY, "is_embed", "is_audio", F.array_join("languages", ",").alias("languages"),
        iso(F.col("created_at")).alias("created_at"), iso(F.col("updated_at")).alias("updated_at"),
        iso(F.col("video_created_at")).alias("video_created_at"),
        iso(display_date()).alias("display_date"), "has_more", *_run_facts(rows),
    )


PAGE_ORDER = [By("updated_at", descending=True), By("author"), By("permlink")]


def store_finished(videos: DataFrame, path: str) -> OrderedTable:
    """Processed videos in page order, stored once; every page is then read from one or two of its files."""
    shared_folder(videos.sparkSession)
    rows = videos.withColumn("languages", F.array_join("languages", ","))
    return OrderedTable.write(rows.checkpoint(), path, PAGE_ORDER)


def stored_page(table: OrderedTable, page: int = 1, per_page: int = 50) -> DataFrame:
    """:func:`processed_page` from the stored order, at the same cost at every depth."""
    size = min(int(per_page), PAGE_MAX)
    rows = table.page(page, size)
    return rows.select(
        F.lit(page).alias("page"), *KEY, "is_embed", "is_audio", "languages", iso(F.col("created_at")).alias("created_at"),
        iso(F.col("updated_at")).alias("updated_at"), iso(F.col("video_created_at")).alias("video_created_at"),
        iso(display_date()).alias("display_date"), "has_more", *_run_facts(rows),
    )
