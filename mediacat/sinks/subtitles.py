"""Subtitle state: an append-only log of saves, folded to current rows.

A save sets the video's content id, one language's subtitle id and the update time
(last write wins) and, only when it creates the video's record, the type flags, the
creation time and the video's own date (first write wins, even when that date is
missing). Stored form is one row per (video, language) that keeps both its first and its
last save. That makes the fold associative and idempotent: folding a union of folded
parts, in any order and with repeats, gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import AUDIO, EMBED
from ..sources.catalog import KEY

STATE = [
    *KEY, "language", "subtitle_cid", "video_cid", "updated_at", "updated_seq",
    "video_type", "video_created_at", "created_at", "created_seq",
]


def as_state(log: DataFrame) -> DataFrame:
    """Each save as a state row of its own."""
    return log.select(
        *KEY, "language", "subtitle_cid", "video_cid",
        F.col("ts").alias("updated_at"), F.col("event_id").alias("updated_seq"),
        "video_type", "video_created_at",
        F.col("ts").alias("created_at"), F.col("event_id").alias("created_seq"),
    )


def fold(rows: DataFrame) -> DataFrame:
    """Current row per (video, language). Saves of a busy key collapse before the shuffle."""
    newest = F.struct("updated_at", "updated_seq")
    oldest = F.struct("created_at", "created_seq")
    last = ["subtitle_cid", "video_cid", "updated_at", "updated_seq"]
    first = ["video_type", "video_created_at", "created_at", "created_seq"]
    return (
        rows.groupBy(*KEY, "language")
        .agg(
            F.max_by(F.struct(*last), newest).alias("_l"),
            F.min_by(F.struct(*first), oldest).alias("_f"),
        )
        .select(*KEY, "language", "_l.*", "_f.*")
        .select(*STATE)
    )


def after_deletions(saves: DataFrame, deletions: DataFrame) -> DataFrame:
    """Saves (rows of :func:`as_state`) that no later deletion of their video has undone.

    ``deletions`` are events (author, permlink, ts, event_id). A record that is deleted and
    saved again is a new one: its first save is the first after the deletion.
    """
    newest = deletions.groupBy(*KEY).agg(F.max(F.struct("ts", "event_id")).alias("_gone"))
    at = F.struct(F.col("created_at").alias("ts"), F.col("created_seq").alias("event_id"))
    return saves.join(newest, KEY, "left").where(F.col("_gone").isNull() | (at > F.col("_gone"))).drop("_gone")


def headers(state: DataFrame) -> DataFrame:
    """One row per video from folded rows.

    ``languages`` lists the codes in the order they first appeared. A folded video has one
    row per language, so the list is short; it costs nothing where it is not used.
    """
    newest = F.struct("updated_at", "updated_seq")
    oldest = F.struct("created_at", "created_seq")
    return (
        state.groupBy(*KEY)
        .agg(
            F.max_by("video_cid", newest).alias("video_cid"),
            F.max("updated_at").alias("updated_at"),
            F.min_by(F.struct("video_type", "video_created_at"), oldest).alias("_f"),
            F.min("created_at").alias("created_at"),
            F.count("language").alias("lang_count"),
            F.array_sort(F.collect_list(F.struct("created_at", "created_seq", "language"))).alias("_e"),
        )
        .select(
            *KEY, "video_cid",
            F.col("_f.video_type").isin(EMBED, AUDIO).alias("is_embed"),
            (F.col("_f.video_type") == AUDIO).alias("is_audio"),
            "created_at", "updated_at",
            F.col("_f.video_created_at").alias("video_created_at"), "lang_count",
            F.transform("_e", lambda e: e["language"]).alias("languages"),
        )
    )


def as_map(state: DataFrame) -> DataFrame:
    """The ``language -> subtitle id`` map of each video."""
    return state.groupBy(*KEY).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "subtitle_cid")))).alias("subtitles")
    )


def from_maps(documents: DataFrame) -> DataFrame:
    """Map form to one row per (video, language); a missing map has no rows."""
    return documents.select(*KEY, F.explode("subtitles").alias("language", "subtitle_cid"))


def processing_times(run_log: DataFrame) -> DataFrame:
    """Newest seconds and newest non-zero duration per video."""
    at = F.struct("ts", "event_id")
    duration = F.nullif(F.col("video_duration_seconds"), F.lit(0))
    return run_log.groupBy(*KEY).agg(
        F.max_by("processing_seconds", at).alias("processing_seconds"),
        F.max_by(duration, F.when(duration.isNotNull(), at)).alias("video_duration_seconds"),
    )


def with_processing_times(videos: DataFrame, run_log: DataFrame) -> DataFrame:
    """Update existing videos only. A zero duration leaves the old one."""
    old = [c for c in ("processing_seconds", "video_duration_seconds") if c in videos.columns]
    kept = videos.select(*[F.col(c).alias(f"_old_{c}") if c in old else F.col(c) for c in videos.columns])
    joined = kept.join(processing_times(run_log), KEY, "left")
    for c in old:
        joined = joined.withColumn(c, F.coalesce(c, f"_old_{c}")).drop(f"_old_{c}")
    return joined


def fold_tags(tag_log: DataFrame) -> DataFrame:
    """Newest tag list per video as comma-separated text; every save renews ``created_at``."""
    at = F.struct("ts", "event_id")
    return tag_log.groupBy(*KEY).agg(
        F.max_by(F.array_join("tags", ","), at).alias("tags"), F.max("ts").alias("created_at")
    )


def current_status(status_log: DataFrame) -> DataFrame:
    """The item in work: the newest event if it is a "set", else no row."""
    fields = [*KEY, "video_type", "action", "ts"]
    return (
        status_log.agg(F.max_by(F.struct(*fields), F.struct("ts", "event_id")).alias("_s"))
        .select("_s.*")
        .where(F.col("action") == "set")
        .select(
            *KEY, F.col("video_type").isin(EMBED, AUDIO).alias("is_embed"),
            (F.col("video_type") == AUDIO).alias("is_audio"), F.col("ts").alias("started_at"),
        )
    )
