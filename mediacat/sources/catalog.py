"""Scans of the three catalogs, as one canonical row form.

Predicates are plain comparisons on stored columns, so they reach the parquet scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    AUDIO, CID_SCHEME, EMBED, LEGACY, LOOKUP_RANK, PUBLISHED, SCHEDULED,
)
from ..functions.text import filled

KEY = ["author", "permlink"]


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _at_least(column: str, moment: datetime | None) -> Column:
    return F.lit(True) if moment is None else F.col(column) >= _ntz(moment)


def _canonical(rows: DataFrame, video_type: str, created: str) -> DataFrame:
    def maybe(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    return rows.select(
        F.coalesce("owner", F.lit("unknown")).alias("author"),
        F.coalesce("permlink", F.lit("unknown")).alias("permlink"),
        F.lit(video_type).alias("video_type"),
        "status",
        F.col(created).alias("created_at"),
        maybe("filename").alias("filename"),
        maybe("video_v2").alias("video_v2"),
        maybe("manifest_cid").alias("manifest_cid"),
        maybe("audio_cid").alias("audio_cid"),
        maybe("description").alias("description"),
    )


def legacy_published(legacy: DataFrame, start: datetime | None = None) -> DataFrame:
    return legacy.where(
        F.col("filename").startswith(CID_SCHEME)
        & (F.col("status") == PUBLISHED)
        & _at_least("created", start)
    )


def legacy_scheduled(legacy: DataFrame, now: datetime) -> DataFrame:
    """Rows that will be published later; the creation date does not bound them."""
    return legacy.where(
        F.col("filename").startswith(CID_SCHEME)
        & (F.col("status") == SCHEDULED)
        & (F.col("publish_data") > _ntz(now))
    )


def legacy_open(legacy: DataFrame, start: datetime | None, now: datetime) -> DataFrame:
    """Published since ``start`` or scheduled after ``now``, in one scan."""
    published = (F.col("status") == PUBLISHED) & _at_least("created", start)
    scheduled = (F.col("status") == SCHEDULED) & (F.col("publish_data") > _ntz(now))
    return legacy.where(F.col("filename").startswith(CID_SCHEME) & (published | scheduled))


def embed_published(embed: DataFrame, start: datetime | None = None) -> DataFrame:
    return embed.where(
        filled(F.col("manifest_cid")) & (F.col("status") == PUBLISHED) & _at_least("createdAt", start)
    )


def audio_published(audio: DataFrame, start: datetime | None = None) -> DataFrame:
    return audio.where(
        filled(F.col("audio_cid")) & (F.col("status") == PUBLISHED) & _at_least("createdAt", start)
    )


def _union(legacy: DataFrame, embed: DataFrame, audio: DataFrame) -> DataFrame:
    return (
        _canonical(legacy, LEGACY, "created")
        .unionByName(_canonical(embed, EMBED, "createdAt"))
        .unionByName(_canonical(audio, AUDIO, "createdAt"))
    )


def videos_since(
    legacy: DataFrame, embed: DataFrame, audio: DataFrame, now: datetime,
    start: datetime | None = None, embed_start: datetime | None = None,
) -> DataFrame:
    """Candidates of a pass. Embed and audio have their own bound, so that an
    advancing cursor does not skip late rows; it defaults to ``start``."""
    other = embed_start or start
    return _union(
        legacy_open(legacy, start, now), embed_published(embed, other), audio_published(audio, other)
    )


def all_videos(legacy: DataFrame, embed: DataFrame, audio: DataFrame, now: datetime) -> DataFrame:
    return videos_since(legacy, embed, audio, now)


def available(
    legacy: DataFrame, embed: DataFrame, audio: DataFrame, start: datetime | None = None
) -> DataFrame:
    """Published rows only, one bound for all three: what the monitoring view counts."""
    return _union(
        legacy_published(legacy, start), embed_published(embed, start), audio_published(audio, start)
    )


def everything(legacy: DataFrame, embed: DataFrame, audio: DataFrame) -> DataFrame:
    """All rows of all catalogs, without any status or content-id test."""
    return _union(legacy, embed, audio)


def by_creation(videos: DataFrame) -> DataFrame:
    """Creation order with a missing date first; ties by catalog, then key."""
    return videos.orderBy(F.asc_nulls_first("created_at"), catalog_rank(), *KEY)


def catalog_rank(column: str = "video_type") -> Column:
    ranked = F.lit(len(LOOKUP_RANK))
    for name, rank in LOOKUP_RANK.items():
        ranked = F.when(F.col(column) == name, rank).otherwise(ranked)
    return ranked


def lookup(videos: DataFrame, keys: DataFrame) -> DataFrame:
    """The row of each wanted key by catalog precedence; ``found`` is false if none.

    The semi join thins the catalogs to wanted keys before anything is grouped, and
    copies of a key collapse before the shuffle.
    """
    fields = [c for c in videos.columns if c not in KEY]
    wanted = keys.select(*KEY).distinct()
    best = (
        videos.join(wanted, KEY, "left_semi")
        .groupBy(*KEY)
        .agg(F.min_by(F.struct(*fields), F.struct(catalog_rank(), F.coalesce("status", F.lit("")),
                                                  F.coalesce("created_at", _ntz(datetime(1, 1, 1)))
                                                  )).alias("_row"))
        .select(*KEY, *[F.col(f"_row.{c}").alias(c) for c in fields])
    )
    return wanted.join(best, KEY, "left").withColumn("found", F.col("video_type").isNotNull())
