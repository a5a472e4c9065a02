"""What to work on: content ids, fetch routes, cursors, exclusions and order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.fixed_values import (
    AUDIO, CID_SCHEME, EMBED, LEGACY, MANIFEST_SUFFIX, PUBLISHED, WORK_TYPE_RANK,
)
from ..functions.text import filled, strip, without_prefix, without_suffix
from ..sources.catalog import KEY, catalog_rank
from .ordered import join_list, position


def type_flags(video_type: str = "video_type") -> list[Column]:
    kind = F.coalesce(F.col(video_type), F.lit(LEGACY))
    return [kind.isin(EMBED, AUDIO).alias("is_embed"), (kind == AUDIO).alias("is_audio")]


def resolve_cids(videos: DataFrame) -> DataFrame:
    """Add ``cid`` and ``hls_cid``; a missing id is NULL, never empty."""
    kind = F.col("video_type")
    own = (
        F.when(kind == AUDIO, F.col("audio_cid"))
        .when(kind == EMBED, F.col("manifest_cid"))
        .otherwise(without_prefix(F.col("filename"), CID_SCHEME))
    )
    manifest = without_suffix(without_prefix(F.col("video_v2"), CID_SCHEME), MANIFEST_SUFFIX)
    return videos.withColumn("cid", F.nullif(own, F.lit(""))).withColumn(
        "hls_cid", F.when(kind == LEGACY, F.nullif(manifest, F.lit("")))
    )


def fetch_plan(videos: DataFrame) -> DataFrame:
    """Route (skip, hls or direct), the id to fetch and the local file name."""
    planned = resolve_cids(videos)
    missing = F.col("cid").isNull() & F.col("hls_cid").isNull()
    hls = (F.col("video_type") == EMBED) | F.col("hls_cid").isNotNull()
    planned = planned.withColumn(
        "route", F.when(missing, "skip").when(hls, "hls").otherwise("direct")
    ).withColumn("fetch_cid", F.coalesce("hls_cid", "cid"))
    name = F.concat("author", F.lit("_"), "permlink", F.lit("_"), F.substring("fetch_cid", 1, 8), F.lit(".mp4"))
    return planned.withColumn("local_name", name)


def parse_refs(refs: DataFrame, ref: str = "ref") -> DataFrame:
    """``author/permlink`` references; later slashes stay in the permlink."""
    clean = strip(F.col(ref))
    parts = F.split(clean, "/", 2)
    author, permlink = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    good = clean.contains("/") & (author != "") & (permlink != "")
    return refs.select(
        "*",
        F.when(good, author).alias("author"),
        F.when(good, permlink).alias("permlink"),
        F.when(F.coalesce(good, F.lit(False)), F.lit(None)).otherwise("bad_format").alias("reason"),
    )


def effective_cursor(headers: DataFrame, start_text: str) -> DataFrame:
    """One row: the start date, the newest processed creation date, the later of the two."""
    start = parse_date(F.lit(start_text))
    return headers.agg(F.max("video_created_at").alias("last_processed")).select(
        start.alias("start_date"), "last_processed",
        F.greatest(start, F.col("last_processed")).alias("effective_start"),
    )


def cursor_value(headers: DataFrame, start_text: str) -> datetime | None:
    """The cursor as a literal, so that it can be pushed into the catalog scans."""
    return effective_cursor(headers, start_text).first()["effective_start"]


def without_blacklisted(videos: DataFrame, authors: DataFrame, items: DataFrame) -> DataFrame:
    """Two anti joins. Rows of a popular author are salted; (author, permlink) is not. Neither list is broadcast."""
    allowed = join_list(videos, authors.select("author").distinct(), "author", ["permlink"], "left_anti")
    return allowed.join(items.select(*KEY).hint("merge"), KEY, "left_anti")


def flag_creators(videos: DataFrame, creators: DataFrame) -> DataFrame:
    listed = creators.select("author").distinct().withColumn("_listed", F.lit(True))
    return (
        join_list(videos, listed, "author", ["permlink"], "left")
        .withColumn("is_priority", F.coalesce("_listed", F.lit(False)))
        .drop("_listed")
    )


def _type_rank() -> Column:
    kind = F.lit(WORK_TYPE_RANK["audio"])
    for name, rank in WORK_TYPE_RANK.items():
        kind = F.when(F.col("video_type") == name, rank).otherwise(kind)
    return kind


def _status_rank() -> Column:
    return F.when(F.coalesce(F.col("status") == PUBLISHED, F.lit(False)), 0).otherwise(1)


def one_per_key(videos: DataFrame) -> DataFrame:
    """Of the rows of a key in several catalogs, the one that comes first in work order.

    A key has at most a row or two in each catalog, so its window is small.
    """
    first = W.partitionBy(*KEY).orderBy(_type_rank(), _status_rank(), F.asc_nulls_first("created_at"), catalog_rank())
    return videos.withColumn("_first", F.row_number().over(first)).where("_first = 1").drop("_first")


def work_rank(videos: DataFrame, creators: DataFrame) -> DataFrame:
    """Add the three sort ranks: creator, catalog, published."""
    return (
        flag_creators(videos, creators)
        .withColumn("prio_rank", F.when(F.col("is_priority"), 0).otherwise(1))
        .withColumn("type_rank", _type_rank())
        .withColumn("status_rank", _status_rank())
    )


def work_order_columns() -> list[Column]:
    return [
        F.col("prio_rank"), F.col("type_rank"), F.col("status_rank"),
        F.asc_nulls_first("created_at"), catalog_rank(), F.col("author"), F.col("permlink"),
    ]


def work_order(videos: DataFrame, creators: DataFrame) -> DataFrame:
    """All candidates in work order (one global sort)."""
    return work_rank(videos, creators).orderBy(*work_order_columns())


def work_positions(videos: DataFrame, creators: DataFrame) -> DataFrame:
    """As :func:`work_order`, with the position of every row."""
    return position(work_rank(videos, creators), work_order_columns(), "position")


def has_cid(column: str) -> Column:
    return filled(F.col(column))
