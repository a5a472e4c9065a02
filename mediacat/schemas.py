"""Declared schemas (DDL) of the input tables; a missing field is a NULL column."""

from __future__ import annotations

CATALOG_LEGACY = (
    "owner string, permlink string, filename string, video_v2 string, status string,"
    " created timestamp_ntz, publish_data timestamp_ntz, description string"
)
CATALOG_EMBED = (
    "owner string, permlink string, manifest_cid string, status string, createdAt timestamp_ntz"
)
CATALOG_AUDIO = (
    "owner string, permlink string, audio_cid string, status string, createdAt timestamp_ntz"
)
RAW_SEGMENTS = (
    "author string, permlink string, raw_seg bigint, start_s double, end_s double, text string,"
    " words array<struct<word: string, start_s: double, end_s: double>>"
)
WORDS = (
    "author string, permlink string, raw_seg bigint, word_idx bigint, word string,"
    " start_s double, end_s double"
)
SEGMENTS = (
    "author string, permlink string, seg_idx bigint, start_s double, end_s double, text string"
)
SUBTITLE_LOG = (
    "author string, permlink string, video_type string, language string, video_cid string,"
    " subtitle_cid string, video_created_at timestamp_ntz, ts timestamp_ntz, event_id bigint"
)
TAG_LOG = (
    "author string, permlink string, tags array<string>, ts timestamp_ntz, event_id bigint"
)
RUN_LOG = (
    "author string, permlink string, source string, outcome string, processing_seconds int,"
    " video_duration_seconds int, ts timestamp_ntz, event_id bigint"
)
STATUS_LOG = (
    "author string, permlink string, video_type string, action string, ts timestamp_ntz,"
    " event_id bigint"
)
QUEUE = ("author string, permlink string, requested_at timestamp_ntz")
BLACKLIST = ("author string, permlink string, added_at timestamp_ntz")
AUTHOR_LIST = ("author string, added_at timestamp_ntz")
HOTWORDS = ("word string, added_at timestamp_ntz")
CORRECTIONS = ("ord int, from_text string, to_text string, added_at timestamp_ntz")
FETCH_ATTEMPTS = (
    "author string, permlink string, ord int, ok boolean, size_bytes bigint"
)
PROBE = (
    "streams array<struct<codec_type: string, codec_name: string>>,"
    " format struct<duration: string, size: string>"
)
