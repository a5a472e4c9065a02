"""Keyed lists: the queue and the moderation lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import AUDIO, EMBED
from ..operators.ordered import position
from ..sources.catalog import KEY, lookup


def item_id(keys: Sequence[str]):
    """Stable id of a list entry: a hash of its key."""
    return F.sha2(F.concat_ws("\x1f", *keys), 256)


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], at: str = "added_at"
) -> DataFrame:
    """Rows to append: the earliest request of each key the list does not hold."""
    rest = [c for c in incoming.columns if c not in [*keys, at]]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(at, *rest), F.struct(at, *rest)).alias("_r"))
    return (
        first.select(*keys, "_r.*")
        .join(existing.select(*keys).distinct(), list(keys), "left_anti")
        .select(*incoming.columns)
    )


def delete_by_id(rows: DataFrame, ids: DataFrame, id_column: str = "item_id") -> DataFrame:
    return rows.join(ids.select(id_column).distinct(), id_column, "left_anti")


def deletion_report(rows: DataFrame, ids: DataFrame, id_column: str = "item_id") -> DataFrame:
    """Each requested id and whether the list held it."""
    held = rows.select(id_column).distinct().withColumn("_held", F.lit(True))
    return (
        ids.select(id_column).distinct().join(held, id_column, "left")
        .select(id_column, F.coalesce("_held", F.lit(False)).alias("deleted"))
    )


def oldest_first(rows: DataFrame, keys: Sequence[str], at: str = "requested_at") -> DataFrame:
    return rows.orderBy(F.asc(at), *keys)


def newest_first(rows: DataFrame, keys: Sequence[str], at: str = "added_at") -> DataFrame:
    return rows.orderBy(F.desc(at), *keys)


def with_existence(requests: DataFrame, catalogs: DataFrame, include_audio: bool) -> DataFrame:
    """Flag keys that a catalog holds; audio-only items count when asked for."""
    known = catalogs if include_audio else catalogs.where(F.col("video_type") != AUDIO)
    wanted = requests.select(*KEY).distinct()
    found = (
        known.select(*KEY).join(wanted, KEY, "left_semi").distinct().withColumn("_found", F.lit(True))
    )
    return (
        requests.join(found, KEY, "left")
        .withColumn("exists", F.coalesce("_found", F.lit(False))).drop("_found")
    )


def enqueue(
    requests: DataFrame, catalogs: DataFrame, queue: DataFrame, include_audio: bool = False
) -> DataFrame:
    """Outcome of each requested key: accepted, not_found or duplicate.

    Requests of one key collapse first: the earliest is the one that counts, and
    ``n_requests`` tells how many there were (all but the first are duplicates).
    """
    keyed = requests.groupBy(*KEY).agg(
        F.min("requested_at").alias("requested_at"), F.count("*").alias("n_requests")
    )
    queued = queue.select(*KEY).distinct().withColumn("_queued", F.lit(True))
    outcome = (
        F.when(~F.col("exists"), "not_found").when(F.col("_queued"), "duplicate").otherwise("accepted")
    )
    return (
        with_existence(keyed, catalogs, include_audio)
        .join(queued, KEY, "left").withColumn("outcome", outcome).drop("_queued", "exists")
    )


def current_queue(requests: DataFrame, taken: DataFrame) -> DataFrame:
    """The queue that enqueue events (``requested_at``) and dequeue events (``taken_at``) leave.

    An entry is the earliest request after its key was last taken, so a key may be asked
    for again, and events may come in any order.
    """
    last = taken.groupBy(*KEY).agg(F.max("taken_at").alias("_taken"))
    waiting = requests.join(last, KEY, "left").where(F.col("_taken").isNull() | (F.col("requested_at") > F.col("_taken")))
    return waiting.groupBy(*KEY).agg(F.min("requested_at").alias("requested_at"))


def pop_oldest(queue: DataFrame) -> DataFrame:
    """The one entry a worker takes next."""
    return queue.orderBy("requested_at", *KEY).limit(1)


def after_pop(queue: DataFrame) -> DataFrame:
    """The queue without the entry :func:`pop_oldest` gives (one row, so broadcast)."""
    taken = pop_oldest(queue).select(*KEY, "requested_at")
    return queue.join(F.broadcast(taken), [*KEY, "requested_at"], "left_anti")


def drain(queue: DataFrame, catalogs: DataFrame) -> DataFrame:
    """The whole queue in the order it is taken, resolved against the catalogs; an entry
    no catalog knows is kept with ``found`` false and does not hold up the others."""
    placed = position(queue, [F.col("requested_at"), *[F.col(k) for k in KEY]], "queue_pos")
    return placed.join(lookup(catalogs, queue), KEY, "left")


def queue_flags(queue: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Whether each entry is an audio item, and whether it is an embed item (audio counts)."""
    kinds = (
        catalogs.where(F.col("video_type").isin(EMBED, AUDIO))
        .join(queue.select(*KEY).distinct(), KEY, "left_semi")
        .groupBy(*KEY).agg(F.bool_or(F.col("video_type") == AUDIO).alias("_audio"))
    )
    return (
        queue.join(kinds, KEY, "left")
        .withColumn("is_embed", F.col("_audio").isNotNull())
        .withColumn("is_audio", F.coalesce("_audio", F.lit(False)))
        .drop("_audio")
    )


def reprocess(
    requests: DataFrame, subtitles: DataFrame, tags: DataFrame, queue: DataFrame
) -> dict[str, DataFrame]:
    """Cascade of a redo request: what is left of subtitles and tags, what to append to
    the queue, and a report with ``deleted`` and ``enqueued`` per requested key."""
    asked = requests.groupBy(*KEY).agg(F.min("requested_at").alias("requested_at"))
    had = subtitles.select(*KEY).join(asked.select(*KEY), KEY, "left_semi").distinct()
    report = (
        asked.join(had.withColumn("_had", F.lit(True)), KEY, "left")
        .join(queue.select(*KEY).distinct().withColumn("_queued", F.lit(True)), KEY, "left")
        .select(
            *KEY, "requested_at", F.coalesce("_had", F.lit(False)).alias("deleted"),
            F.col("_queued").isNull().alias("enqueued"),
        )
    )
    return {
        "subtitles": subtitles.join(asked.select(*KEY), KEY, "left_anti"),
        "tags": tags.join(asked.select(*KEY), KEY, "left_anti"),
        "queue": report.where("enqueued").select(*KEY, "requested_at"),
        "report": report,
    }
