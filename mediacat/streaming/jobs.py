"""Streams over the same tables the batch jobs read.

Every job drains what is there and stops (``availableNow``); its checkpoint remembers
what has been read, so the next start picks up new files only. Nothing is dropped for
being late. Work that needs whole videos or merged state runs on complete micro-batches
and is keyed by batch id, so a repeated batch replaces its own earlier output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordered import position
from ..operators.selection import work_order_columns, work_rank
from ..sinks.subtitles import as_state, fold
from ..sources.catalog import KEY, videos_since
from ..sources.tables import Language, codes


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream. The declared schema is needed: streams do not infer one."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(stream: DataFrame, checkpoint: str, mode: str, each: Callable[[DataFrame, int], None]) -> None:
    """Run ``each`` on all waiting micro-batches, then stop."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .foreachBatch(each).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _keep(base: str):
    """Writer that gives each batch a folder of its own; a repeat overwrites it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")

    return write


def _kept(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base)


def ingest_catalogs(
    legacy: DataFrame, embed: DataFrame, audio: DataFrame, now: datetime, base: str,
    start: datetime | None = None, embed_start: datetime | None = None,
) -> DataFrame:
    """Pick up new catalog rows; the checkpoint takes the place of a date cursor. The file
    sink commits each batch exactly once."""
    spark = legacy.sparkSession
    found = videos_since(legacy, embed, audio, now, start, embed_start)
    query = (
        found.writeStream.outputMode("append").format("parquet").option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{base}/rows")


def open_work(
    stream: DataFrame, subtitles: DataFrame, languages: Sequence[Language], base: str
) -> DataFrame:
    """Catalog rows that still lack a configured language, whenever they arrive.

    ``subtitles`` holds one row per (video, language). A late row is compared with it
    like any other; there is no watermark to fall behind.
    """
    wanted = codes(languages)

    def choose(batch: DataFrame, batch_id: int) -> None:
        done = (
            subtitles.where(F.col("language").isin(*wanted)).select(*KEY, "language").distinct()
            .groupBy(*KEY).count().where(F.col("count") == len(set(wanted))).select(*KEY)
        )
        _keep(f"{base}/rows")(batch.join(done, KEY, "left_anti"), batch_id)

    drain(stream, f"{base}/checkpoint", "append", choose)
    return _kept(stream.sparkSession, f"{base}/rows").drop("batch_id")


def upsert_subtitles(log: DataFrame, base: str) -> DataFrame:
    """Fold each micro-batch of saves and keep the folded part; current rows are the fold
    of all parts. Delivering rows again, or late, changes nothing: the fold is
    associative, commutative and idempotent."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        _keep(f"{base}/parts")(fold(as_state(batch)), batch_id)

    drain(log, f"{base}/checkpoint", "append", merge)
    return fold(_kept(log.sparkSession, f"{base}/parts").drop("batch_id"))


def compact(spark: SparkSession, base: str, target: str) -> None:
    """Write the fold of all parts as one part of a new folder."""
    fold(_kept(spark, f"{base}/parts").drop("batch_id")).write.mode("overwrite").parquet(
        f"{target}/parts/batch_id=-1"
    )


def dedup_queue(requests: DataFrame, catalogs: DataFrame, base: str) -> DataFrame:
    """First appearance of each requested key that a catalog knows (keyed state in the
    state store, spread by key)."""
    fresh = requests.select(*KEY).dropDuplicates(KEY)

    def accept(batch: DataFrame, batch_id: int) -> None:
        known = catalogs.select(*KEY).join(batch, KEY, "left_semi").distinct()
        _keep(f"{base}/rows")(batch.join(known, KEY, "left_semi"), batch_id)

    drain(fresh, f"{base}/checkpoint", "append", accept)
    return _kept(requests.sparkSession, f"{base}/rows").drop("batch_id")


def completion(log: DataFrame, languages: Sequence[Language], base: str) -> DataFrame:
    """Languages finished per video, kept up to date as saves arrive.

    State per video is one flag per configured language, so its size does not depend on
    how often a video is saved.
    """
    wanted = codes(languages)
    flags = [F.max(F.col("language") == code).alias(f"has_{i}") for i, code in enumerate(wanted)]
    done = sum((F.col(f"has_{i}").cast("int") for i in range(len(wanted))), F.lit(0))
    progress = log.groupBy(*KEY).agg(*flags).select(
        *KEY, done.cast("bigint").alias("n_done"), (done == len(wanted)).alias("is_complete")
    )
    drain(progress, f"{base}/checkpoint", "update", _keep(f"{base}/rows"))
    rows = _kept(log.sparkSession, f"{base}/rows")
    latest = F.max_by(F.struct("n_done", "is_complete"), "batch_id").alias("_l")
    return rows.groupBy(*KEY).agg(latest).select(*KEY, "_l.*")


def prioritised_work(
    requests: DataFrame, candidates: DataFrame, catalogs: DataFrame, creators: DataFrame, base: str
) -> DataFrame:
    """The work list: requested items first, oldest request first, then the candidates in
    work order. ``bucket`` is 0 for requested items, ``position`` the place in the list.

    The stream keeps only the requests; they are joined with the candidates once, whatever
    the number of micro-batches.
    """
    drain(requests.select(*KEY, "requested_at"), f"{base}/checkpoint", "append", _keep(f"{base}/requests"))
    kept = _kept(requests.sparkSession, f"{base}/requests")
    # The size of the stored requests is that of packed files, far below that of their rows: they are not broadcast.
    asked = kept.groupBy(*KEY).agg(F.min("requested_at").alias("requested_at"))
    known = catalogs.select(*KEY).join(asked.select(*KEY).hint("merge"), KEY, "left_semi").distinct()
    ahead = asked.join(known.hint("merge"), KEY).withColumn("bucket", F.lit(0))
    behind = work_rank(candidates, creators).join(asked.select(*KEY).hint("merge"), KEY, "left_anti").withColumn("bucket", F.lit(1))
    rows = ahead.unionByName(behind, allowMissingColumns=True)
    order = [F.col("bucket"), F.asc_nulls_last("requested_at"), *work_order_columns()]
    return position(rows, order, "position").select(
        *KEY, "bucket", "requested_at", "prio_rank", "type_rank", "status_rank", "created_at", "position"
    )


def live_counts(
    log: DataFrame, unit: Sequence[str], by: Sequence[str], base: str, refresh_seconds: int | None = None
) -> DataFrame | StreamingQuery:
    """Number of distinct units per group, kept current as saves arrive.

    Units (video, language) by language give subtitle files per language; units (video) by
    type give processed videos per type. A unit counts once, with the group of its first
    save. With ``refresh_seconds`` the job keeps running at that rate; otherwise it
    drains and stops. Each batch adds its own small counts.
    """
    fields = [*unit, *[c for c in by if c not in unit]]
    first = log.select(*fields).dropDuplicates(list(unit))

    def add(batch: DataFrame, batch_id: int) -> None:
        _keep(f"{base}/parts")(batch.groupBy(*by).agg(F.count("*").alias("n")), batch_id)

    writer = (
        first.writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint")
        .foreachBatch(add)
    )
    if refresh_seconds is not None:
        return writer.trigger(processingTime=f"{refresh_seconds} seconds").start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return read_live_counts(log.sparkSession, base, by)


def read_live_counts(spark: SparkSession, base: str, by: Sequence[str]) -> DataFrame:
    return _kept(spark, f"{base}/parts").groupBy(*by).agg(F.sum("n").alias("n"))
