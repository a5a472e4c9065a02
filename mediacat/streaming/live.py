"""Queue, subtitle state and totals as streams of events that undo earlier ones.

An event that cuts (a queue item is taken, a video's subtitles are deleted) undoes what
happened to its key before it, whatever the order in which the two arrive. Events are kept
in a :class:`..sinks.part_store.PartStore` and compared by moment and sequence, so any split into
batches gives the rows the batch form gives.

``lateness`` bounds how long after a newer event a cut may arrive. Events older than that
bound can then only be undone together, so they are folded to their first and last; without
it (the default) all events since the newest cut stay apart. A cut that breaks the promise is
not applied and goes to ``late`` beside the store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import AUDIO, EMBED, LEGACY
from ..sinks.lists import with_existence
from ..sinks.subtitles import STATE, as_state, fold
from ..sources.catalog import KEY
from ..sinks.part_store import Manifest, PartStore

ASKED, TAKEN = "asked", "taken"
QUEUE_EVENTS = "author string, permlink string, kind string, at timestamp_ntz"

SAVE, GONE, TAG, OFFER = "save", "gone", "tag", "offer"
STATE_EVENTS = (
    "author string, permlink string, kind string, language string, subtitle_cid string, video_cid string, updated_at timestamp_ntz, "
    "updated_seq long, video_type string, video_created_at timestamp_ntz, created_at timestamp_ntz, created_seq long"
)
SEPARATOR = "/"


def _old(moment: Column, seen, lateness: timedelta | None) -> Column:
    """Whether no cut that may still arrive can part events of that moment."""
    if lateness is None or seen is None:
        return F.lit(False)
    return F.coalesce(moment < F.lit((seen - lateness).isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(False))


def _without_undone(rows: DataFrame, cuts: DataFrame, at: Column, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows after the newest cut of their key; ``cuts`` has one row for each key with ``_cut``."""
    return rows.join(cuts, list(keys), "left").where(F.col("_cut").isNull() | (at > F.col("_cut"))).drop("_cut")


def _promised(batch: DataFrame, is_cut: Column, moment: Column, seen, lateness, base: str, batch_id: int) -> DataFrame:
    """The batch without cuts that come too late, which are kept for review."""
    if lateness is None or seen is None:
        return batch
    late = is_cut & _old(moment, seen, lateness)
    batch.where(late).write.mode("overwrite").parquet(f"{base}/late/batch_id={batch_id}")
    return batch.where(~late)


def _run(stream: DataFrame, base: str, each: Callable[[DataFrame, int], None], refresh_seconds: int | None):
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(each)
    if refresh_seconds is not None:
        return writer.trigger(processingTime=f"{refresh_seconds} seconds").start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return None


class LiveQueue:
    """The queue that enqueue and dequeue events leave, after every batch."""

    def __init__(self, spark: SparkSession, base: str, lateness: timedelta | None = None):
        self.base, self.lateness = base, lateness
        self.store = PartStore(spark, base, QUEUE_EVENTS, self._thin)

    @staticmethod
    def _cuts(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("kind") == TAKEN).groupBy(*KEY).agg(F.max("at").alias("_cut"))

    def _thin(self, rows: DataFrame, live: DataFrame, now: Manifest) -> DataFrame:
        asked = _without_undone(rows.where(F.col("kind") == ASKED), self._cuts(live), F.col("at"))
        old = _old(F.col("at"), now.seen, self.lateness)
        # Of old requests the earliest decides, or none; of the others any may.
        kept = asked.groupBy(*KEY, "kind", F.when(~old, F.col("at")).alias("_own")).agg(F.min("at").alias("at")).drop("_own")
        taken = self._cuts(rows).select(*KEY, F.lit(TAKEN).alias("kind"), F.col("_cut").alias("at"))
        return kept.unionByName(taken)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.store.newest.version:
            return
        seen = self.store.newest.seen
        batch = _promised(batch, F.col("kind") == TAKEN, F.col("at"), seen, self.lateness, self.base, batch_id)
        self.store.commit(batch, batch_id, batch.agg(F.max("at")).first()[0])

    def entries(self) -> DataFrame:
        """(author, permlink, requested_at) of what waits."""
        rows = self.store.rows()
        waiting = _without_undone(rows.where(F.col("kind") == ASKED), self._cuts(rows), F.col("at"))
        return waiting.groupBy(*KEY).agg(F.min("at").alias("requested_at"))


def queue_events(requests: DataFrame, taken: DataFrame) -> DataFrame:
    """Requests (``requested_at``) and removals (``taken_at``) as one stream."""
    return requests.select(*KEY, F.lit(ASKED).alias("kind"), F.col("requested_at").alias("at")).unionByName(
        taken.select(*KEY, F.lit(TAKEN).alias("kind"), F.col("taken_at").alias("at")))


def live_queue(
    requests: DataFrame, taken: DataFrame, catalogs: DataFrame, base: str, include_audio: bool = False,
    lateness: timedelta | None = None, refresh_seconds: int | None = None,
):
    """Keep the queue as requests and removals arrive.

    A request is refused when no catalog knows its key, or audio catalogs alone do unless
    ``include_audio`` is set; refused requests are kept in ``refused`` beside the store. A key
    that was taken may be asked for again and waits from that request on. With
    ``refresh_seconds`` the running query is returned, else the queue once all is read.
    """
    queue = LiveQueue(requests.sparkSession, base, lateness)

    def accept(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= queue.store.newest.version:
            return
        asked = with_existence(batch.where(F.col("kind") == ASKED), catalogs, include_audio)
        asked.where("not exists").drop("exists").write.mode("overwrite").parquet(f"{base}/refused/batch_id={batch_id}")
        queue.add(batch.where(F.col("kind") == TAKEN).unionByName(asked.where("exists").drop("exists")), batch_id)

    running = _run(queue_events(requests, taken), base, accept, refresh_seconds)
    return running if running is not None else queue


class LiveState:
    """Subtitle state, and totals over it, after every batch of saves, deletions, tags and offers."""

    def __init__(self, spark: SparkSession, base: str, lateness: timedelta | None = None, totals: bool = True):
        self.base, self.lateness, self.counted = base, lateness, totals
        self.store = PartStore(spark, base, STATE_EVENTS, self._thin)

    @staticmethod
    def _cuts(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
        gone = rows.where(F.col("kind") == GONE)
        return gone.groupBy(*keys).agg(F.max(F.struct("created_at", "created_seq")).alias("_cut"))

    @staticmethod
    def _saves(rows: DataFrame, cuts: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
        """Saves that no deletion has undone. A record saved again after one is a new record."""
        return _without_undone(rows.where(F.col("kind") == SAVE), cuts, F.struct("created_at", "created_seq"), keys)

    def _thin(self, rows: DataFrame, live: DataFrame, now: Manifest) -> DataFrame:
        saves = self._saves(rows, self._cuts(live))
        old = _old(F.col("updated_at"), now.seen, self.lateness)
        folded = fold(saves.where(old)).withColumn("kind", F.lit(SAVE))
        apart = saves.where(~old).select(*folded.columns).dropDuplicates([*KEY, "language", "created_seq", "updated_seq"])
        gone = self._cuts(rows).select(*KEY, F.lit(GONE).alias("kind"), "_cut.*")
        rest = rows.where(F.col("kind").isin(TAG, OFFER)).select(*KEY, "kind", "video_type").distinct()
        return (folded.unionByName(apart).unionByName(gone, allowMissingColumns=True)
                .unionByName(rest, allowMissingColumns=True))

    def _change(self, before: DataFrame, new: DataFrame) -> dict[str, int]:
        """What the keys of a batch count for after it, less what they counted for before.

        Both sides are counted together: a known row stands on both, a new one on the later.
        A measure is a name and a type or language.
        """
        keys = [*KEY, "side"]
        known = before.join(new.select(*KEY).distinct(), KEY, "left_semi").withColumn("side", F.explode(F.array(F.lit(-1), F.lit(1))))
        rows = known.unionByName(new.withColumn("side", F.lit(1)))
        saves = self._saves(rows, self._cuts(rows, keys), keys)
        # One row for each video, with its languages (as many as are configured) and the catalogs that offer it.
        first = saves.groupBy(*keys).agg(
            F.coalesce(F.min_by("video_type", F.struct("created_at", "created_seq")), F.lit(LEGACY)).alias("of"),
            F.collect_set("language").alias("languages"))
        offers = rows.where(F.col("kind") == OFFER).groupBy(*keys).agg(F.collect_set("video_type").alias("offered"))
        tagged = rows.where(F.col("kind") == TAG).select(*keys).distinct()
        one = lambda name, of, n: F.struct(F.lit(name).alias("name"), of.alias("of"), n.cast("long").alias("n"))
        made = F.when(F.col("of").isNotNull(), F.concat(
            F.array(one("processed", F.col("of"), F.lit(1)), one("subtitles", F.col("of"), F.size("languages"))),
            F.transform("languages", lambda code: one("language", code, F.lit(1)))))
        offered = F.when(F.col("offered").isNotNull(), F.concat(
            F.transform("offered", lambda kind: one("available", kind, F.lit(1))),
            F.transform("offered", lambda kind: one("open", kind, F.col("of").isNull()))))
        both = first.join(offers, keys, "full").select("side", F.array(made, offered).alias("_m"))
        counted = both.select("side", F.explode(F.flatten(F.filter("_m", lambda m: m.isNotNull()))).alias("_m")).select("side", "_m.*")
        counted = counted.unionByName(tagged.select("side", F.lit("tagged").alias("name"), F.lit("").alias("of"), F.lit(1).cast("long").alias("n")))
        change = counted.groupBy(F.concat_ws(SEPARATOR, "name", "of").alias("measure")).agg(F.sum(F.col("n") * F.col("side")).alias("n")).where("n <> 0")
        return {r["measure"]: r["n"] for r in change.collect()}  # a row for each type and language

    def add(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.store.newest.version:
            return
        seen = self.store.newest.seen
        batch = _promised(batch, F.col("kind") == GONE, F.col("created_at"), seen, self.lateness, self.base, batch_id)
        newest = batch.agg(F.max("created_at")).first()[0]
        self.store.commit(batch, batch_id, newest, self._change if self.counted else None)

    def subtitles(self) -> DataFrame:
        """Current row of each (video, language), as :func:`..sinks.subtitles.fold` gives it."""
        rows = self.store.rows()
        return fold(self._saves(rows, self._cuts(rows)).select(*STATE))

    def measure(self, name: str, column: str, schema: str = "string") -> DataFrame:
        """One kind of running total as rows (``column``, n); groups of none are left out."""
        totals = self.store.newest.totals
        rows = [(k.split(SEPARATOR, 1)[1], n) for k, n in sorted(totals.items()) if k.startswith(name + SEPARATOR) and n]
        return self.store.spark.createDataFrame(rows, f"{column} {schema}, n long")

    def totals(self) -> DataFrame:
        """The one row of totals that ``plans.monitoring.stats_summary`` computes from whole tables."""
        held = self.store.newest.totals
        of = lambda name, kind: held.get(f"{name}{SEPARATOR}{kind}", 0)
        kinds = (LEGACY, EMBED, AUDIO)
        pending = {k: max(0, of("available", k) - of("processed", k)) for k in kinds}
        row = {
            "total_processed": sum(of("processed", k) for k in kinds), "total_subtitles": sum(of("subtitles", k) for k in kinds),
            "total_tagged": of("tagged", ""), "total_available": sum(of("available", k) for k in kinds),
            **{f"total_{k}": of("available", k) for k in kinds}, **{f"processed_{k}": of("processed", k) for k in kinds},
            "pending": sum(pending.values()), **{f"pending_{k}": pending[k] for k in kinds},
        }
        return self.store.spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} long" for c in row))


def state_events(saves: DataFrame, deletions: DataFrame | None = None, tags: DataFrame | None = None, offers: DataFrame | None = None) -> DataFrame:
    """Saves, deletions (``ts``, ``event_id``), tagged videos and available videos as one stream.

    A video that arrives again as available, or as tagged, counts once.
    """
    out = as_state(saves).withColumn("kind", F.lit(SAVE))
    if deletions is not None:
        out = out.unionByName(deletions.select(
            *KEY, F.lit(GONE).alias("kind"), F.col("ts").alias("created_at"), F.col("event_id").alias("created_seq")), allowMissingColumns=True)
    if tags is not None:
        out = out.unionByName(tags.select(*KEY, F.lit(TAG).alias("kind")), allowMissingColumns=True)
    if offers is not None:
        out = out.unionByName(offers.select(*KEY, F.lit(OFFER).alias("kind"), "video_type"), allowMissingColumns=True)
    return out


def live_state(events: DataFrame, base: str, lateness: timedelta | None = None, totals: bool = True, refresh_seconds: int | None = None):
    """Keep subtitle state and totals as ``events`` (:func:`state_events`) arrive.

    With ``refresh_seconds`` the running query is returned, else the state once all is read.
    """
    state = LiveState(events.sparkSession, base, lateness, totals)
    running = _run(events, base, state.add, refresh_seconds)
    return running if running is not None else state
