"""Queue, state and totals that events in any order and split keep current."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from mediacat.plans import monitoring
from mediacat.sinks.lists import current_queue
from mediacat.sinks.subtitles import after_deletions, as_state, fold, headers
from mediacat.streaming import jobs, live
from mediacat.sinks.part_store import PartStore

KEY = ["author", "permlink"]
CATALOG = "author string, permlink string, video_type string"
SAVES = ("author string, permlink string, video_type string, language string, video_cid string, subtitle_cid string, "
         "video_created_at timestamp_ntz, ts timestamp_ntz, event_id long")
EVENTS = "author string, permlink string, ts timestamp_ntz, event_id long"


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


def queue_frame(spark, rows):
    return spark.createDataFrame(rows, live.QUEUE_EVENTS)


def want_queue(spark, rows):
    frame = queue_frame(spark, rows)
    asked = frame.where("kind = 'asked'").withColumnRenamed("at", "requested_at").drop("kind")
    return rows_of(current_queue(asked, frame.where("kind = 'taken'").withColumnRenamed("at", "taken_at").drop("kind")))


@pytest.mark.parametrize("seed", [1])
def test_queue_equals_batch_after_every_batch(spark, folder, at, seed):
    """Events shuffled over batches, repeats of batches, one busy key; current after each."""
    chance = random.Random(seed)
    events = [("u", chance.choice("abcxxxx"), chance.choice([live.ASKED, live.ASKED, live.TAKEN]), at(chance.randrange(60))) for _ in range(60)]
    queue = live.LiveQueue(spark, f"{folder}/q")
    for number in range(6):
        batch = events[10 * number : 10 * number + 10]
        queue.add(queue_frame(spark, batch), number)
        queue.add(queue_frame(spark, batch), number)
        assert rows_of(queue.entries()) == want_queue(spark, events[: 10 * number + 10])
    assert rows_of(live.LiveQueue(spark, f"{folder}/q").entries()) == want_queue(spark, events)


def test_taken_and_asked_again(spark, folder, at):
    asked = [("u", "a", at(1)), ("u", "sound", at(1)), ("u", "none", at(1))], [("u", "a", at(2))], [("u", "a", at(5)), ("u", "a", at(6))]
    taken = [], [("u", "a", at(3))], []
    catalogs = spark.createDataFrame([("u", "a", "embed"), ("u", "sound", "audio"), ("u", "a", "audio")], CATALOG)
    want = [{("u", "a", at(1))}, set(), {("u", "a", at(5))}]
    for number, (some, gone) in enumerate(zip(asked, taken)):
        spark.createDataFrame(some, "author string, permlink string, requested_at timestamp_ntz").write.mode("append").parquet(f"{folder}/asked")
        spark.createDataFrame(gone, "author string, permlink string, taken_at timestamp_ntz").write.mode("append").parquet(f"{folder}/taken")
        streams = [jobs.read_stream(spark, f"{folder}/{n}", f"author string, permlink string, {c} timestamp_ntz") for n, c in (("asked", "requested_at"), ("taken", "taken_at"))]
        queue = live.live_queue(*streams, catalogs, f"{folder}/q")
        assert {tuple(r) for r in queue.entries().collect()} == want[number]
    refused = spark.read.parquet(f"{folder}/q/refused").select(*KEY).collect()
    assert sorted(map(tuple, refused)) == [("u", "none"), ("u", "sound")]
    queue = live.live_queue(*streams, catalogs, f"{folder}/with_audio", include_audio=True)
    assert ("u", "sound", at(1)) in {tuple(r) for r in queue.entries().collect()}


def test_lateness_folds_requests_and_refuses_late_removals(spark, folder, at):
    queue = live.LiveQueue(spark, f"{folder}/q", lateness=timedelta(hours=2))
    batches = [
        [("u", "a", live.ASKED, at(n)) for n in range(1, 30)] + [("u", "b", live.ASKED, at(30))],
        [("u", "a", live.TAKEN, at(5)), ("u", "b", live.TAKEN, at(29))],
        [("u", "a", live.ASKED, at(3)), ("u", "a", live.ASKED, at(31))], [("u", "c", live.ASKED, at(40))],
        [("u", "a", live.TAKEN, at(39))],
    ]
    for number, batch in enumerate(batches):
        queue.add(queue_frame(spark, batch), number)
    late = spark.read.parquet(f"{folder}/q/late").drop("batch_id").collect()
    assert [tuple(r) for r in late] == [("u", "a", live.TAKEN, at(5))]
    kept = [e for batch in batches for e in batch if e != ("u", "a", live.TAKEN, at(5))]
    assert rows_of(queue.entries()) == want_queue(spark, kept)
    assert queue.store.rows().where("permlink = 'a' and kind = 'asked'").count() < 5


def state_batches(chance, at, n, batches):
    """Saves, deletions, tags and offers with moments in no order."""
    out = [[] for _ in range(batches)]
    for event in range(n):
        key, kind = f"p{chance.choice([0, 0, 0, chance.randrange(9)])}", chance.choice(["save"] * 6 + ["gone", "tag", "offer"])
        moment, language = at(chance.randrange(200)), chance.choice(["en", "es", "fr"])
        out[event % batches].append((kind, ("u", key, chance.choice(["embed", "audio", "legacy"]), language, f"C{event}", f"S{event}", None, moment, event)))
    return out


def frames(spark, events):
    of = lambda kind: [row for k, row in events if k == kind]
    short = lambda kind: spark.createDataFrame([(r[0], r[1], r[7], r[8]) for r in of(kind)], EVENTS)
    offers = spark.createDataFrame([r[:3] for r in of("offer")], CATALOG)
    return spark.createDataFrame(of("save"), SAVES), short("gone"), short("tag"), offers


def batch_view(spark, events):
    """State, totals and counts computed from all events at once."""
    saves, gone, tags, offers = frames(spark, events)
    state = fold(after_deletions(as_state(saves), gone))
    offers, videos = offers.distinct(), headers(state)
    return (rows_of(state), rows_of(monitoring.stats_summary(offers, videos, tags)),
            rows_of(monitoring.language_counts(state).orderBy("language")), rows_of(monitoring.backlog_exact(offers, videos).orderBy("video_type")))


@pytest.mark.parametrize("seed", [3])
def test_state_and_totals_equal_batch_after_every_batch(spark, folder, at, seed):
    batches = state_batches(random.Random(seed), at, 120, 5)
    state = live.LiveState(spark, f"{folder}/s")
    for number, batch in enumerate(batches):
        state.add(live.state_events(*frames(spark, batch)), number)
        state.add(live.state_events(*frames(spark, batch)), number)  # delivered again
        seen = [e for b in batches[: number + 1] for e in b]
        got = (rows_of(state.subtitles()), rows_of(state.totals()), rows_of(state.measure("language", "language").orderBy("language")),
               rows_of(state.measure("open", "video_type").withColumnRenamed("n", "pending")))
        assert got == batch_view(spark, seen)


def test_lateness_keeps_state_exact(spark, folder, at):
    """Events in order: old saves are folded, and deletions still leave what the batch form leaves."""
    chance = random.Random(5)
    events = sorted((e for b in state_batches(chance, at, 90, 1) for e in b), key=lambda e: e[1][7])
    state = live.LiveState(spark, f"{folder}/s", lateness=timedelta(hours=5), totals=False)
    for number in range(6):
        state.add(live.state_events(*frames(spark, events[15 * number : 15 * number + 15])), number)
        if number in (1, 3, 5):
            assert rows_of(state.subtitles()) == batch_view(spark, events[: 15 * number + 15])[0]
    assert spark.read.parquet(f"{folder}/s/late").count() == 0


def test_parts_stay_few_and_a_crash_leaves_no_trace(spark, folder, at):
    """50 batches of the same and new keys: parts, manifests and folders are bounded; a part without a manifest is not there."""
    queue = live.LiveQueue(spark, f"{folder}/q")
    events, most = [], 0
    for number in range(50):
        batch = [("u", f"k{number % 7}", live.ASKED, at(number)), ("u", f"k{number}", live.TAKEN, at(number))]
        events += batch
        if number == 20:  # the driver dies after the part is written
            frame = queue_frame(spark, [("u", "lost", live.ASKED, at(0))])
            frame.write.mode("overwrite").parquet(queue.store.path(queue.store._free(set())))
            queue = live.LiveQueue(spark, f"{folder}/q")
        queue.add(queue_frame(spark, batch), number)
        most = max(most, len(queue.store.newest.slots))
    assert most <= 3 * 3 and len(queue.store.manifests) <= queue.store.ring
    assert rows_of(queue.entries()) == want_queue(spark, events)
    old = queue.store.manifests[46]
    assert queue.store.rows(old).count() > 0  # a reader may still use an older manifest
    assert spark.read.parquet(f"{folder}/q/parts").select("slot").distinct().count() <= most + 4 * queue.store.ring


def test_nothing_in(spark, folder):
    state = live.LiveState(spark, f"{folder}/s")
    assert state.subtitles().collect() == [] and state.totals().first()["total_available"] == 0
    assert live.LiveQueue(spark, f"{folder}/q").entries().collect() == []
    store = PartStore(spark, f"{folder}/p", "a int", lambda rows, live, now: rows)
    store.commit(spark.createDataFrame([], "a int"), 0)
    assert store.rows().select(F.count("*")).first()[0] == 0
