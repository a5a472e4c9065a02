import random

from pyspark.sql import functions as F

from mediacat import schemas
from mediacat.sinks import files, lists
from mediacat.sinks import subtitles as B

KEY = ["author", "permlink"]


def log(spark, at):
    rows = [
        ("u", "a", "embed", "en", "c1", "s1", None, at(1), 1), ("u", "a", "audio", "en", "c2", "s2", at(0), at(2), 2),
        ("u", "a", "legacy", "es", "c3", "s3", at(9), at(3), 3), ("u", "b", "audio", "en", "c4", "s4", at(5), at(4), 4),
        ("u", "b", "audio", "en", "c4", "s5", at(5), at(4), 5), ("u", "c", "legacy", "en", None, "s6", at(6), at(6), 6),
    ]
    return spark.createDataFrame(rows, schemas.SUBTITLE_LOG)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_first_and_last_write(spark, at):
    state = B.fold(B.as_state(log(spark, at)))
    ids = {(r.permlink, r.language): r.subtitle_cid for r in state.collect()}
    assert ids == {("a", "en"): "s2", ("a", "es"): "s3", ("b", "en"): "s5", ("c", "en"): "s6"}
    head = {r.permlink: r for r in B.headers(state).collect()}
    a = head["a"]
    assert (a.video_cid, a.is_embed, a.is_audio, a.created_at, a.updated_at) == ("c3", True, False, at(1), at(3))
    assert a.video_created_at is None and a.lang_count == 2  # the creating save had no date
    assert (head["b"].is_embed, head["b"].is_audio, head["c"].is_embed) == (True, True, False)
    assert a.languages == ["en", "es"]
    assert {r.permlink: r.subtitles for r in B.as_map(state).collect()}["a"] == {"en": "s2", "es": "s3"}
    assert B.from_maps(B.as_map(state)).count() == 4


def test_fold_is_idempotent_and_order_free(spark, at):
    whole = B.fold(B.as_state(log(spark, at)))
    rows = log(spark, at).collect()
    random.Random(1).shuffle(rows)
    parts = [B.fold(B.as_state(spark.createDataFrame(rows[i::2] + rows[:2], schemas.SUBTITLE_LOG))) for i in (0, 1)]
    assert rows_of(B.fold(parts[1].unionByName(parts[0]).unionByName(whole))) == rows_of(whole)


def test_missing_map_has_no_languages(spark):
    docs = spark.createDataFrame([("u", "a", None), ("u", "b", {})], "author string, permlink string, subtitles map<string,string>")
    assert B.from_maps(docs).count() == 0


def test_processing_times(spark, at):
    videos = spark.createDataFrame([("u", "a", 7, 70), ("u", "b", None, None)], "author string, permlink string, processing_seconds int, video_duration_seconds int")
    runs = spark.createDataFrame([
        ("u", "a", "batch", "success", 5, 50, at(1), 1), ("u", "a", "batch", "success", 6, 0, at(2), 2),
        ("u", "x", "batch", "success", 9, 90, at(1), 3),
    ], schemas.RUN_LOG)
    got = {r.permlink: (r.processing_seconds, r.video_duration_seconds) for r in B.with_processing_times(videos, runs).collect()}
    assert got == {"a": (6, 50), "b": (None, None)}
    zero = runs.where("event_id = 2")
    got = {r.permlink: (r.processing_seconds, r.video_duration_seconds) for r in B.with_processing_times(videos, zero).collect()}
    assert got["a"] == (6, 70)


def test_status(spark, at):
    rows = [("u", "a", "embed", "set", at(1), 1), ("u", "b", "audio", "set", at(2), 2), ("u", "b", "audio", "clear", at(3), 3)]
    events = spark.createDataFrame(rows, schemas.STATUS_LOG)
    assert B.current_status(events).count() == 0
    current = B.current_status(events.where("event_id < 3")).first()
    assert (current.permlink, current.is_embed, current.is_audio) == ("b", True, True)
    assert B.current_status(events.where("false")).count() == 0


def test_tags_are_renewed(spark, at):
    rows = spark.createDataFrame([("u", "a", ["x", "y"], at(1), 1), ("u", "a", ["z"], at(2), 2)], schemas.TAG_LOG)
    assert tuple(B.fold_tags(rows).first()) == ("u", "a", "z", at(2))


def queue(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.QUEUE)


def known(spark):
    return spark.createDataFrame(
        [("u", "a", "legacy"), ("u", "e", "embed"), ("u", "s", "audio"), ("u", "s2", "audio"), ("u", "s2", "embed")],
        "author string, permlink string, video_type string",
    )


def test_enqueue(spark, at):
    requests = queue(spark, ("u", "a", at(2)), ("u", "a", at(1)), ("u", "s", at(1)), ("u", "e", at(1)), ("u", "no", at(1)))
    waiting = queue(spark, ("u", "e", at(0)))
    got = {r.permlink: (r.outcome, r.n_requests, r.requested_at) for r in lists.enqueue(requests, known(spark), waiting).collect()}
    assert got == {
        "a": ("accepted", 2, at(1)), "s": ("not_found", 1, at(1)), "e": ("duplicate", 1, at(1)), "no": ("not_found", 1, at(1)),
    }
    with_audio = lists.enqueue(requests, known(spark), waiting, include_audio=True)
    assert with_audio.where("permlink = 's'").first().outcome == "accepted"


def test_queue_flags_and_pop(spark, at):
    rows = queue(spark, ("u", "a", at(3)), ("u", "e", at(2)), ("u", "s", at(1)), ("u", "s2", at(1)), ("u", "no", at(0)))
    got = {r.permlink: (r.is_embed, r.is_audio) for r in lists.queue_flags(rows, known(spark)).collect()}
    assert got == {"a": (False, False), "e": (True, False), "s": (True, True), "s2": (True, True), "no": (False, False)}
    assert lists.pop_oldest(rows).first().permlink == "no"
    assert lists.pop_oldest(rows.where("false")).count() == 0
    assert {r.permlink for r in lists.after_pop(rows).collect()} == {"a", "e", "s", "s2"}


def test_insert_and_delete(spark, at):
    have = spark.createDataFrame([("a", at(1))], schemas.AUTHOR_LIST)
    asked = spark.createDataFrame([("a", at(2)), ("b", at(3)), ("b", at(2))], schemas.AUTHOR_LIST)
    new = lists.insert_if_absent(have, asked, ["author"])
    assert [tuple(r) for r in new.collect()] == [("b", at(2))]
    assert lists.insert_if_absent(have.unionByName(new), asked, ["author"]).count() == 0
    rules = spark.createDataFrame([(1, "x", "y", at(1)), (2, "x", "z", at(0))], schemas.CORRECTIONS)
    kept = lists.insert_if_absent(rules.where("false"), rules, ["from_text"]).first()
    assert (kept.ord, kept.to_text) == (2, "z")
    listed = have.unionByName(new).withColumn("item_id", lists.item_id(["author"]))
    left = lists.delete_by_id(listed, listed.where("author = 'a'"))
    ids = listed.where("author = 'a'").select("item_id").union(spark.createDataFrame([("none",)], "item_id string"))
    assert sorted(r.deleted for r in lists.deletion_report(listed, ids).collect()) == [False, True]
    assert [r.author for r in left.collect()] == ["b"]
    assert [r.author for r in lists.newest_first(have.unionByName(new), ["author"]).collect()] == ["b", "a"]


def test_reprocess(spark, at):
    state = B.fold(B.as_state(log(spark, at)))
    tags = spark.createDataFrame([("u", "a", "x"), ("u", "c", "y")], "author string, permlink string, tags string")
    asked = queue(spark, ("u", "a", at(8)), ("u", "a", at(9)), ("u", "b", at(8)), ("u", "zz", at(8)))
    out = lists.reprocess(asked, state, tags, queue(spark, ("u", "b", at(1))))
    assert {r.permlink for r in out["subtitles"].collect()} == {"c"}
    assert {r.permlink for r in out["tags"].collect()} == {"c"}
    assert {(r.permlink, r.requested_at) for r in out["queue"].collect()} == {("a", at(8)), ("zz", at(8))}
    assert {(r.permlink, r.deleted, r.enqueued) for r in out["report"].collect()} == {
        ("a", True, True), ("b", True, False), ("zz", False, True),
    }


def test_snapshots_are_switched_last(spark, folder):
    files.publish(spark.range(3), folder, 1)
    files.publish(files.current(spark, folder).where("id > 0"), folder, 2)
    spark.range(9).write.parquet(f"{folder}/snapshot-3")  # written but never named
    assert files.current(spark, folder).count() == 2


def test_json_export(spark, at, folder):
    rows = spark.createDataFrame([("u", at(1)), ("w", at(1).replace(microsecond=5))], "author string, added_at timestamp_ntz")
    files.write_json(rows.coalesce(1), folder)
    assert sorted(r[0] for r in spark.read.text(folder).collect()) == [
        '{"author":"u","added_at":"2024-01-01T01:00:00"}', '{"author":"w","added_at":"2024-01-01T01:00:00.000005"}',
    ]


def test_bucketed_tables_join_in_place(spark, folder, at, capsys):
    state = B.fold(B.as_state(log(spark, at)))
    for name in ("left_side", "right_side"):
        files.write_bucketed(state, name, f"{folder}/{name}", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_side").join(spark.table("right_side").select(*KEY).distinct(), KEY, "left_semi")
        joined.explain("formatted")
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("left_side", "right_side"):
            spark.sql(f"drop table {name}")


def test_a_deletion_is_not_undone_by_the_log(spark, at):
    rows = [("u", "v", "embed", lang, "c", f"s{i}", None, at(i), i) for i, lang in enumerate(["en", "es", "en"])] + [("u", "w", "embed", "en", "c", "x", None, at(0), 9)]
    saves = B.as_state(spark.createDataFrame(rows, schemas.SUBTITLE_LOG))
    deletions = spark.createDataFrame([("u", "v", at(0), 0), ("u", "v", at(1), 1)], "author string, permlink string, ts timestamp_ntz, event_id bigint")
    got = {(r.permlink, r.language): (r.subtitle_cid, r.created_at) for r in B.fold(B.after_deletions(saves, deletions)).collect()}
    assert got == {("v", "en"): ("s2", at(2)), ("w", "en"): ("x", at(0))}


def test_taken_keys_can_be_asked_for_again(spark, at):
    requests = spark.createDataFrame([("u", "a", at(1)), ("u", "a", at(5)), ("u", "a", at(4)), ("u", "b", at(1)), ("u", "c", at(2))], "author string, permlink string, requested_at timestamp_ntz")
    taken = spark.createDataFrame([("u", "a", at(3)), ("u", "b", at(2)), ("u", "z", at(2))], "author string, permlink string, taken_at timestamp_ntz")
    assert {(r.permlink, r.requested_at) for r in lists.current_queue(requests, taken).collect()} == {("a", at(4)), ("c", at(2))}
