from pyspark.sql import functions as F

from mediacat.sinks.subtitles import as_state, fold
from mediacat.sources.tables import Language
from mediacat.streaming import jobs
from registry import inputs

SF = "/root/testdata/sf0.001"
PAIR = ["author", "permlink", "language"]
LANGS = [Language(i, c) for i, c in enumerate(["en", "es", "fr", "de", "pt"])]


def put(rows, folder, name):
    """One file in the watched folder."""
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/in/{name}")


def source(spark, folder, events):
    return inputs.items(jobs.read_stream(spark, f"{folder}/in/*", events.schema, files_per_batch=1))


def five_files(spark, folder):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for i in range(5):
        put(events.where(F.col("event_id") % 5 == i), folder, f"f{i}")
    return events


def rows_of(df):
    return sorted(map(repr, df.collect()))


def batch_state(events):
    return fold(as_state(inputs.subtitle_log_rows(inputs.items(events))))


def test_upsert_equals_batch_through_restarts_and_repeats(spark, folder):
    events = spark.read.parquet(f"{SF}/events.parquet")
    late = F.col("event_id") < 150
    base = f"{folder}/state"

    def run():
        return jobs.upsert_subtitles(inputs.subtitle_log_rows(source(spark, folder, events)), base)

    for i in range(5):
        put(events.where(~late & (F.col("event_id") % 5 == i)), folder, f"f{i}")
    assert rows_of(run()) == rows_of(batch_state(events.where(~late)))
    assert rows_of(run()) == rows_of(batch_state(events.where(~late)))  # nothing new
    put(events.where(late), folder, "late")
    assert rows_of(run()) == rows_of(batch_state(events))
    put(events.where(F.col("event_id") % 5 == 2), folder, "again")
    assert rows_of(run()) == rows_of(batch_state(events))
    jobs.compact(spark, base, f"{folder}/compacted")
    stored = spark.read.parquet(f"{folder}/compacted/parts").drop("batch_id")
    assert rows_of(fold(stored)) == rows_of(batch_state(events))


def test_completion_and_counts_over_many_batches(spark, folder):
    events = five_files(spark, folder)
    log = inputs.subtitle_log_rows(source(spark, folder, events))
    state = batch_state(events)
    want = {(r.author, r.permlink): (r.n, r.n == 5) for r in state.groupBy("author", "permlink").agg(F.count("*").alias("n")).collect()}
    got = {(r.author, r.permlink): (r.n_done, r.is_complete) for r in jobs.completion(log, LANGS, f"{folder}/c").collect()}
    assert got == want
    counts = jobs.live_counts(log, PAIR, ["language"], f"{folder}/l")
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in state.groupBy("language").count().collect()}
    put(events.where("event_id < 50"), folder, "again")
    again = jobs.live_counts(inputs.subtitle_log_rows(source(spark, folder, events)), PAIR, ["language"], f"{folder}/l")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in state.groupBy("language").count().collect()}


def test_live_counts_can_keep_running(spark, folder):
    events = five_files(spark, folder)
    log = inputs.subtitle_log_rows(source(spark, folder, events))
    query = jobs.live_counts(log, PAIR, ["language"], f"{folder}/live", refresh_seconds=1)
    query.processAllAvailable()
    query.stop()
    got = {tuple(r) for r in jobs.read_live_counts(spark, f"{folder}/live", ["language"]).collect()}
    assert got == {tuple(r) for r in batch_state(events).groupBy("language").count().collect()}


def test_queue_keys_enter_once(spark, folder):
    events = five_files(spark, folder)
    requests = inputs.queue_log_rows(source(spark, folder, events))
    asked = inputs.queue_log_rows(inputs.items(events)).select("author", "permlink").distinct()
    catalogs = asked.where("permlink like 'd%'")
    got = jobs.dedup_queue(requests, catalogs, f"{folder}/q").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, catalogs.collect()))


def test_open_work_takes_late_rows(spark, folder):
    schema = "owner string, permlink string, manifest_cid string, status string, createdAt timestamp_ntz"
    rows = spark.createDataFrame([("u", f"p{i}", "m", "published", None) for i in range(4)], schema).withColumn(
        "createdAt", F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    )
    done = spark.createDataFrame([("u", "p1", c.code) for c in LANGS] + [("u", "p2", "en")], "author string, permlink string, language string")
    late = rows.withColumn("createdAt", F.expr("timestamp_ntz'1990-01-01 00:00:00'")).withColumn("permlink", F.lit("old"))

    def run():
        stream = jobs.read_stream(spark, f"{folder}/in/*", rows.schema).withColumnRenamed("owner", "author")
        return {r.permlink for r in jobs.open_work(stream, done, LANGS, f"{folder}/o").collect()}

    put(rows, folder, "a")
    assert run() == {"p0", "p2", "p3"}
    put(late, folder, "b")
    assert run() == {"p0", "p2", "p3", "old"}


def test_requested_items_go_ahead_over_all_batches(spark, folder, at):
    requests = spark.createDataFrame([("u", "b", at(2)), ("u", "a", at(3)), ("u", "no", at(1))], "author string, permlink string, requested_at timestamp_ntz")
    for i in range(3):
        put(requests.offset(i).limit(1), folder, f"r{i}")
    videos = spark.createDataFrame(
        [("u", p, "embed", "published", at(i)) for i, p in enumerate("cab")],
        "author string, permlink string, video_type string, status string, created_at timestamp_ntz",
    )
    creators = spark.createDataFrame([("x",)], "author string")
    stream = jobs.read_stream(spark, f"{folder}/in/*", requests.schema, files_per_batch=1)
    rows = jobs.prioritised_work(stream, videos, videos, creators, f"{folder}/w").collect()
    assert sorted((r.bucket, r.permlink) for r in rows) == [(0, "a"), (0, "b"), (1, "c")]
    assert [r.permlink for r in sorted(rows, key=lambda r: r.position)] == ["b", "a", "c"]
    assert [r.position for r in sorted(rows, key=lambda r: r.position)] == [1, 2, 3]


def test_the_requests_of_a_work_list_are_not_broadcast(spark, folder, at, capsys, monkeypatch):
    """Stored requests are measured by their packed files; their rows can be ten times as large."""
    requests = spark.range(50).selectExpr("concat('u', id) author", "concat('p', id) permlink", "timestamp_ntz'2024-01-01' requested_at")
    put(requests, folder, "a")
    videos = spark.range(80).selectExpr(
        "concat('u', id) author", "concat('p', id) permlink", "'embed' video_type", "'published' status", "timestamp_ntz'2024-01-01' created_at")
    stream = jobs.read_stream(spark, f"{folder}/in/*", requests.schema)
    monkeypatch.setattr(jobs, "position", lambda rows, order, name: rows.withColumn(name, F.lit(1)))
    work = jobs.prioritised_work(stream, videos, videos, videos.select("author").where("author < 'u3'"), f"{folder}/w")
    assert work.count() == 80
    work.explain()
    assert "Broadcast" not in capsys.readouterr().out
