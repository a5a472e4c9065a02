from mediacat import schemas
from mediacat.plans import monitoring as M
from mediacat.sinks.subtitles import as_state, fold, headers

VIDEOS = "author string, permlink string, is_embed boolean, is_audio boolean, lang_count bigint"
AVAILABLE = "author string, permlink string, video_type string, created_at timestamp_ntz"


def test_backlog_is_clamped_and_null_safe(spark, at):
    videos = spark.createDataFrame(
        [("u", "1", True, None, 2), ("u", "2", True, False, 1), ("u", "3", True, True, 0), ("u", "4", None, None, 1)], VIDEOS
    )
    available = spark.createDataFrame([("u", "1", "embed", at(0)), ("u", "9", "legacy", at(0)), ("u", "8", "legacy", at(0))], AVAILABLE)
    got = {r.video_type: (r.available, r.processed, r.pending) for r in M.backlog_counts(available, videos).collect()}
    assert got == {"embed": (1, 2, 0), "audio": (0, 1, 0), "legacy": (2, 1, 1)}
    assert {r.video_type: r.pending for r in M.backlog_exact(available, videos).collect()} == {"legacy": 2}
    tags = videos.select("author", "permlink").limit(2)
    row = M.stats_summary(available, videos, tags.unionByName(tags)).first()
    assert (row.total_processed, row.total_subtitles, row.total_tagged, row.total_available, row.pending) == (4, 4, 2, 3, 1)
    empty = M.stats_summary(available.where("false"), videos.where("false"), tags.where("false")).first()
    assert set(empty) == {0}
    assert '"start_date":"all"' in M.stats_json(M.stats_summary(available, videos, tags), "now", "").first().stats


def videos(spark, at, n):
    rows = [("u", f"p{i:03d}", "embed", lang, "c", "s", None, at(i), 2 * i + j) for i in range(n) for j, lang in enumerate(("fr", "en"))]
    return headers(fold(as_state(spark.createDataFrame(rows, schemas.SUBTITLE_LOG))))


def test_pages(spark, at):
    saved = videos(spark, at, 45)
    order = [f"p{i:03d}" for i in reversed(range(45))]
    for page, size, want, more in ((1, 20, order[:20], True), (3, 20, order[40:], False), (3, 15, order[30:], False), (9, 20, [], None)):
        rows = M.processed_page(saved, page, size).orderBy("updated_at", ascending=False).collect()
        assert [r.permlink for r in rows] == want
        assert {r.has_more for r in rows} == ({more} if want else set())
        assert {r.languages for r in rows} <= {"fr,en"}
    assert M.processed_page(videos(spark, at, 130), 1, 500).count() == 100


def test_feed_limits_before_and_after_exclusion(spark, at):
    available = spark.createDataFrame(
        [("u", f"{kind}{i}", kind, at(i)) for kind in ("legacy", "embed", "audio") for i in range(30)]
        + [("u", "undated", "audio", None)], AVAILABLE,
    )
    nothing = spark.createDataFrame([], schemas.QUEUE)
    creators = spark.createDataFrame([("u",)], "author string")
    current = spark.createDataFrame([("u", "embed29", True, False, at(50))], "author string, permlink string, is_embed boolean, is_audio boolean, started_at timestamp_ntz")
    rows = [("u", f"legacy{i}", "legacy", "en", "c", "s", None, at(i), i) for i in range(10, 30)]
    saved = headers(fold(as_state(spark.createDataFrame(rows, schemas.SUBTITLE_LOG))))
    queue = spark.createDataFrame([("u", "audio29", at(40))], schemas.QUEUE)
    feed = M.activity_feed(available, available, saved, queue, current, creators)
    got = [r for r in feed.collect() if r.section == 4]
    # All 20 legacy candidates are processed and older ones do not move up.
    assert {r.permlink for r in got} == {f"{k}{i}" for k in ("embed", "audio") for i in range(10, 29)}
    assert {r.state for r in got} == {"prioritized"}
    assert {(r.permlink, r.is_embed, r.is_audio) for r in M.feed_pending(feed).where("section = 2").collect()} == {("audio29", True, True)}
    assert feed.where("state = 'complete'").count() == 20 and M.feed_pending(feed).where("section = 1").count() == 1
    fresh = M.recent_pending(available, saved.where("false"), nothing, current.where("false"), creators.where("false"))
    assert fresh.count() == 50 and {r.state for r in fresh.collect()} == {"pending"}


def test_run_summary(spark, at):
    rows = [("u", "a", "batch", o, 1, 1, at(0), 0) for o in ("success", "failed", "blacklisted", "success")] + [
        ("u", "a", "queue", "success", 1, 1, at(0), 0)
    ]
    assert tuple(M.run_summary(spark.createDataFrame(rows, schemas.RUN_LOG)).first()) == (4, 2, 1)
