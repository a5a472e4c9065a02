from datetime import datetime

from pyspark.sql import functions as F

from mediacat import schemas
from mediacat.operators import selection as S
from mediacat.plans.full_pass import flagged
from mediacat.sources import catalog as C
from mediacat.sources import tables

NOW, START = datetime(2024, 1, 10), datetime(2024, 1, 5)
OLD, NEW, LATER = datetime(2024, 1, 1), datetime(2024, 1, 6), datetime(2024, 2, 1)


def catalogs(spark):
    legacy = spark.createDataFrame([
        ("u1", "new", "ipfs://a", "ipfs://h/manifest.m3u8", "published", NEW, None, None),
        ("u1", "old", "ipfs://b", None, "published", OLD, None, None),
        ("u2", "soon", "ipfs://c", "", "scheduled", None, LATER, None),
        ("u2", "past", "ipfs://d", None, "scheduled", NEW, OLD, None),
        ("u2", "http", "http://x", None, "published", NEW, None, None),
        ("u2", "empty", "", None, "published", NEW, None, None),
        ("u2", "bare", "ipfs://", None, "published", NEW, None, None),
        ("u3", "both", "ipfs://e", None, "draft", NEW, None, None),
    ], schemas.CATALOG_LEGACY)
    embed = spark.createDataFrame([
        ("u3", "both", "m1", "published", NEW), ("u1", "e", "m2", "published", OLD),
        ("u1", "none", None, "published", NEW), ("u1", "blank", "", "published", NEW),
    ], schemas.CATALOG_EMBED)
    audio = spark.createDataFrame([
        ("u3", "both", "a1", "published", NEW), (None, "anon", "a2", "published", None),
    ], schemas.CATALOG_AUDIO)
    return legacy, embed, audio


def keys(rows):
    return {(r.author, r.permlink, r.video_type) for r in rows.collect()}


def test_since(spark):
    got = keys(C.videos_since(*catalogs(spark), NOW, START))
    assert got == {
        ("u1", "new", "legacy"), ("u2", "soon", "legacy"), ("u2", "bare", "legacy"),
        ("u3", "both", "embed"), ("u3", "both", "audio"),
    }
    own_bound = keys(C.videos_since(*catalogs(spark), NOW, START, OLD))
    assert own_bound - got == {("u1", "e", "embed")}


def test_all_and_available(spark):
    assert keys(C.all_videos(*catalogs(spark), NOW)) == keys(C.videos_since(*catalogs(spark), NOW, datetime(1, 1, 1))) | {
        ("unknown", "anon", "audio"),
    }
    assert ("u2", "soon", "legacy") not in keys(C.available(*catalogs(spark)))


def test_missing_dates_come_first(spark):
    rows = C.by_creation(C.all_videos(*catalogs(spark), NOW)).collect()
    assert [r.permlink for r in rows[:4]] == ["soon", "anon", "old", "e"]


def test_predicates_reach_the_scan(spark, folder, capsys):
    legacy, embed, _ = catalogs(spark)
    legacy.write.parquet(f"{folder}/legacy")
    embed.write.parquet(f"{folder}/embed")
    stored = tables.read(spark, f"{folder}/legacy", schemas.CATALOG_LEGACY)
    C.legacy_published(stored, START).select("permlink").explain("formatted")
    plan = capsys.readouterr().out
    for part in ("StringStartsWith(filename,ipfs://)", "EqualTo(status,published)", "GreaterThanOrEqual(created"):
        assert part in plan
    assert "description" not in plan
    stored = tables.read(spark, f"{folder}/embed", schemas.CATALOG_EMBED)
    C.embed_published(stored, START).explain("formatted")
    assert "Not(EqualTo(manifest_cid,))" in capsys.readouterr().out


def test_other_formats_and_absent_columns(spark, folder):
    spark.sql("select 'u' owner, 'p' permlink, 'ipfs://x' filename").write.json(f"{folder}/json")
    row = tables.read(spark, f"{folder}/json", schemas.CATALOG_LEGACY, "json").first()
    assert (row.owner, row.status, row.created) == ("u", None, None)


def test_lookup_precedence(spark):
    videos = C.everything(*catalogs(spark))
    wanted = spark.createDataFrame([("u3", "both"), ("u1", "none"), ("x", "y"), ("u3", "both")], "author string, permlink string")
    got = {(r.author, r.permlink): (r.video_type, r.found) for r in C.lookup(videos, wanted).collect()}
    assert got == {("u3", "both"): ("legacy", True), ("u1", "none"): ("embed", True), ("x", "y"): (None, False)}


def test_fetch_plan(spark):
    got = {(r.permlink, r.video_type): r for r in S.fetch_plan(C.everything(*catalogs(spark))).collect()}

    def route(*key):
        return got[key].route, got[key].fetch_cid, got[key].local_name

    assert route("new", "legacy") == ("hls", "h", "u1_new_h.mp4") and got["new", "legacy"].cid == "a"
    assert route("old", "legacy") == ("direct", "b", "u1_old_b.mp4")
    assert route("bare", "legacy") == ("skip", None, None)
    assert route("empty", "legacy")[0] == "skip" and route("none", "embed")[0] == "skip"
    assert route("both", "embed") == ("hls", "m1", "u3_both_m1.mp4")
    assert route("anon", "audio")[0] == "direct" and got["http", "legacy"].cid == "http://x"


def test_refs(spark):
    refs = ["a/b", "a/b/c", "a/", "/b", "ab", " ", " a/b \n", None, "/"]
    rows = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = [(r.author, r.permlink, r.reason) for r in S.parse_refs(rows).collect()]
    bad = (None, None, "bad_format")
    assert got == [("a", "b", None), ("a", "b/c", None), bad, bad, bad, bad, ("a", "b", None), bad, bad]


def test_cursor(spark):
    def cursor(dates, start):
        rows = spark.createDataFrame([(d,) for d in dates], "video_created_at timestamp_ntz")
        return S.cursor_value(rows, start)

    assert cursor([NEW, OLD, None], "2024-01-03") == NEW
    assert cursor([OLD], "2024-01-03") == datetime(2024, 1, 3)
    assert cursor([None], "") is None and cursor([], "2024-01-03") == datetime(2024, 1, 3)
    assert cursor([NEW], "") == NEW


def test_blacklists_and_work_order(spark):
    videos = C.all_videos(*catalogs(spark), NOW)
    authors = spark.createDataFrame([("u2",), ("u2",)], "author string")
    items = spark.createDataFrame([("u1", "old"), ("u3", "x")], "author string, permlink string")
    left = keys(S.without_blacklisted(videos, authors, items))
    assert left == {k for k in keys(videos) if k[0] != "u2" and k[:2] != ("u1", "old")}
    creators = spark.createDataFrame([("u2",), ("u2",)], "author string")
    odd = videos.withColumn("video_type", F.when(F.col("permlink") == "old", "strange").otherwise(F.col("video_type")))
    order = [(r.permlink, r.video_type) for r in S.work_positions(odd, creators).orderBy("position").collect()]
    assert order == [
        ("bare", "legacy"), ("soon", "legacy"), ("e", "embed"), ("both", "embed"), ("new", "legacy"),
        ("anon", "audio"), ("old", "strange"), ("both", "audio"),
    ]
    assert order == [(r.permlink, r.video_type) for r in S.work_order(odd, creators).collect()]


def test_config_lists(spark):
    rules = spark.createDataFrame([(2, "b", "c", None), (1, "a", "b", None)], schemas.CORRECTIONS)
    assert tables.correction_rules(rules) == [("a", "b"), ("b", "c")]
    words = spark.createDataFrame([("y", None), ("x", None), ("x", None)], schemas.HOTWORDS)
    assert tuple(tables.hotword_prompt(words).first()) == ("x, y", 2)
    assert tables.distinct_authors(spark.createDataFrame([("a",), ("a",)], "author string")).count() == 1


def test_spread_leaves_large_scans_alone(spark):
    for pieces in (1, 9):
        assert tables.spread(spark.range(100, numPartitions=pieces), 4, "id").rdd.getNumPartitions() == 4


def test_config(spark):
    from mediacat.sources import config

    read = config.from_mapping({
        "languages": [{"code": "en", "name": "English"}, {"code": "fr", "max_duration": 5}],
        "tags": ["food", "art"], "ipfs": {"gateways": ["https://g/"]}, "tagging": {"max_tags": 3},
    })
    assert (read.max_tags, read.min_confidence, read.max_words) == (3, 0.3, 8)
    assert [tuple(r) for r in config.languages_table(spark, config.Config(languages=[
        tables.Language(0, "en"), tables.Language(1, "fr", 5.0)])).collect()] == [(0, "en", None), (1, "fr", 5.0)]
    assert [x.code for x in read.languages] == ["en", "fr"] and read.languages[1].max_duration == 5
    assert config.tags_table(spark, read).count() == 2
    assert tuple(config.gateways_table(spark, read).first()) == (0, "https://g/")


def test_a_list_of_items_is_not_broadcast(spark, capsys):
    videos = C.all_videos(*catalogs(spark), NOW)
    authors = spark.createDataFrame([("u2",)], "author string")
    items = spark.createDataFrame([("u1", "old"), ("u1", "old"), (None, "x")], "author string, permlink string")
    left = S.without_blacklisted(videos, authors, items)
    assert keys(left) == {k for k in keys(videos) if k[0] != "u2" and k[:2] != ("u1", "old")}
    left.explain()
    assert "Broadcast" not in capsys.readouterr().out
    marked = flagged(videos, authors, items)
    assert marked.count() == videos.count() and keys(marked.where("not is_blacklisted")) == keys(left)
    marked.explain()
    assert "Broadcast" not in capsys.readouterr().out
