"""A whole pass over a handful of items, one of each kind."""

import hashlib
import re

from pyspark.sql import functions as F

from mediacat.operators import srt, transcript
from mediacat.operators.ordered import block_of
from mediacat.plans import full_pass, work_pass
from mediacat.sinks.srt_store import SrtStore
from mediacat.sources.tables import Language

LANGS = [Language(0, "en"), Language(1, "es"), Language(2, "fr", 0.1)]
CATALOG = ("author string, permlink string, video_type string, status string, created_at timestamp_ntz, filename string, video_v2 string, "
           "manifest_cid string, audio_cid string, description string")


def catalog(spark, at):
    embed = lambda p, n, cid="Em", author="u", text="about it": (author, p, "embed", "published", at(n), None, None, cid, None, text)
    return spark.createDataFrame([
        embed("plain", 1), embed("asked", 2), embed("no cid", 3, None), embed("silent", 4), embed("done", 5), embed("item", 6),
        embed("author", 7, author="bad"), embed("fails", 8), embed("part", 9, text=None),
        ("u", "old", "legacy", "published", at(0), "ipfs://Qm", None, None, None, "told"),
    ], CATALOG)


def speech(spark):
    rows = [("u", p, s, f" {p} says the word {s} again.", s * 3.0, s * 3.0 + 3) for p in ("plain", "asked", "done", "item", "fails", "part", "old") for s in range(2)]
    rows += [("bad", "author", 0, " x.", 0.0, 1.0)] + [("u", "part", s, " long", s * 3.0, s * 3.0 + 3) for s in range(2, 5)]
    return spark.createDataFrame([(*r, []) for r in rows], (
        "author string, permlink string, raw_seg long, text string, start_s double, end_s double, words array<struct<word: string, start_s: double, end_s: double>>"))


def run(spark, folder, at):
    catalogs = catalog(spark, at)
    queue = spark.createDataFrame([("u", "asked", at(9)), ("u", "unknown", at(1)), ("u", "item", at(2))], "author string, permlink string, requested_at timestamp_ntz")
    creators = spark.createDataFrame([("u",)], "author string")
    authors = spark.createDataFrame([("bad",)], "author string")
    items = spark.createDataFrame([("u", "item")], "author string, permlink string")
    state = spark.createDataFrame([("u", "done", c.code) for c in LANGS] + [("u", "part", "en")], "author string, permlink string, language string")
    spoken = catalogs.select("author", "permlink", F.lit("en").alias("source_language"))
    work = full_pass.work_items(catalogs, catalogs, queue, creators, authors, items)

    def translate(texts, source, target):
        if any("fails" in t for t in texts) and "spa" in target:
            raise ValueError("no")
        return [f"{target}: {t}" for t in texts]

    score = lambda texts, labels: [[float(len(label) in map(len, t.split())) for label in labels] for t in texts]
    store = SrtStore(spark, f"{folder}/store")
    made = full_pass.run_full_pass(work, spoken, speech(spark), state, LANGS, [("says", "SAYS")], translate, score, ["word", "toolonglabel"], store)
    return made, store


def test_one_of_each_kind(spark, folder, at):
    made, store = run(spark, folder, at)
    log = [(r.permlink, r.source, r.outcome) for r in sorted(made.run_log.collect(), key=lambda r: r.position)]
    assert log[:3] == [("unknown", "queue", "not_found"), ("item", "queue", "blacklisted"), ("asked", "queue", "success")]
    want = {"plain": "success", "asked": "success", "no cid": "failed", "silent": "failed", "done": "success", "item": "blacklisted", "author": "blacklisted",
            "fails": "success", "part": "success", "old": "success"}
    assert {p: o for p, s, o in log if s == "batch"} == want and log[-1][0] == "author"  # creators go first
    assert [p for p, s, _ in log if s == "batch"][-2] == "old"  # legacy after embed
    tags = {r.permlink: (r.reason, r.tags[0]) for r in made.tags.collect()}
    assert set(tags) == {"plain", "asked", "fails", "part", "old"} and tags["plain"] == ("scored", "word")
    documents = {(r.permlink, r.language): r for r in made.documents.collect()}
    # "fr" is for short speech only; "part" has "en"; "fails" lost "es" and keeps the others.
    assert set(documents) == {(p, c) for p in ("plain", "asked", "old") for c in ("en", "es", "fr")} | {("part", "es"), ("fails", "en"), ("fails", "fr")}
    assert [(r.permlink, r.language) for r in made.rejects.collect()] == [("fails", "es")]
    texts = {(r.permlink, r.language): r.srt for r in store.documents().collect()}
    assert set(texts) == set(documents) and all(hashlib.sha256(texts[k].encode()).hexdigest() == r.subtitle_cid for k, r in documents.items())
    assert "spa_Latn: plain SAYS the word 0 again." in texts["plain", "es"] and texts["plain", "en"].startswith("1\n00:00:00,000 --> 00:00:03,000\nplain SAYS")
    assert documents["old", "en"].video_type == "legacy" and documents["old", "en"].video_cid == "Qm" and documents["plain", "es"].path == "u/plain.es.srt"
    assert {r.permlink: r.video_duration_seconds for r in made.processing.collect()} == {"plain": 6, "asked": 6, "fails": 6, "part": 15, "old": 6}


def moved(rows, capsys):
    """The columns that each shuffle of a plan moves."""
    rows.explain("formatted")
    return [set(re.findall(r"(\w+)#\d+", x)) for x in re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", capsys.readouterr().out)]


def test_cues_move_and_not_the_timed_words_they_are_cut_from(spark, capsys):
    words = [{"word": w, "start_s": float(i), "end_s": i + 1.0} for i, w in enumerate([" one", " two.", " three", " four", " five."])]
    rows = [(v, "p", s, "".join(w["word"] for w in words), 0.0, 5.0, words) for v in ("u", "v", None) for s in range(600)]
    segments = spark.createDataFrame(rows, speech(spark).schema)
    videos = spark.createDataFrame([("u", "p"), ("w", "p"), (None, "p")], "author string, permlink string")
    cues = transcript.spoken_cues(segments, videos, [("two", "TWO")], 3)
    moves = moved(cues, capsys)
    assert moves and not any("words" in m or "_word" in m for m in moves)
    got = sorted((r.author, r.raw_seg, r.cue_in_seg, r.start_s, r.end_s, r.text) for r in cues.collect())
    assert got == [("u", s, *c) for s in range(600) for c in ((0, 0.0, 2.0, "one TWO."), (1, 2.0, 5.0, "three four five."))]


def test_rejected_documents_are_left_out_without_moving_their_cues_again(spark, capsys):
    videos = spark.createDataFrame([("u", p, "en") for p in ("plain", "fails")], "author string, permlink string, source_language string")
    state = spark.createDataFrame([], "author string, permlink string, language string")

    def translate(texts, source, target):
        if any("fails" in t for t in texts) and "spa" in target:
            raise ValueError("no")
        return texts

    made = work_pass.run_pass(videos, speech(spark), state, LANGS, [], translate)
    assert not any("start_s" in m for m in moved(made.documents, capsys))  # what is gathered moves as one value
    found = {(r.permlink, r.language): r.cue_count for r in made.documents.collect()}
    assert found == {("plain", c.code): 2 for c in LANGS} | {("fails", "en"): 2, ("fails", "fr"): 2}
    assert [(r.permlink, r.language) for r in made.rejects.collect()] == [("fails", "es")]
    cues = spark.createDataFrame([(d, s, 1.0, 2.0, "x") for d in ("a", "b") for s in range(3)], "doc string, seg_idx long, start_s double, end_s double, text string")
    parts = srt.render_parts(cues, ["doc"], block=block_of("seg_idx", 2), without=spark.createDataFrame([("a",), ("c",)], "doc string"))
    assert sorted((r.doc, r.part, r.srt[0]) for r in parts.collect()) == [("b", 0, "1"), ("b", 1, "3")]
