import glob

from mediacat.operators import srt
from mediacat.operators.ordered import block_of
from mediacat.sinks import files
from mediacat.sources.srt_files import read_srt

SEGMENTS = "author string, permlink string, language string, seg_idx bigint, start_s double, end_s double, text string"


def segments(spark):
    texts = ["hello", "", "two\nlines", "7", "\t tabs \t", "with --> arrow", "a\n\nb"]
    rows = [("u", "v", "en", 10 * i, float(i), i + (1.5 if i == 2 else 1.0), t) for i, t in enumerate(texts)]
    rows += [("u", "w", "es", 0, 1.001, 360000.0, "long")]
    return spark.createDataFrame(rows, SEGMENTS)


def documents(spark):
    return srt.render_documents(segments(spark), block=block_of("seg_idx", 16))


def test_render(spark):
    got = {r.permlink: r.srt for r in documents(spark).collect()}
    assert got["w"] == "1\n00:00:01,000 --> 100:00:00,000\nlong\n\n"
    assert got["v"].startswith("1\n00:00:00,000 --> 00:00:01,000\nhello\n\n2\n00:00:01,000 --> 00:00:02,000\n\n\n3\n")
    assert "\n5\n00:00:04,000 --> 00:00:05,000\ntabs\n\n6\n" in got["v"]


def test_parts_make_the_document(spark):
    parts = srt.render_parts(segments(spark), block=block_of("seg_idx", 16)).orderBy("part").collect()
    assert len([p for p in parts if p.permlink == "v"]) > 2
    for document in documents(spark).collect():
        assert "".join(p.srt for p in parts if p.permlink == document.permlink) == document.srt


def test_parse_gives_back_every_cue(spark):
    got = srt.parse_documents(documents(spark)).orderBy("permlink", "seg_idx").collect()
    want = segments(spark).orderBy("permlink", "seg_idx").collect()
    assert [r.text for r in got] == [r.text.strip() for r in want]
    assert all(abs(a.start_s - b.start_s) <= 0.001 and abs(a.end_s - b.end_s) <= 0.001 for a, b in zip(got, want))
    assert [r.cue_no for r in got if r.permlink == "v"] == list(range(1, 8))


def test_parse_edges(spark):
    cue = "1\n00:00:00,000 --> 00:00:01,000\nx"
    rows = [("u", "none", "en", "no cue here"), ("u", "open", "en", cue), ("u", "empty", "en", "")]
    docs = spark.createDataFrame(rows, "author string, permlink string, language string, srt string")
    assert [(r.permlink, r.text) for r in srt.parse_documents(docs).collect()] == [("open", "x")]
    assert {r.permlink: r.is_valid for r in srt.document_quality(docs).collect()} == {
        "none": False, "open": True, "empty": False,
    }


def test_quality_counts(spark):
    row = srt.document_quality(documents(spark)).where("permlink = 'v'").first()
    assert (row.cue_count, row.empty_count, row.overlap_count, row.is_valid) == (7, 1, 1, True)
    flagged = srt.overlaps(segments(spark), srt.DOCUMENT, block=block_of("seg_idx", 16)).where("is_overlap")
    assert [r.seg_idx for r in flagged.collect()] == [20]


def test_files_hold_the_exact_text(spark, folder):
    docs = documents(spark)
    files.write_srt(docs, folder)
    paths = glob.glob(f"{folder}/author=u/permlink=v/language=en/*.txt")
    want = {r.permlink: r.srt for r in docs.collect()}
    assert len(paths) == 1 and open(paths[0], encoding="utf-8", newline="").read() == want["v"]
    assert {r.permlink: r.srt for r in read_srt(spark, folder).collect()} == want


def test_a_second_pass_keeps_the_files_of_the_first(spark, folder):
    rows = [("007", "0012", "en", "a\n\n"), ("1e3", "p", "en", "b\n\n")]
    schema = "author string, permlink string, language string, srt string"
    files.write_srt(spark.createDataFrame(rows, schema), folder)
    files.write_srt(spark.createDataFrame([("1e3", "p", "en", "c\n\n")], schema), folder)
    got = {(r.author, r.permlink): r.srt for r in read_srt(spark, folder).collect()}
    assert got == {("007", "0012"): "a\n\n", ("1e3", "p"): "c\n\n"}
    index = files.path_index(spark.createDataFrame(rows[:1], schema)).first()
    assert (index.path, index.folder) == ("007/0012.en.srt", "author=007/permlink=0012/language=en")


def test_a_new_folder_is_not_replaced_document_by_document(spark, folder, monkeypatch):
    """A dynamic overwrite renames the folder of each document in the driver."""
    asked, option = [], files.DataFrameWriter.option
    monkeypatch.setattr(files.DataFrameWriter, "option", lambda w, key, value: asked.append(key) or option(w, key, value))
    rows = [("u", "a", "en", "a\n\n"), ("u", "b", None, "b"), (None, "c", "es", "c\n")]
    docs = spark.createDataFrame(rows, "author string, permlink string, language string, srt string")
    files.write_srt(docs, f"{folder}/new")
    assert "partitionOverwriteMode" not in asked
    files.write_srt(docs.where("permlink = 'a'").withColumn("srt", srt.F.lit("d\n")), f"{folder}/new")
    assert "partitionOverwriteMode" in asked
    assert {(r.author, r.permlink, r.language): r.srt for r in read_srt(spark, f"{folder}/new").collect()} == {
        ("u", "a", "en"): "d\n", ("u", "b", None): "b\n", (None, "c", "es"): "c\n"}
    files.write_parts(docs.withColumn("part", srt.F.lit(3)), f"{folder}/parts")
    assert len(glob.glob(f"{folder}/parts/author=u/permlink=a/language=en/part=3/*.txt")) == 1


def test_line_ends_marks_and_junk(spark):
    cues = "1\n00:00:00,000 --> 00:00:01,000\nx\n\n2\n00:00:01,000 --> 00:00:02,000\ny\n\n"
    rows = [("u", "crlf", "en", cues.replace("\n", "\r\n")), ("u", "mark", "en", "\ufeff" + cues), ("u", "blank", "en", "\n\n" + cues), ("u", "junk", "en", "note\n\n" + cues)]
    docs = spark.createDataFrame(rows, "author string, permlink string, language string, srt string")
    got = {(r.permlink, r.cue_no, r.text) for r in srt.parse_documents(docs).collect()}
    assert got == {(p, n, t) for p in ("crlf", "mark", "blank", "junk") for n, t in ((1, "x"), (2, "y"))}
    assert [(r.permlink, r["at"], r.piece) for r in srt.unparsed(docs).collect()] == [("junk", 0, "note")]


def test_equal_texts_share_an_id(spark):
    import hashlib

    row = srt.with_content_id(documents(spark)).where("permlink = 'w'").first()
    assert row.subtitle_cid == hashlib.sha256(row.srt.encode()).hexdigest()
