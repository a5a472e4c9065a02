"""Packed texts, content ids over pieces, and files read in byte ranges."""

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mediacat.operators.srt import DOCUMENT, content_ids, parse_documents, render_documents, render_parts, unparsed
from mediacat.operators.srt_lines import parse_lines, read_lines, unparsed_lines
from mediacat.sinks.srt_store import SrtStore
from mediacat.sources.srt_files import read_srt

TEXT = "author string, permlink string, language string, srt string"
CUES = "author string, permlink string, language string, seg_idx long, start_s double, end_s double, text string"


def texts(frame):
    return {(r.author, r.permlink, r.language): r.srt for r in frame.collect()}


def documents(spark, rows):
    return spark.createDataFrame(rows, TEXT)


def test_exact_bytes_and_replacement(spark, folder):
    """Any text comes back as it was; a rewrite replaces one document, from many pieces to one and back."""
    odd = ["", "1\r\n", "\n\n", "é🙂\u0000 ", "x" * 300_000, "﻿1\n", " tail", "\r"]
    rows = [("u", f"{i:03}", "en", t) for i, t in enumerate(odd)] + [("u", "000", "es", "other")]
    store = SrtStore(spark, f"{folder}/s")
    store.write(documents(spark, rows))
    assert texts(store.documents()) == {r[:3]: r[3] for r in rows}
    want = {r[:3]: r[3] for r in rows}
    pieces = [("u", "001", "en", n, f"piece {n}\n") for n in range(12)]
    store.write_parts(spark.createDataFrame(pieces, "author string, permlink string, language string, part int, srt string").repartition(5))
    want["u", "001", "en"] = "".join(p[4] for p in pieces)
    assert texts(store.documents()) == want and [r.part for r in store.document("u", "001", "en").collect()] == list(range(12))
    for n in range(7):
        store.write(documents(spark, [("u", "001", "en", f"new {n}"), ("v", str(n), "en", "t")]))
        want |= {("u", "001", "en"): f"new {n}", ("v", str(n), "en"): "t"}
    again = SrtStore(spark, f"{folder}/s")
    assert texts(again.documents()) == want and [r.srt for r in again.document("u", "001", "en").collect()] == ["new 6"]
    assert again.write(documents(spark, [("v", "0", "en", "late")]), version=3) == 3 and texts(again.documents()) == want
    assert len(again.store.newest.slots) <= 6


def test_few_files_and_a_key_that_reaches_the_scan(spark, folder):
    store = SrtStore(spark, f"{folder}/s")
    store.write(documents(spark, [("u", f"p{i}", "en", f"text {i}") for i in range(400)]).repartition(4))
    assert len(list(Path(f"{folder}/s/parts").rglob("*.parquet"))) <= 4
    one = store.document("u", "p77", "en")
    assert [r.srt for r in one.collect()] == ["text 77"] and store.document("u", "p", "en").collect() == []
    assert "EqualTo(author,u), EqualTo(permlink" in one._jdf.queryExecution().executedPlan().toString()


def cues(spark, n, docs=3):
    rows = [("u", f"p{d}", "en", i, i * 2.0, i * 2.0 + 1, "é " * (i % 7) + f"cue {i}") for d in range(docs) for i in range(n * (d + 1))]
    return spark.createDataFrame(rows, CUES).repartition(6)


def test_content_id_over_pieces_is_that_of_the_whole(spark):
    shown = cues(spark, 40)
    block = F.expr("seg_idx div 7")
    whole = {k: (hashlib.sha256(t.encode()).hexdigest(), len(t.encode())) for k, t in texts(render_documents(shown, block=block)).items()}
    parts = render_parts(shown, block=block)
    got = {tuple(r[:3]): tuple(r[3:]) for r in content_ids(parts).collect()}
    assert {k: v[:2] for k, v in got.items()} == whole and {v[2] for v in got.values()} == {6, 12, 18}
    nulls = spark.createDataFrame([(None, "p", "en", 2, "b"), (None, "p", "en", 1, "a"), ("u", "p", "en", 1, None)],
                                  "author string, permlink string, language string, part int, srt string")
    got = {r.author: (r.subtitle_cid, r.n_bytes) for r in content_ids(nulls).collect()}
    assert got == {None: (hashlib.sha256(b"ab").hexdigest(), 2), "u": (hashlib.sha256(b"").hexdigest(), 0)}
    assert content_ids(nulls.limit(0)).collect() == []


def file(folder, name, text):
    at = Path(f"{folder}/author=u/permlink={name}/language=en")
    at.mkdir(parents=True)
    (at / "a.txt").write_bytes(text.encode())


def stamp(i):
    return f"00:{i // 60 % 60:02}:{i % 60:02},000 --> 00:{i // 60 % 60:02}:{i % 60:02},900"


FILES = {
    "plain": "".join(f"{i + 1}\n{stamp(i)}\nline {i}\nsecond é\n\n" for i in range(40)),
    "crlf": "".join(f"{i + 1}\r\n{stamp(i)}\r\nline {i}\r\n\r\n" for i in range(9)),
    "bom": "﻿\n\n1\n" + stamp(1) + "\nx\n\n2\n" + stamp(2) + "\ny",
    "blank texts": f"1\n{stamp(1)}\n\n\n2\n{stamp(2)}\nx\n\n3\n{stamp(3)}\n\n\n",
    "blank lines inside": f"1\n{stamp(1)}\nfirst\n\nthird\n\n12\n\n2\n{stamp(2)}\n5\n{stamp(2)}\n\n",
    "junk": f"note\n\nmore\n\n1\n{stamp(1)}\nx\n\n2\nno timing\n\n3\n{stamp(3)}\nlast",
    "only junk": "nothing\nhere\n\n1\n2\n",
    "empty": "",
}


@pytest.mark.parametrize("split", [40, 173, 1 << 20])
def test_byte_ranges_give_the_cues_of_whole_files(spark, folder, split):
    """Files cut at any byte give the cues, and the pieces that are none, of whole files."""
    for name, text in FILES.items():
        file(folder, name, text)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = read_lines(spark, folder)
        ranges = lines.select("file", "range").distinct().count()
        got = parse_lines(lines).collect()
        junk = sorted((r.permlink, r.text) for r in unparsed_lines(lines).collect())
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    whole = read_srt(spark, folder)
    fields = lambda r: (r.cue_no, r.start_ms, r.end_ms, r.start_s, r.end_s, r.text)
    by_file = lambda rows, place: {n: [fields(r) for r in sorted(rows, key=place) if r.permlink == n] for n in FILES}
    assert by_file(got, lambda r: r.piece) == by_file(parse_documents(whole).collect(), lambda r: r.seg_idx)
    assert junk == sorted((r.permlink, r.piece.removesuffix("\n")) for r in unparsed(whole).collect())
    assert split > 1000 or ranges > len(FILES) + 5


def test_a_long_file_is_never_one_row(spark, folder):
    """8 MB in ranges of 256 kB: the largest row after reading is one cue."""
    chance = random.Random(1)
    text = "".join(f"{i + 1}\n{stamp(i)}\n{'word ' * chance.randrange(1, 30)}\n\n" for i in range(70_000))
    file(folder, "long", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
        lines = read_lines(spark, folder)
        assert lines.select("range").distinct().count() > 20
        found = parse_lines(lines).agg(F.count("*"), F.sum("cue_no"), F.max(F.length("text"))).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(found)[:2] == (70_000, 70_000 * 70_001 // 2) and found[2] < 200
