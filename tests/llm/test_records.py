import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from mediacat.llm import passages, warc

SCHEMA = "page_id long, url string, html string, digest int"
MARK = warc.VERSION


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [(1, "http://a/", "<p>é</p>", 0), (2, None, None, 0), (3, "x\r\ny", "", 0), (4, "http://b/", "<p>é</p>", 0), (5, "u", "long " * 50, 0),
         (6, "u", f"a{MARK}{MARK}b WARC/1.1\r", 0), (7, "u", "\r\n\r\n", 0), (8, "u", "long " * 50, 0), (-9, "u", "<p>é</p>", 0), (8, "u", "long " * 50, 0),
         (11, "http://a/WARC/1.1", "address", 0), (12, "WARC/1.1WARC/1.1\r\n", "address", 0), (None, "u", "x", 0)]


@pytest.mark.parametrize("chunk", [7, 64 << 10])
def test_archive_round_trip(spark, folder, chunk):
    got = warc.archived(spark.createDataFrame(PAGES, SCHEMA), chunk, f"{folder}/w").collect()
    newest = {}
    for page, _, html, _ in PAGES:
        if page is not None:
            newest[html or ""] = max(newest.get(html or "", page), page)
    want = {(p, len((h or "").encode()), sha(h), "response" if newest[h or ""] == p else "revisit", None if newest[h or ""] == p else newest[h or ""])
            for p, _, h, _ in PAGES if p is not None}
    assert Counter(map(tuple, got)) == Counter(want)


def test_archive_is_warc(spark, folder):
    warc.write(spark.createDataFrame(PAGES[4:5], SCHEMA).coalesce(1), f"{folder}/w", chunk=100)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{folder}/w").glob("*.gz"))
    records = [r for r in raw.split(MARK.encode()) if r]
    assert len(records) == 3 and all(r.endswith(b"\r\n\r\n") for r in records)
    assert [b"WARC-Type: response" in r for r in records] == [True, False, False] and b"WARC-Segment-Total-Length: 250" in records[2]
    assert b"".join(r.split(b"\r\n\r\n", 1)[1][:-4] for r in records) == ("long " * 50).encode()


def test_a_lost_segment_is_seen(spark, folder):
    warc.write(spark.createDataFrame(PAGES[4:5], SCHEMA), f"{folder}/w", chunk=100)
    chunks = warc.read(spark, f"{folder}/w")
    assert warc.digests(chunks).first().computed == sha("long " * 50)
    for lost in (1, 2, 3):
        row = warc.digests(chunks.where(f"segment <> {lost}")).first()
        assert row.computed is None and row.payload_bytes is None
    assert warc.archived(spark.createDataFrame([], SCHEMA), folder=f"{folder}/none").collect() == []


def words(seed, n):
    chance = random.Random(seed)
    return [f"w{chance.randrange(5000)}" for _ in range(n)]


def test_passages_are_found_and_nothing_else(spark):
    shared, near = words(1, 60), words(2, 120)
    edited = list(near)
    edited[60] = "edit"
    rows = [(i, " ".join(words(100 + i, 70 + i) + shared + words(200 + i, 80))) for i in range(12)]
    rows += [(20, " ".join(words(20, 90) + near)), (21, " ".join(edited + words(21, 90)))]
    rows += [(30 + i, " ".join(words(30 + i, 100) + words(3, 40) + words(50 + i, 100))) for i in range(4)]  # too short to count
    rows += [(60, " ".join(words(60, 200))), (61, " ".join(words(60, 200)).upper()), (62, " ".join(words(62, 80) * 2))]
    rows += [(70, None), (71, ""), (72, "few words"), (None, " ".join(words(60, 200))), (61, " ".join(words(60, 200)))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int")
    found = {}
    for r in passages.repeated_passages(docs).collect():
        found.setdefault(r.doc_id, []).append((r.first_word, r.last_word))
        assert r.partner_id != r.doc_id and r.n_links >= 1 and r.similarity >= passages.SIMILARITY
    assert set(found) == {*range(12), 20, 21, 60, 61}
    for i in range(12):
        assert all(a <= 70 + i and b >= 70 + i + 59 and b - a <= 62 for a, b in found[i])
    assert found[20] == [(90, 209)] and found[21] == [(0, 119)] and found[60] == [(0, 199)]
    assert passages.repeated_passages(docs.limit(0)).collect() == []


def test_every_holder_of_a_short_passage_is_found(spark):
    shared = words(5, 50)
    rows = [(i, " ".join(words(1000 + i, 90) + shared + words(2000 + i, 90))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(60)
    found = {r.doc_id for r in passages.repeated_passages(docs).collect() if r.first_word <= 90 and r.last_word >= 139}
    assert found == set(range(60))


@pytest.mark.parametrize("tasks", [1, 110])
def test_others_between_two_holders_do_not_part_them(spark, tasks):
    rows = []
    for p in range(6):
        shared, names = words(300 + p, 50), [1000 * p + 7, 1000 * p + 77]
        for d in range(1000 * p, 1000 * p + 100):
            held = shared if d in names else shared[:40] if d % 2 else shared[10:]
            rows.append((d, " ".join(words(10_000 + 2 * d, 60) + held + words(10_001 + 2 * d, 60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)
    found = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == {1000 * p + k for p in range(6) for k in (7, 77)}
    assert len({r.class_id for r in found}) == 6


def family(p, n, size):
    """A passage that ``n`` documents hold, each but the first with one word of its own in it."""
    shared, rows = words(900 + p, size), []
    for d in range(n):
        held = list(shared)
        if d:
            held[random.Random(50_000 + 100 * p + d).randrange(5, size - 5)] = f"own{d}"
        rows.append((100 * p + d, " ".join(words(20_000 + 200 * p + 2 * d, 60) + held + words(20_001 + 200 * p + 2 * d, 60))))
    return rows


def test_holders_with_own_edits_are_one_class(spark):
    """A window met only the longest of its contexts and its neighbour: 95 of these 120 were in their class then."""
    rows = [r for p in range(10) for r in family(p, 12, 55)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(60)).collect()
    held = {}
    for r in found:
        held.setdefault(r.class_id, set()).add(r.doc_id)
    assert all(len({d // 100 for d in docs}) == 1 for docs in held.values())
    assert sum(max(len(docs) for docs in held.values() if p in {d // 100 for d in docs}) for p in range(10)) >= 118


def test_links_count_the_holders_of_a_class(spark):
    rows = [(100 * p + i, " ".join(words(100 * p + i + 5000, 60) + words(400 + p, 60) + words(100 * p + i + 7000, 60)))
            for p in range(3) for i in range(10 + p)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {d for d, _ in rows} and all(r.n_links == 9 + r.doc_id // 100 for r in found)
    assert len({(r.class_id, r.doc_id // 100) for r in found}) == 3


@pytest.mark.parametrize("seeded", [0, -1])
def test_a_passage_is_followed_over_an_inserted_word(seeded):
    """One half was met; the other one is on the next diagonal."""
    a = np.arange(1000, 1080)
    b = np.concatenate([a[:40], [7], a[40:]])
    assert [x[:4] for x in passages.chains(a, b, [seeded], 50, 0.8)] == [(0, 79, 0, 80)]


def test_more_open_chains_than_eight_are_kept():
    """Between two halves of a passage ten other runs begin."""
    a = np.arange(1000, 1100)
    b = np.concatenate([a[:30], [1], a[31:]])
    far = np.concatenate([np.concatenate([-np.arange(100 * k + 1, 100 * k + 21), a[18 + k : 25 + k]]) for k in range(10)])
    other = np.concatenate([b, far])
    diagonals = list(range(-len(other), len(a)))
    assert (0, 99, 0, 99) in [x[:4] for x in passages.chains(a, other, diagonals, 50, 0.8)]


@pytest.mark.parametrize("html", ["page WARC/1.1", "WARC/1.1", "x" * 92 + "WARC/1.1" + "y" * 50])
def test_a_segment_that_ends_in_the_version(spark, folder, html):
    pages = spark.createDataFrame([(1, "u", html, 0), (2, "u", html, 0)], SCHEMA)
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.archived(pages, 100, f"{folder}/w").collect()}
    assert got == {1: (len(html), sha(html)), 2: (len(html), sha(html))}
