"""Tables stored in an order: pages by number and by key, and the work list over one."""

import random

import pytest
from pyspark.sql import functions as F

from mediacat.plans.work_list import WorkList
from mediacat.sinks.ordered_table import By, OrderedTable

ORDER = [By("at", descending=True), By("author"), By("permlink")]
SCHEMA = "author string, permlink string, at int, position string"
CATALOG = "author string, permlink string, video_type string, status string, created_at timestamp_ntz"


def rows(n, seed=1):
    chance = random.Random(seed)
    return [(chance.choice(["busy", "busy", "u", None]), f"p{i}", chance.choice([None, *range(n // 3)]), "x") for i in range(n)]


def in_order(given):
    return sorted(given, key=lambda r: (r[2] is None, -(r[2] or 0), r[0] is not None, r[0] or "", r[1]))


@pytest.fixture
def table(spark, folder):
    given = rows(500)
    frame = spark.createDataFrame(given, SCHEMA).drop("position").repartition(7)
    return in_order(given), OrderedTable.write(frame, f"{folder}/t", ORDER, rows_per_range=40)


def keys(frame):
    return [(r.author, r.permlink, r.at) for r in sorted(frame.collect(), key=lambda r: r.position)]


def test_pages_of_every_depth(spark, table):
    want, stored = table
    want = [r[:3] for r in want]
    for number in (1, 2, 9, 17, 25, 26):
        page = stored.page(number, 20).collect()
        assert [(r.author, r.permlink, r.at) for r in sorted(page, key=lambda r: r.position)] == want[20 * number - 20 : 20 * number]
        assert all(r.has_more == (20 * number < 500) for r in page)
    assert keys(stored.rows()) == want and [r.position for r in stored.rows().orderBy("position").collect()] == list(range(1, 501))


def test_a_page_reads_one_or_two_files(table):
    """The first page and a deep one alike; the plan filters by place in the scan."""
    _, stored = table
    for number in (1, 13, 25):
        page = stored.page(number, 20)
        assert len(page.inputFiles()) <= 2 < stored.index.count()
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or" in plan or "GreaterThanOrEqual(_place" in plan
        assert "Exchange" not in plan and "Sort" not in plan


def test_pages_by_key(table):
    want, stored = table
    got, key = [], None
    while True:
        page = keys(stored.after(key, 30))
        if not page:
            break
        got += page
        key = (page[-1][2], page[-1][0], page[-1][1])
    assert got == [r[:3] for r in want]
    # A key that is not there any more still has a place.
    at = next(r[2] for r in want if r[2] is not None and r[2] < 100)
    assert keys(stored.after((at, "zzz", "zzz"), 5)) == [r[:3] for r in want if r[2] is None or r[2] < at][:5]
    assert len(stored.after((at, "busy", "p"), 30).inputFiles()) <= 3


def test_equal_keys_and_nothing(spark, folder):
    same = spark.createDataFrame([("u", "p", 1)] * 100, "author string, permlink string, at int")
    assert OrderedTable.write(same, f"{folder}/s", ORDER, 10).page(2, 30).count() == 30
    empty = OrderedTable.write(same.limit(0), f"{folder}/e", ORDER, 10)
    assert empty.page(1, 10).collect() == [] and empty.after(None, 10).collect() == [] and empty.rows().collect() == []


def candidates(spark, at, n=120):
    chance = random.Random(2)
    return spark.createDataFrame(
        [(chance.choice("abcd"), f"p{i}", chance.choice(["embed", "legacy", "audio"]), chance.choice(["published", "scheduled"]),
          chance.choice([None, at(i % 17)])) for i in range(n)], CATALOG)


def plain_list(videos, creators, queue):
    """The list by sorting everything."""
    ahead = [(a, p, 0) for _, a, p in sorted((q, a, p) for a, p, q in queue)]
    rank = {"embed": 0, "legacy": 1, "audio": 2}
    cat = {"legacy": 0, "embed": 1, "audio": 2}
    behind = sorted(videos, key=lambda v: (v.author not in creators, rank[v.video_type], v.status != "published", v.created_at is not None,
                                           v.created_at or 0, cat[v.video_type], v.author, v.permlink))
    return ahead + [(v.author, v.permlink, 1) for v in behind if (v.author, v.permlink) not in {(a, p) for a, p, _ in queue}]


def test_requests_move_the_list_without_sorting_it(spark, folder, at):
    """Batches of requests, of known and unknown keys; positions are those of a full sort, and the order is written once."""
    videos = candidates(spark, at)
    held = videos.collect()
    work = WorkList.store(videos, spark.createDataFrame([("b",)], "author string"), f"{folder}/w", rows_per_range=25)
    files = {r.file for r in work.candidates.index.collect()}
    chance, queue = random.Random(3), []
    for batch in range(4):
        if batch:
            queue += [(v.author, v.permlink, at(chance.randrange(50))) for v in chance.sample(held, 15) if (v.author, v.permlink) not in {q[:2] for q in queue}]
            queue = queue[3:] + [("x", f"unknown{batch}", at(7))]
            work.request(spark.createDataFrame(queue, "author string, permlink string, requested_at timestamp_ntz"))
        want = plain_list(held, {"b"}, queue)
        got = sorted(work.rows().collect(), key=lambda r: r.position)
        assert [(r.author, r.permlink, r.bucket) for r in got] == want and [r.position for r in got] == list(range(1, len(want) + 1))
        for size in (1, len(queue), len(queue) + 1, 60, 1000):
            first = sorted(work.first(size).collect(), key=lambda r: r.position) if size else []
            assert [(r.author, r.permlink, r.bucket) for r in first] == want[:size] and [r.position for r in first] == list(range(1, len(first) + 1))
    assert {r.file for r in work.candidates.index.collect()} == files
    near = work.first(len(queue) + 3)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
