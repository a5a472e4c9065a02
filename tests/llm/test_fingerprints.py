import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from mediacat.llm import components, simhash

TEXTS = [
    None, "", " \n\t", "one", "One two", "a b c d", "A  B\nC\tD", "a b c d e f g h i j", "a b c d e f g h i k",
    "ä ö ü ß", "x " * 3000, "Σ É Z",
]


def test_fingerprint_equals_plain_version():
    got = simhash.fingerprint(pa.array(TEXTS, pa.string()), 4).view(np.uint64).tolist()
    assert got == [brute.fingerprint(t) for t in TEXTS]


def test_thresholds_cover_the_radius():
    parts = simhash.correlated_parts(10, np.zeros((64, 64)), 5)
    assert sorted(b for p in parts for b in p.bits) == list(range(64))
    cost = [[0.0] + [float(k + 1) * 10**t for t in range(5)] for k in range(5)]
    price, chosen = simhash.allocate(parts, cost, 4)
    assert sum(p.threshold + 1 for p in chosen) == 5 and price == sum(cost[k][p.threshold + 1] for k, p in enumerate(chosen))


@pytest.mark.parametrize("choices", [(2,), (3,), (4,), (5,)])
def test_near_fingerprints_are_found(spark, choices):
    chance = random.Random(choices[0])
    values = [chance.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in chance.sample(range(64), k)) for v in values[:40] for k in (1, 4, 5)]
    rows = [(i, v - 2**64 if v >= 2**63 else v) for i, v in enumerate(dict.fromkeys(values))]
    nodes = spark.createDataFrame(rows, "node long, fp long")
    plan = simhash.plan(nodes, 4, choices)
    assert len(plan) == choices[0] and sum(p.threshold + 1 for p in plan) == 5
    found = {r.node: r.component for r in components.connected(simhash.links(nodes, plan, 4, block=8), "a", "b").collect()}
    want = brute.components([(i, v % 2**64) for i, v in rows])
    assert [found.get(i, i) for i, _ in rows] == want


def test_copies_of_every_kind(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(5, "a b c d", "again"), (None, "a b c d", "no id")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, fp string")
    got = sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_copies(docs).collect())
    kept = [(i, brute.fingerprint(t)) for i, t, _ in rows if i is not None]
    assert got == sorted((i, f, c) for (i, f), c in zip(kept, brute.components(kept)))


def test_no_rows(spark):
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 200)] + [(500, 501), (501, 500)], "a long, b long")
    found = {r.node: r.component for r in components.connected(edges, "a", "b").collect()}
    assert found == {i: 0 for i in range(1, 200)} | {501: 500}
