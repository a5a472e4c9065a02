import random

import brute
import pytest

import __spark_entry__
import corpus_pipeline
from mediacat.llm import decontaminate, minhash, queries
from registry.check import difference, duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_queries_equal_their_sql(spark):
    con = duck(SF)
    for name, sql in queries.ORACLES.items():
        assert difference(spark_rows(queries.QUERIES[name](spark, SF)), duck_rows(con, sql)) is None, name


def test_stages(spark, folder):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else None
        out = stage(spark, docs, SF)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        kept = {r.doc_id: r for r in docs.collect()}
        assert set(kept) <= set(before) and len(kept) > 100
        if name == "quality rules":
            assert all(not brute.base_rules(r.text)[-1] for r in kept.values())
        if name == "near dedup":
            rows = [(d, brute.five_words(t)) for d, t in before.items()]
            assert set(kept) == {d for (d, _), c in zip(rows, brute.components(rows, linked=brute.alike)) if d == c}
        if name == "decontamination":
            assert all(not brute.hits(r.text, items)[1] for r in kept.values())
            assert all(kept[d].text == t for d, t in before.items() if not brute.hits(t, items)[1])
    assert set(kept) == set(before) and all(r.n_pieces == len(r.piece_ids) for r in kept.values())


def test_one_pass_of_decontamination_equals_two(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    docs = docs.unionByName(docs.limit(3).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars"))
    want = sorted(map(str, decontaminate.clean(decontaminate.find_items(docs, items)).select(*docs.columns).collect()))
    for chars in (decontaminate.BLOCK_CHARS, 2_000):
        assert sorted(map(str, decontaminate.cleaned(docs, items, block_chars=chars).collect())) == want


def test_nothing_in(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def edited(seed, n, edits):
    words = [f"w{seed}_{i}" for i in range(n)]
    for k in range(edits):
        words[(2 * k + 1) * n // (2 * edits)] = f"edit{seed}_{k}"
    return " ".join(words)


def test_near_dedup_links_by_five_words_at_four_fifths(spark):
    """200 words are 196 shingles; four edits far apart leave 176 of 216 (0.81), five 171 of 221 (0.77)."""
    rows = [(10 * s + k, edited(s, 200, k * 4), "a") for s in range(1, 9) for k in (0, 1)]
    rows += [(10 * s + k, edited(s, 200, k * 5), "a") for s in range(11, 19) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert kept == sorted([10 * s for s in range(1, 9)] + [10 * s + k for s in range(11, 19) for k in (0, 1)])


def test_near_dedup_verifies_what_simhash_finds(spark, monkeypatch):
    """One changed word in 2,000 leaves the fingerprint near: op1's operator meets the pair, before any MinHash key does.
    Texts without words are one node and no pair; a met pair that is not similar links nothing."""
    first = []
    verify = minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, *rest: first.append(pairs.count()) or verify(pairs, *rest))
    rows = [(10 * s + k, edited(s, 2000, k), "a") for s in range(1, 5) for k in (0, 1)] + [(90, "", "a"), (91, None, "a"), (92, edited(9, 300, 0), "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert kept == [10, 20, 30, 40, 90, 92]
    assert first[0] == 4 and sum(first[1:]) == 0
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "u v w x y z"), (3, "a b c d e f")], "row long, text string")
    met = spark.createDataFrame([(2, 1), (3, 1), (3, 2)], "row long, other long")
    assert sorted(map(tuple, minhash.components(texts, met=met).collect())) == [(1, 1), (2, 2), (3, 1)]


def template(seed, common, own, name="c"):
    return " ".join([f"{name}{i}" for i in range(common)] + [f"o{seed}_{i}" for i in range(own)])


def test_pages_of_a_template_are_not_all_paired(spark, monkeypatch):
    """120 texts of similarity 0.71 meet in MinHash keys, but no pair of them goes through the prefix join; similar ones do."""
    held = []
    verify = minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, *rest: held.append(pairs.count()) or verify(pairs, *rest))
    rows = [(i, template(i, 250, 50)) for i in range(120)] + [(1000 + i, template(i, 250, 10, "d")) for i in range(5)]
    found = minhash.components(spark.createDataFrame(rows, "row long, text string").repartition(3)).collect()
    sets = [(r, brute.five_words(t)) for r, t in rows]
    assert {r.row: r.component for r in found} == dict(zip([r for r, _ in rows], brute.components(sets, linked=brute.alike)))
    assert held[-1] <= 20 and sum(held) < 24 * 2 * 130


@pytest.mark.parametrize("seed", [1])
def test_components_equal_all_pairs(spark, seed):
    """Edited copies on both sides of the threshold, sizes on both sides of it, short and empty texts, repeats and nulls."""
    chance, rows = random.Random(seed), [(1, ""), (2, None), (3, " \n"), (4, "a b"), (5, "A b"), (6, "a b c d e"), (7, "a b c d e f")]
    for family in range(25):
        base = [f"w{chance.randrange(40)}" for _ in range(chance.choice([8, 30, 120, 300]))]
        for _ in range(chance.randrange(1, 7)):
            words = list(base)
            for _ in range(chance.choice([0, 1, 2, 3, 5])):
                words[chance.randrange(len(words))] = chance.choice(["x", "y", f"w{chance.randrange(40)}"])
            rows.append((len(rows) + 100 * family, " ".join(words + ["more"] * chance.choice([0, 0, len(words) // 5]))))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    found = minhash.components(spark.createDataFrame(rows, "row long, text string").repartition(4)).collect()
    sets = [(i, brute.five_words(t)) for i, t in rows]
    assert {r.row: r.component for r in found} == dict(enumerate(brute.components(sets, linked=brute.alike)))


def test_near_dedup_keeps_one_row_of_each_group(spark):
    """Rows without an id stay if they are no copy; repeated rows are copies of each other."""
    rows = [(None, edited(1, 100, 0), "a"), (None, edited(2, 100, 0), "a"), (7, edited(2, 100, 0), "a"),
            (8, edited(3, 100, 0), "a"), (8, edited(3, 100, 0), "a"), (None, edited(4, 100, 0), "a"), (None, edited(4, 100, 0), "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(((r.doc_id or -1, r.text[:3]) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()))
    assert kept == [(-1, "w1_"), (-1, "w4_"), (7, "w2_"), (8, "w3_")]
