import hashlib
import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from mediacat.llm import decontaminate, line_dedup, quality, token_counts
from mediacat.llm.token_counts import spliced, tokenizer

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau ypsilon".split()


def prose(seed, tail="", size=80):
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + tail for _ in range(size))


GOOD = prose(0)
TEXTS = [None, "", "  \n ", "one\none\n one\none", "# $ * <b>\n\n\n", "a b c a b c a b", GOOD, GOOD + "\n" + GOOD, "é ü\x0bß\x1fx " * 40, "w " * 5000, "!!!\n" * 60]


def test_base_rules_equal_plain_version(spark):
    rows = [(i, t, 3, True) for i, t in enumerate(TEXTS)] + [(6, GOOD, 3, True), (None, GOOD, 3, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, kept boolean")
    labels = spark.createDataFrame([(6, 1, 0), (10, 0, 0), (99, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality.apply_rules(docs, labels).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", *quality.RESULT.replace(",", "").split()[::2]}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(r.text)
        assert r.kept == (not r.base_failed and r.score >= quality.LEAST)
    assert all(r.kept for r in got if r.text == GOOD) and not any(r.kept for r in got if r.doc_id == 10)


def test_rules_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.apply_rules(spark.createDataFrame([], "doc_id long, text string"), labels).collect() == []
    row = quality.apply_rules(spark.createDataFrame([(1, GOOD)], "doc_id long, text string"), labels).first()
    assert row.score == 0 and row.kept


def test_quality_of_held_out_documents(spark):
    docs = spark.createDataFrame(
        [(i, prose(i, "" if i % 2 else "%%%", 900)) for i in range(60)], "doc_id long, text string")
    labels = docs.where("doc_id < 30").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    got = quality.apply_rules(docs, labels).where("doc_id >= 30 and not base_failed").collect()
    assert got and all(r.kept == bool(r.doc_id % 2) for r in got)


ITEMS = [(1, " ".join(WORDS[:12])), (2, "Beta-gamma delta"), (3, None), (4, "?!"), (None, "alpha"), (5, " ".join(WORDS[3:20])), (2, "Beta-gamma delta"),
         (6, " ".join(WORDS[:12]))]
DOCS = [None, "", "...", " ".join(WORDS), " ".join(WORDS[:9]), "x " + " ".join(WORDS[2:12]).upper() + " y", "beta gamma; delta beta gamma delta",
        " ".join(WORDS * 3), "alpha " * 30, "new words " * 3000 + " ".join(WORDS[1:11])]


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_items_equal_plain_version(spark, block):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(DOCS)] + [(3, DOCS[3], "again"), (None, DOCS[3], "")], "doc_id long, text string, spans string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_items(docs, items, block_chars=block).collect()
    assert len(got) == len(DOCS) + 2
    for r in got:
        n, hit, names = brute.hits(r.text, [x for x in ITEMS if x[0] is not None])
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, len(hit), names)
        assert {i for s in r.spans for i in range(s["first"], s["last"] + 1)} == hit


def test_short_hits_are_cut_and_long_ones_remove(spark):
    item = [(1, " ".join(WORDS[:10])), (2, " ".join(WORDS))]
    docs = [(1, "é " * 60 + "Alpha, " + " ".join(WORDS[1:10]) + "! end", "a"), (2, "x " * 90 + " ".join(WORDS), "b"), (3, "clean", "c"), (4, None, "d")]
    found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string, src string"), spark.createDataFrame(item, "item_id long, text string"))
    got = {r.doc_id: r.text for r in decontaminate.clean(found).collect()}
    assert got == {1: "é " * 60 + "! end", 3: "clean", 4: None}
    assert decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string, src string"), spark.createDataFrame([], "item_id long, text string")).agg(F.sum("n_hit")).first()[0] == 0


def test_lines_of_many_sites(spark):
    rows = [(i, f"Own line {i}\n  shared by all\t\n\nend {i}" if i else "shared by all\nshared by all", f"s{i % 20}" if i % 5 else None) for i in range(40)]
    rows += [(100, "shared by few\nrest", "a"), (101, "shared by few", "b"), (102, None, "c"), (103, "", None), (None, "shared by all", "d"), (7, rows[7][1], "s7")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_lines int")
    got = line_dedup.without_shared_lines(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].text == "shared by all" and by_id[0].n_removed == 1 and by_id[0].n_lines == 2
    assert by_id[3].text == "Own line 3\n\nend 3" and by_id[7].text == "Own line 7\n\nend 7"
    assert by_id[100].text == "shared by few\nrest" and by_id[102].text is None and by_id[103].text == "" and by_id[None].text == "shared by all"
    assert by_id[102].n_lines == 0 and by_id[103].n_lines == 1
    assert line_dedup.without_shared_lines(docs.limit(0)).collect() == []


def test_near_threshold_lines_are_exact(spark):
    rows = [(k * 100 + i, f"line {k}", f"site {i}") for k in (15, 16, 17, 300) for i in range(k)]
    got = line_dedup.without_shared_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy(F.floor(F.col("doc_id") / 100).alias("k")).agg(F.sum("n_removed").alias("n")).collect()
    removed = {r.k: r.n for r in got}
    assert removed[15] == 0 and removed[16] == 15 and removed[17] == 16


PATH = public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_the_library(spark):
    machine = tokenizer(PATH)
    texts = [None, "", " ", "it's É́ x<|endoftext|>y <|startoftext|>", "Ab" * 9000, GOOD, (GOOD + " it's 12<|endoftext|> ") * 60]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = token_counts.count_tokens(docs, PATH, chunk=500, overlap=40).collect()
    for r in got:
        whole = machine.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (len(whole), len((r.text or "").encode()), len(whole) > 2048)
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("text", ["a" * 3000, "ab cd" + "x" * 700 + " yz " * 50, "<|endoftext|>" * 100, "é " * 500, " " * 2000 + "w"])
def test_overlaps_widen_until_they_agree(text):
    machine = tokenizer(PATH)
    assert spliced(machine, text, 200, 10) == len(machine.encode(text, add_special_tokens=False).ids)


def test_items_digest():
    assert brute.digest([]) == hashlib.sha256(b"").hexdigest()
