"""Thousands of correction rules, and translations kept across passes."""

import random

from pyspark.sql import functions as F

from mediacat.functions.text import corrected
from mediacat.operators.many_rules import corrected_by_many, corrector
from mediacat.operators.translation_memory import TranslationMemory

FANNED = "author string, permlink string, text string, source_language string, language string"


def test_same_rows_as_the_chain(spark):
    """Rules that feed each other, overlap, repeat, or hold pattern characters, in every case and script."""
    chance = random.Random(1)
    words = ["the", "THE", "der", "a", "aa", "$1", "\\E", "(x)", "é", "É", "İ", "i", "ß", "ss", "ς", "Σ", "K", "ﬁ", "🙂", "Ünï", " ", "."]
    rules = [(chance.choice(words) + chance.choice(["", *words]), chance.choice(["", *words]) + chance.choice(["", *words])) for _ in range(150)]
    rules = [(old, new if len(new) < 3 else new[:3]) for old, new in rules]
    texts = ["".join(chance.choices(words, k=chance.randrange(12))) for _ in range(300)] + [None, "", "the the THE"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for some in (rules[:30], rules[30:90], rules[90:], [("", "x"), ("a", "b"), ("A", "c")], []):
        chain = corrected(F.col("text"), [(old, new) for old, new in some if old])
        bad = rows.select("text", chain.alias("want"), corrected_by_many("text", some).alias("got")).where("not (want <=> got)").collect()
        assert bad == []


def test_thousands_of_rules_and_a_small_plan(spark):
    rules = [(f"word{i}", f"w{i + 1}") for i in range(5000)] + [("w7", "seven")]
    rows = spark.range(2000).select(F.concat(F.lit("say WORD"), F.col("id").cast("string"), F.lit(" now")).alias("text"))
    fixed = rows.select(corrected_by_many("text", rules).alias("text"))
    assert len(fixed._jdf.queryExecution().optimizedPlan().toString()) < 2000
    got = {r.text for r in fixed.collect()}
    assert "say w2 now" in got and "say seven now" in got and len(got) > 100


def test_rules_in_order():
    apply = corrector([("a", "b"), ("b", "c"), ("a", "never"), ("C", "a")])
    assert apply("aAb x") == "aaa x" and apply("") == ""


def fanned(spark, rows):
    return spark.createDataFrame([("u", "p", *r) for r in rows], FANNED)


def test_the_model_sees_a_unit_once(spark, folder):
    """Later passes ask for new units and those that failed; the answers are those of a pass without a memory."""
    log = f"{folder}/asked"

    def translate(texts, source, target, log=log):
        if any("fail" in t for t in texts):
            raise ValueError("no")
        with open(log, "a") as out:
            out.writelines(f"{t}|{target}\n" for t in texts)
        return [f"{target} {t}" for t in texts]

    memory = TranslationMemory(spark, f"{folder}/m", buckets=8)
    first = [("a", "en", "es"), ("a", "en", "es"), ("a", "en", "fr"), ("b", "en", "es"), ("fail", "en", "es"), ("same", "en", "en")]
    got = {tuple(r) for r in memory.translate(fanned(spark, first), translate).select("text", "language", "translated").collect()}
    assert got == {("a", "es", "spa_Latn a"), ("a", "fr", "fra_Latn a"), ("b", "es", "spa_Latn b"), ("fail", "es", None)}
    asked = sorted(open(log).read().split())
    assert asked == ["a|fra_Latn", "a|spa_Latn", "b|spa_Latn"]
    again = TranslationMemory(spark, f"{folder}/m", buckets=8)
    rows = again.translate(fanned(spark, [*first, ("c", "en", "es"), ("fail", "en", "es")]), translate).collect()
    assert {(r.text, r.language): r.translated for r in rows} == {
        ("a", "es"): "spa_Latn a", ("a", "fr"): "fra_Latn a", ("b", "es"): "spa_Latn b", ("c", "es"): "spa_Latn c", ("fail", "es"): None}
    assert sorted(open(log).read().split()) == sorted([*asked, "c|spa_Latn"])
    assert [r.error for r in rows if r.text == "fail"] == ["ValueError: no"]
    assert again.translate(fanned(spark, []), translate).collect() == []
    for n in range(9):
        again.translate(fanned(spark, [(f"n{n}", "en", "es")]), translate)
    assert len(again.store.newest.slots) <= 6 and again.store.rows().count() == 13
