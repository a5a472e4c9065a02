from pyspark.sql import functions as F

from mediacat.operators import languages as L
from mediacat.operators import translation as X
from mediacat.sources.tables import Language

LANGS = [Language(0, "en"), Language(1, "es", 0.0), Language(2, "fr", 1.0)]
SEGMENTS = "author string, permlink string, seg_idx bigint, start_s double, end_s double, text string"


def durations(spark):
    return spark.createDataFrame(
        [("u", "short", 0.5), ("u", "exact", 1.0), ("u", "long", 1.5)], "author string, permlink string, duration_min double"
    )


def saved(spark, *rows):
    return spark.createDataFrame(list(rows) or [("-", "-", "-")], "author string, permlink string, language string")


def test_limits(spark):
    got = {}
    for r in L.eligible_languages(durations(spark), LANGS).orderBy("ord").collect():
        got.setdefault(r.permlink, []).append(r.language)
    assert got == {"short": ["en", "es", "fr"], "exact": ["en", "es", "fr"], "long": ["en", "es"]}
    skipped = {r.permlink: r.n_skipped for r in L.skipped_languages(durations(spark), LANGS).collect()}
    assert skipped == {"short": 0, "exact": 0, "long": 1}


def test_done_ignores_limits_but_remaining_does_not(spark):
    have = saved(spark, *[("u", "long", c) for c in ("en", "es", "en")], *[("u", "short", c) for c in ("en", "es", "fr", "xx")])
    assert [r.permlink for r in L.fully_done(have, LANGS).collect()] == ["short"]
    left = {(r.permlink, r.language) for r in L.remaining_languages(durations(spark), LANGS, have).collect()}
    assert left == {("exact", "en"), ("exact", "es"), ("exact", "fr")}


def fanned(spark):
    rows = [("u", "short", i, float(i), i + 1.0, t) for i, t in enumerate(["same", "same", "", "other"])]
    segments = spark.createDataFrame(rows, SEGMENTS)
    targets = L.eligible_languages(durations(spark), LANGS)
    return L.fan_out(segments, targets).withColumn("source_language", F.lit("en"))


def test_translation_keeps_times_and_source(spark):
    rows = X.translate_segments(fanned(spark), lambda texts, s, t: [f"{t}:{x}" for x in texts], batch=2).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.start_s == float(r.seg_idx) and r.end_s == r.start_s + 1
        assert r.text.startswith({"en": "", "es": "spa_Latn:", "fr": "fra_Latn:"}[r.language])
    assert {r.text for r in rows if r.language == "en"} == {"same", "", "other"}


def test_equal_lines_are_translated_once(spark):
    done = X.translate_distinct(fanned(spark), lambda texts, s, t: texts)
    assert done.count() == 6


def test_failures_reject_their_language_only(spark):
    def choosy(texts, source, target):
        if "other" in texts and target == "spa_Latn":
            raise ValueError("no")
        return texts[1:] if target == "fra_Latn" and len(texts) > 1 else [f"{target}:{x}" for x in texts]

    rows = fanned(spark)
    done = X.stored_translations(rows, choosy, partitions=2)
    assert [(r.permlink, r.language, r.error) for r in X.rejects(rows, done).collect()] == [("short", "es", "ValueError: no")]
    kept = X.with_translations(rows, done).collect()
    assert sorted(r.language for r in kept) == ["en"] * 4 + ["fr"] * 4
    assert all(r.text.startswith("fra_Latn:") for r in kept if r.language == "fr")


def test_pairing_rejects_count_mismatch_per_language(spark):
    segments = fanned(spark)
    keys = ["author", "permlink", "language"]
    texts = segments.select(*keys, "seg_idx", F.lit("t").alias("text"))
    extra = texts.where("language = 'es' and seg_idx = 0").withColumn("seg_idx", F.lit(9).cast("bigint"))
    texts = texts.where("language <> 'fr' or seg_idx > 0").unionByName(extra)
    rejected = {(r.language, r.n_segments, r.n_translations) for r in X.mismatched(segments, texts, keys).collect()}
    assert rejected == {("fr", 4, 3), ("es", 4, 5)}
    paired = X.pair_by_position(segments, texts, keys).collect()
    assert {(r.language, r.text) for r in paired} == {("en", "t")} and len(paired) == 4


def test_detected_language(spark):
    rows = spark.createDataFrame([("en",), ("fr",), ("xx",), (None,)], "lang string")
    assert [r.source_language for r in L.detected_language(rows, LANGS).collect()] == ["en", "fr", "en", "en"]


def test_the_model_is_asked_from_slices_of_rows(spark):
    rows = spark.range(0, 5000, 1, 1).selectExpr(
        "repeat(cast(id as string), 10000) as text", "if(id % 50 = 0, null, 'en') as source_language", "if(id % 2 = 0, 'fr', 'de') as language")

    def held(texts, source, target):
        with open("/proc/self/statm") as f:
            return [f"{int(f.read().split()[1]) * 4096 // 1000000} {target}"] * len(texts)

    got = X.translate_distinct(rows, held, partitions=1).selectExpr("left(text, 4) as t", "language", "translated", "error").collect()
    assert len(got) == 4900 and all(r.error is None and r.translated.split()[1].startswith({"fr": "fra", "de": "deu"}[r.language]) for r in got)
    assert max(int(r.translated.split()[0]) for r in got) < 350  # the texts are 190 MB
