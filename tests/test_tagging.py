from mediacat.operators import tagging as G
from mediacat.sources.tables import Tag


def test_classification_text(spark):
    long = "d" * 4000
    rows = [("s", None), ("s", " \n"), (None, long), ("  ", long), ("s", long), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "transcript string, description string")
    got = [r.tag_text for r in G.classification_text(df).collect()]
    assert got == ["s", "s", long[:3000], long[:3000], long[:1500] + "\n\ns", None, None]
    unsampled = spark.createDataFrame([("x" * 2000, None)], "transcript string, description string")
    assert len(G.classification_text(unsampled, sampled=False).first().tag_text) == 1500
    assert len(G.classification_text(unsampled).first().tag_text) == 2000


def test_reasons_and_defaults(spark):
    df = spark.createDataFrame(
        [("t", [("a", 0.5), ("b", 0.1)]), (None, None), ("t", None), ("t", [])],
        "tag_text string, scores array<struct<label: string, score: double>>",
    )
    got = [(r.reason, r.tags) for r in G.select_tags(df).collect()]
    assert got == [
        ("scored", ["a"]), ("no_text", ["vlog", "general"]), ("failed", ["general", "video"]), ("failed", ["general", "video"]),
    ]


def test_hook_equals_builtin_scorer_and_skips_missing_text(spark):
    tags = [Tag(0, "x", "the"), Tag(1, "y", "cat")]
    df = spark.createDataFrame([("the cat the dog",), ("",), (None,)], "tag_text string")

    def share(texts, labels):
        seeds = {t.label: t.seed for t in tags}
        return [[t.split().count(seeds[n]) / max(len(t.split()), 1) for n in labels] for t in texts]

    hooked = [r.scores and [(s.label, s.score) for s in r.scores] for r in G.scored_by_hook(df, share, ["x", "y"]).collect()]
    assert hooked == [[("x", 0.5), ("y", 0.25)], [("x", 0.0), ("y", 0.0)], None]
    built_in = [r.scores and [(s.label, s.score) for s in r.scores] for r in G.with_seed_scores(df, tags).collect()]
    assert built_in == hooked


def test_failing_scores_are_failed_tags(spark):
    df = spark.createDataFrame([("good",), ("bad",), ("short",), (None,)], "tag_text string")

    def score(texts, labels):
        if "bad" in texts:
            raise ValueError("no")
        return [[0.5] if t == "short" else [0.1, 0.9] for t in texts]

    for batch in (1, 10):
        rows = G.select_tags(G.scored_by_hook(df, score, ["x", "y"], batch=batch)).collect()
        assert [(r.reason, r.tags[0]) for r in rows] == [("scored", "y"), ("failed", "general"), ("failed", "general"), ("no_text", "vlog")]


def test_score_rows(spark):
    rows = spark.createDataFrame([("k", "a", 0.1), ("k", "a", 0.4), ("k", "b", 0.2)], "key string, label string, score double")
    got = G.scores_from_rows(rows, ["key"]).select(G.score_map("scores").alias("m")).first().m
    assert got == {"a": 0.4, "b": 0.2}


def test_the_scorer_holds_a_batch_of_texts_and_not_all_rows(spark):
    rows = spark.range(0, 5000, 1, 1).selectExpr("repeat(cast(id as string), 10000) as tag_text")

    def held(texts, labels):
        with open("/proc/self/statm") as f:
            return [[int(f.read().split()[1]) * 4096 / 1e6]] * len(texts)

    megabytes = [r.scores[0].score for r in G.scored_by_hook(rows, held, ["x"]).select("scores").collect()]
    assert len(megabytes) == 5000 and max(megabytes) < 350  # the texts are 190 MB
