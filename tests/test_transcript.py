import random

from pyspark.sql import functions as F

from mediacat.operators import transcript as T
from mediacat.operators.ordered import block_of

WORDS = [" a", " b.", " c,", " d!", "  ", " e?", "\t", " f;", " g. ", "h"]


def by_hand(words, limit):
    """Independent statement of the rule: take words until a sentence ends or it is full."""
    if len(words) <= limit:
        return [(words[0][1], words[-1][2], "".join(w[0] for w in words).strip())]
    cues, current = [], []
    for word in words:
        current.append(word)
        if len(current) == limit or word[0].strip()[-1:] in ("." , "!", "?") and word[0].strip():
            cues.append(current)
            current = []
    cues += [current] if current else []
    texts = [(c[0][1], c[-1][2], "".join(w[0] for w in c).strip()) for c in cues]
    return [c for c in texts if c[2]]


def raw(spark, sequences):
    rows = []
    for i, words in enumerate(sequences):
        rows.append(("u", f"v{i % 7}", i // 7, words[0][1], words[-1][2], "".join(w[0] for w in words), words))
    return spark.createDataFrame(
        rows, "author string, permlink string, raw_seg bigint, start_s double, end_s double, text string,"
              " words array<struct<word: string, start_s: double, end_s: double>>",
    )


def sequences(n, seed):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        length = rng.choice([1, 5, 8, 9, 10, 16, 17, 30])
        picked = [rng.choice(WORDS) for _ in range(length)]
        made.append([(w, i * 0.4, (i + 1) * 0.4) for i, w in enumerate(picked)])
    return made


def test_splitter_equals_loop(spark):
    made = sequences(300, 1)
    got = {}
    for r in T.split_segments(raw(spark, made)).orderBy("permlink", "raw_seg", "cue_in_seg").collect():
        got.setdefault((r.permlink, r.raw_seg), []).append((r.start_s, r.end_s, r.text))
    want = {(f"v{i % 7}", i // 7): by_hand(w, 8) for i, w in enumerate(made)}
    assert got == {k: v for k, v in want.items() if v}


def test_splitter_edges(spark):
    def words(*texts):
        return [(t, float(i), i + 1.0) for i, t in enumerate(texts)]

    cases = [
        words(*[" w"] * 8), words(*[" w"] * 9), words(*[" w"] * 7, " end.", " x"),
        words(" a.", " b"), words(*[" w"] * 7, " c,", " x"), words(*["  "] * 9),
    ]
    rows = T.split_segments(raw(spark, cases)).collect()
    texts = {}
    for r in sorted(rows, key=lambda r: (r.permlink, r.cue_in_seg)):
        texts.setdefault(r.permlink, []).append(r.text)
    assert texts == {
        "v0": ["w w w w w w w w"], "v1": ["w w w w w w w w", "w"], "v2": ["w w w w w w w end.", "x"],
        "v3": ["a. b"], "v4": ["w w w w w w w c,", "x"],
    }


def test_segment_without_words_stays_whole(spark):
    row = [("u", "v", 0, 1.0, 2.0, "  said \n", None), ("u", "v", 1, 2.0, 3.0, " ", None)]
    got = T.split_segments(raw(spark, [[("x", 0.0, 1.0)]]).limit(0).union(spark.createDataFrame(
        row, raw(spark, [[("x", 0.0, 1.0)]]).schema))).orderBy("raw_seg").collect()
    assert [(r.start_s, r.text) for r in got] == [(1.0, "said"), (2.0, "")]


def test_flat_words_give_the_same_cues(spark, monkeypatch):
    segments = raw(spark, sequences(60, 2) + [[(w[0], float(i), i + 1.0) for i, w in enumerate(sum(sequences(30, 6), []))]])
    flat = T.words_of(segments).withColumnRenamed("word_in_seg", "word_idx")
    monkeypatch.setattr(T, "block_of", lambda column: block_of(column, 16))
    left = T.split_segments(segments).orderBy("permlink", "raw_seg", "cue_in_seg").collect()
    right = T.split_words(flat).orderBy("permlink", "raw_seg", "first_word").collect()
    assert [(r.permlink, r.raw_seg, r.start_s, r.end_s, r.text) for r in left] == [
        (r.permlink, r.raw_seg, r.start_s, r.end_s, r.text) for r in right
    ]


def test_flat_words_are_shuffled_once(spark, monkeypatch, capsys):
    """Words without a key are in no cue; a cue that runs over blocks is one; no word is moved alone."""
    monkeypatch.setattr(T, "block_of", lambda column: block_of(column, 4))
    texts = [" a.", *[f" w{i}" for i in range(20)], " b!", " c"]
    rows = [("u", key, 0, i, t, float(i), i + 1.0) for key in ("v", None) for i, t in enumerate(texts)] + [("u", "s", 1, 7, " x", 7.0, 8.0), ("u", "s", 1, 8, " y", 8.0, 9.0)]
    flat = spark.createDataFrame(rows, "author string, permlink string, raw_seg bigint, word_idx int, word string, start_s double, end_s double")
    cues = T.split_words(flat)
    got = sorted((r.permlink, r.first_word, r.start_s, r.end_s, r.text) for r in cues.collect())
    parts = [(1, texts[:1]), (2, texts[1:9]), (10, texts[9:17]), (18, texts[17:22]), (23, texts[22:])]
    want = [("v", n, n - 1.0, n - 1.0 + len(p), "".join(p).strip()) for n, p in parts]
    assert got == [("s", 1, 7.0, 9.0, "x y"), *want]
    cues.explain()
    final = capsys.readouterr().out.split("== Initial Plan ==")[0].splitlines()
    moved = [line for line in final if "Exchange hashpartitioning(author" in line and "ReusedExchange" not in line]
    assert len([line for line in moved if "_block#" in line and "first_word#" not in line]) == 1


def test_long_cue_spacing_is_kept_and_no_word_is_lost(spark):
    made = sequences(100, 3)
    cues = T.split_segments(raw(spark, made)).groupBy("permlink", "raw_seg").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cue_in_seg", "text"))), lambda c: c["text"]), "").alias("t")
    ).collect()
    texts = {(r.permlink, r.raw_seg): "".join(r.t.split()) for r in cues}
    for i, words in enumerate(made):
        assert texts.get((f"v{i % 7}", i // 7), "") == "".join("".join(w[0] for w in words).split())


def test_numbering_and_text(spark):
    cues = T.split_segments(raw(spark, sequences(80, 4)))
    numbered = T.number_cues(cues)
    per_video = {}
    for r in cues.orderBy("permlink", "raw_seg", "cue_in_seg").collect():
        per_video.setdefault(r.permlink, []).append(r.text)
    got = {}
    for r in numbered.orderBy("permlink", "seg_idx").collect():
        assert r.seg_idx == len(got.setdefault(r.permlink, []))
        got[r.permlink].append(r.text)
    assert got == per_video
    joined = {r.permlink: r.transcript for r in T.transcript_text(numbered, block=block_of("seg_idx", 3)).collect()}
    assert joined == {k: " ".join(v) for k, v in per_video.items()}


def test_duration_is_the_last_segment_not_the_longest(spark):
    rows = spark.createDataFrame(
        [("u", "a", 0, 0.0, 100.0, ""), ("u", "a", 1, 1.0, 2.5, ""), ("u", "b", 5, 0.0, 3.5, "")],
        "author string, permlink string, seg_idx bigint, start_s double, end_s double, text string",
    )
    got = {r.permlink: (r.duration_s, r.duration_min, r.video_duration_seconds) for r in T.video_duration(rows).collect()}
    assert got == {"a": (2.5, 2.5 / 60, 2), "b": (3.5, 3.5 / 60, 4)}
    assert T.within(rows, 0).count() == 3 and T.within(rows, 1.0).count() == 2
