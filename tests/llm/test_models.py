import itertools
import math
import zlib
from collections import Counter
from urllib.parse import urlparse

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from mediacat.llm import language, lm, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "    ", "a", " a  b\n c\t", "\n\nx", "▁x 　y ﬁ é <s> </s> <0x41>", "the there these " * 30, "日本語テキスト 日本", "\x00\x01 ~", "x" * 500, " " * 33 + "y" + " " * 15,
         "Ñandú über-straße 12345 !!", "👩‍👩‍👧 𝔘"]


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(1, "", "again")], "doc_id long, text string, n_pieces string")
    rows = pieces.encode(docs, PATH)
    for r in rows.collect():
        assert r.piece_ids == library.encode(r.text or ""), r.text
        assert r.n_pieces == len(r.piece_ids)
    back = pieces.decode(rows.select("doc_id", "piece_ids", F.lit("clash").alias("text")), PATH)
    want = Counter((i, (t or "").replace("▁", " ")) for i, t in enumerate(TEXTS)) + Counter([(1, "")])
    assert Counter((r.doc_id, r.text) for r in back.collect()) == want
    assert all(r.restored == ("▁" not in TEXTS[r.doc_id]) for r in pieces.round_trip(docs.where("doc_id > 0"), PATH).collect())
    assert pieces.encode(docs.limit(0), PATH).collect() == []
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id int, piece_ids array<int>"), PATH).first().text == ""


def test_viterbi_equals_all_segmentations():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.5, "▁a": -3.2, "aba": -4.0, "bab": -9.0}
    numbers = {p: i for i, p in enumerate(scores)}
    held = pieces.model("unigram", scores, numbers, [], 99, [p.encode() for p in scores])
    words = sorted("▁" + "".join(x) for n in range(6) for x in itertools.product("ab", repeat=n)) + ["▁c", "▁ca"]

    def total(parts):
        return sum(scores.get(p, min(scores.values()) - pieces.UNKNOWN_COST) for p in parts)

    def cuts(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if word[:n] in scores or n == 1:
                yield from ([word[:n], *rest] for rest in cuts(word[n:]))

    for word, found in zip(words, pieces.forward(held, words)):
        assert "".join(found) == word and math.isclose(total(found), max(map(total, cuts(word))))


def test_evidence_is_fused(spark):
    en, de = "the cat and the dog with that hat on the mat ", "der hund und die katze mit dem hut auf der matte "
    docs = spark.createDataFrame([(i, (en if i % 2 else de) * 5, "en" if i % 2 else "DE", "s") for i in range(20)] + [(90, None, "en", None), (91, "", None, "s")],
                                 "doc_id long, text string, lang string, source string")
    html = "<html lang='{}'><script>the the the</script><p>{}</p>"
    pages = [(i, f"http://a{i % 3}.site.de/x", html.format("de", de * 3), 0) for i in range(12)]
    pages += [(20 + i, f"https://b{i % 3}.site.com:80/x", html.format("en", en * 3), 0) for i in range(12)]
    pages += [(50, "http://a1.site.de/y", "", 0), (51, None, "<html lang=en>", 0), (52, None, None, 0), (53, "not a url", html.format("xx", en * 9), 0),
              (54, "http://a1.site.de/z", html.format("de", en * 9), 0), (0, pages[0][1], pages[0][2], 0), (None, None, de, 0)]
    rows = language.identify(docs, spark.createDataFrame(pages, "page_id long, url string, html string, language int")).collect()
    assert len(rows) == len(pages) + 22
    got = {r.page_id: r.language for r in rows if r.page_id is not None}
    assert all(got[i] == "de" and got[20 + i] == "en" for i in range(12))
    # No text: the host decides; then the declaration; clear text beats both.
    assert got[50] == "de" and got[51] == "en" and got[53] == "en" and got[54] == "en" and got[52] in ("de", "en")
    assert all(0 < r.confidence <= 1 for r in rows)
    assert all(r.language == ("en" if r.doc_id % 2 else "de") for r in rows if r.doc_id is not None and r.doc_id < 20)
    none = language.identify(docs.limit(0), spark.createDataFrame(pages[:1], "page_id long, url string, html string, language int"))
    assert none.first().language is None


WORDS = "the of in on at ber gol tam rin sel vek mor pan dul kes fim".split()


def corpus(spark, n=160):
    chance = np.random.default_rng(3)
    rows = []
    for i in range(n):
        pool = WORDS[: 10] if i % 2 else WORDS[6:]
        rows.append((i, " ".join(chance.choice(pool) for _ in range(60)), 0))
    rows += [(1000, None, 0), (1001, "", 0), (1002, "Unseen zzz THE", 0), (3, rows[3][1], 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, score int")


def test_base_scores_equal_plain_version(spark):
    rows, docs = corpus(spark)
    counts = Counter()
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _, _ in rows}
    for d, t, _ in rows:
        if not held[d]:
            counts.update([*brute.SPACE.findall(brute.lower(t)), None])
    n, v = sum(counts.values()), len(counts)
    got = lm.score(docs, PATH).collect()
    texts = {d: t for d, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        tokens = [*brute.SPACE.findall(brute.lower(texts[r.doc_id])), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel_tol=1e-9)
        assert r.score < 0
    assert lm.score(docs.limit(0), PATH).collect() == []


def test_gradient_is_the_slope_of_the_loss():
    chance = np.random.default_rng(1)
    w = {k: x.astype(np.float64) for k, x in lm.first_weights(np.zeros(lm.CLASSES, np.float32)).items()}
    inputs, targets = chance.integers(0, 50, (2, lm.WINDOW)), chance.integers(0, lm.CLASSES, (2, lm.WINDOW))
    real = np.ones((2, lm.WINDOW), bool)
    real[1, 5:] = False

    def loss():
        states, _ = lm.attend(w, inputs)
        return -lm.class_logs(w, states, targets)[0][real].mean()

    g = lm.gradient(w, inputs, targets, real)
    for name in lm.SHAPES:
        at = tuple(int(x) for x in np.unravel_index(int(np.abs(g[name]).argmax()), g[name].shape))
        keep, step = w[name][at], 1e-4
        w[name][at] = keep + step
        up = loss()
        w[name][at] = keep - step
        down = loss()
        w[name][at] = keep
        assert math.isclose((up - down) / (2 * step), g[name][at], rel_tol=2e-2, abs_tol=1e-6), name


def test_each_token_is_scored_once_and_folding_changes_nothing():
    ids = np.arange(3, 203, dtype=np.int32)
    bounds = np.array([0, 1, 33, 33 + 32, 200])
    seen = np.zeros(200, int)
    for own, at, real in lm.windows(bounds, 3):
        seen += np.bincount(at[real], minlength=200)
        assert ((at >= bounds[own][:, None]) & (at < bounds[own + 1][:, None])).all()
    assert (seen == 1).all()
    assert [lm.before_each(ids, bounds)[k] for k in (0, 1, 2, 33, 199)] == [lm.BOS, lm.BOS, ids[1], lm.BOS, ids[198]]
    codes = np.array([0, 1, 70_000, 2**30], np.int32)
    assert lm.from_planes(lm.planes(codes)).tolist() == codes.tolist() and len(lm.from_planes(b"")) == 0
    weights = lm.first_weights(np.linspace(-3, 0, lm.CLASSES).astype(np.float32))
    inputs, targets = np.arange(2 * lm.WINDOW).reshape(2, -1), np.arange(2 * lm.WINDOW).reshape(2, -1)
    plain, _ = lm.class_logs(weights, lm.attend(weights, inputs)[0], targets)
    assert np.allclose(plain, lm.window_logs(lm.folded(weights), inputs, targets), atol=1e-4)


def test_training_learns_from_context():
    counts = np.zeros(60)
    counts[3:13] = 1000
    vocabulary = lm.Vocabulary(counts)
    chance, weights = np.random.default_rng(0), lm.first_weights(vocabulary.start)

    def text(n):  # every piece is followed by the next one, mostly
        out = [3]
        for _ in range(n - 1):
            out.append(3 + (out[-1] - 2) % 10 if chance.random() < 0.9 else int(chance.integers(3, 13)))
        return np.array(out, np.int32)

    def parts():
        ids = text(20_000)
        bounds = np.array([0, len(ids)])
        before = lm.before_each(ids, bounds)
        for _, at, real in lm.windows(bounds, 16):
            yield vocabulary.bucket[before[at]], vocabulary.classes[ids[at]], real

    held = text(2000)
    before = lm.text_scores(weights, vocabulary, held, np.array([0, 2000]))
    lm.train_copy(weights, parts())
    after = lm.text_scores(weights, vocabulary, held, np.array([0, 2000]))
    assert after[0] > before[0] / 2


def test_all_training_documents_are_learned_from(spark):
    """Documents that a sample of one in 32 by the id's hash would leave out, and rows without an id."""
    ids = spark.range(400).where("pmod(xxhash64(id), 32) <> 0 and crc32(cast(cast(id as string) as binary)) % 5 <> 1").limit(60)
    text = "repeat('one two three four five ', 400)"
    for docs in (ids.selectExpr("id as doc_id", f"{text} as text"), ids.selectExpr("cast(null as long) as doc_id", f"{text} as text")):
        got = lm.score(docs, PATH).collect()
        assert len(got) == 60 and all(r.score / r.n_tokens > -0.5 for r in got)  # a unigram model has -0.7


def test_scored_tokens_see_a_quarter_of_a_window():
    for own, at, real in lm.windows(np.array([0, 500]), 100):
        assert real[1:, :8].sum() == 0 and real[1:-1, 8:].all()


def test_scores_are_finite_whatever_the_weights():
    vocabulary, weights = lm.Vocabulary(np.ones(60)), lm.first_weights(np.zeros(lm.CLASSES, np.float32))
    for name in ("q", "k", "out"):
        weights[name] = weights[name] * 300
    ids, bounds = np.arange(3, 53, dtype=np.int32), np.array([0, 50])
    assert np.isfinite(lm.text_scores(weights, vocabulary, ids, bounds)).all()
    inputs, targets = np.arange(lm.WINDOW)[None], np.arange(lm.WINDOW)[None]
    assert all(np.isfinite(g).all() for g in lm.gradient(weights, inputs, targets, np.ones((1, lm.WINDOW), bool)).values())


def test_chances_of_the_next_piece_add_up_to_one():
    begins = np.arange(200) % 3 == 0
    vocabulary = lm.Vocabulary(np.arange(200, 0, -1).astype(float), begins)
    weights = lm.first_weights(vocabulary.start)
    ends, goes_on = 0.4, np.where(begins, 0, 1.0)
    goes_on *= 0.6 / goes_on.sum()
    for trust in (0.0, 0.7):
        total = 0.0
        for x in range(200):
            ids, bounds = np.array([3, 4, x], np.int32), np.array([0, 3])
            so = np.array([0.0, 0.0, ends if begins[x] else goes_on[x]])
            spelling = (begins[ids], so, np.array([0.0, 0.0, trust]))
            head = lm.text_scores(weights, vocabulary, ids[:2], np.array([0, 2]), tuple(s[:2] for s in spelling))
            total += 10 ** (lm.text_scores(weights, vocabulary, ids, bounds, spelling) - head)[0]
        assert math.isclose(total, 1, rel_tol=1e-3)


def test_held_out_texts_score_like_the_base_or_better(spark):
    chance = np.random.default_rng(11)
    syllables = "ka to mi ru ze pol dan fes gri hun jat wel".split()
    words = ["".join(chance.choice(syllables, chance.integers(2, 5))) for _ in range(400)]
    odds = 1 / np.arange(1, 401)
    rows = [(i, " ".join(chance.choice(words, 80, p=odds / odds.sum()))) for i in range(300)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PATH).where("held_out").collect()
    assert len(got) > 30 and all(math.isfinite(r.score) for r in got)
    assert sum(r.score for r in got) > 1.02 * sum(r.base_score for r in got)


def test_every_beginning_of_a_word_is_counted(spark, monkeypatch):
    """Rare ones too, also where the words that begin alike lie in several chunks and tasks."""
    monkeypatch.setattr(lm, "CHUNK", 3)
    chance = np.random.default_rng(5)
    words = ["".join(chance.choice(list("abcxyz"), chance.integers(1, 9))) for _ in range(300)] + ["q" * 70, "\x01", "日本語", "Ñandú"]
    counts = {w: int(chance.integers(0, 4)) for w in words}
    library, want = sentencepiece.SentencePieceProcessor(model_file=PATH), Counter()
    for w, n in counts.items():
        ids = tuple(library.encode(w))
        want.update({ids[: k + 1]: n for k in range(min(len(ids), lm.DEPTH))})
        if len(ids) <= lm.DEPTH:
            want[ids, "end"] += n
    rows = spark.createDataFrame([(w.encode(), n) for w, n in counts.items()], "word binary, n long").repartition(5)
    cut = lm.cut_words(rows, PATH)
    assert {r.piece: r.n for r in lm.piece_counts(cut, library.vocab_size()).collect()} == Counter(
        {p: n for p, n in sum((Counter({p: n * c for p, c in Counter(library.encode(w)).items()}) for w, n in counts.items()), Counter()).items() if n})
    monkeypatch.setattr(lm, "SPELLED", 8, raising=False)  # once the most that was kept
    found, edges = lm.spelled(cut, library.vocab_size(), sum(counts.values()))
    found = found.collect()
    assert Counter(bytes(r.word) for r in found) == Counter(w.encode() for w in counts)
    for r in found:
        ids = library.encode(bytes(r.word).decode())
        listed = pa.array([ids], pa.list_(pa.int32()))
        keys = lm.prefix_keys(listed.values.to_numpy(), np.asarray(listed.offsets))
        own = np.frombuffer(r.times, np.int32).astype(np.int64)
        assert lm.times(edges, keys, own[:-1]).tolist() == [want[tuple(ids[: k + 1])] if k < lm.DEPTH else 0 for k in range(len(ids))]
        assert lm.times(edges, lm.end_keys(keys[-1:]), own[-1:]).tolist() == [want[tuple(ids), "end"]]


def test_a_block_is_read_alone_and_written_alone(spark):
    """Long rows: neither a writer nor a reader of their file may hold a hundred of them."""
    rows = spark.range(0, 40, 1, 1).selectExpr("id as block",
                                               "to_binary(array_join(transform(sequence(1, 30000), x -> sha2(cast(id * 100000 + x as string), 256)), ''), 'utf-8') as codes")
    found = [pq.ParquetFile(urlparse(f).path).metadata for f in lm.written(rows, **lm.FILES).inputFiles()]
    assert sum(f.num_rows for f in found) == 40
    assert max(f.row_group(i).num_rows for f in found for i in range(f.num_row_groups)) < 20
    schema = pa.schema([("block", pa.int64()), ("at", pa.int64())])
    batches = [pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(a, pa.int64())], schema=schema)
               for b, a in (([1, 1, 2], [-1, 0, -1]), ([], []), ([2, 2], [0, 1]), ([3], [-1]))]
    assert [t.to_pydict() for t in lm.by_block(batches)] == [
        {"block": [1, 1], "at": [-1, 0]}, {"block": [2, 2, 2], "at": [-1, 0, 1]}, {"block": [3], "at": [-1]}]


def test_only_lengths_of_pieces_with_the_same_end_are_tried():
    """Each length that is tried costs a look; one long piece must not make all characters dear."""

    class Counted(dict):
        looks = 0

        def __contains__(self, key):
            Counted.looks += 1
            return super().__contains__(key)

    made = ["ab", "abc", "abca", "bc", "ca", "caa", "aa", "▁a", "▁ab", "cc" * 8, "cc" * 4, "cc" * 2, "cc"]
    scores = {c: -100.0 for c in "abc▁"} | {piece: -float(i) for i, piece in enumerate(made)}
    held = pieces.model("bpe", Counted(scores), {p: i for i, p in enumerate(scores)}, [], 99, [p.encode() for p in scores])
    words = sorted({"▁" + "".join(w) for n in range(1, 7) for w in itertools.product("abcd", repeat=n)})
    found = pieces.forward(held, words[::7])
    assert found == [held.merged(w) for w in words[::7]]
    Counted.looks, long = 0, "▁" + "abad" * 50
    assert pieces.forward(held, [long]) == [held.merged(long)]
    looks, Counted.looks = Counted.looks, 0
    held.merged(long)
    assert looks - Counted.looks < 4 * len(long)
