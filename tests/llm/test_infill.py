import hashlib
import random
import re
from collections import Counter

import pytest

from mediacat.llm import infill

SCHEMA = "doc_id long, text string, row int, piece string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, rate=100, spm_share=50):
    """One row by the definition, character by character."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    drawn = sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm_share else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def rows():
    chance = random.Random(1)
    texts = [None, "", "\n", "\n\n", "one line", "a\nb", "é\nß\n x\n", "has <P> in it\nand more", "x<M>", "<S>\n", "<P", "a\r\nb\r\n", "tail\n"]
    texts += ["".join(chance.choice("ab é\n🙂") for _ in range(chance.randrange(200))) for _ in range(60)]
    texts += ["🙂ü" * 50_000 + "\n" + "x" * 100_000 + "\n" * 1000 + "end"]
    out = [(i, t, 1, "p") for i, t in enumerate(texts)]
    return out + [(None, "no id\nb\nc", 1, None), (None, None, 1, None), (3, "\n\n", 1, "p"), (7, "repeat\nx\ny", 1, "p"), (7, "repeat\nx\ny", 1, "p"), (-5, "a\nb\nc", 0, "")]


@pytest.mark.parametrize("chunk", [1, 5, 64 << 10])
def test_equals_the_definition(spark, chunk):
    """Ties, repeated rows, nulls, marks, clashing column names; pieces shorter than a character too."""
    given = rows() if chunk > 1 else [r for r in rows() if len(r[1] or "") < 500]
    got = infill.transform(spark.createDataFrame(given, SCHEMA).repartition(5), chunk=chunk).collect()
    assert Counter(map(tuple, got)) == Counter(plain(i, t) for i, t, *_ in given)


def test_rates(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    for rate, share in ((0, 50), (40, 0), (70, 100)):
        got = infill.transform(docs, rate=rate, spm_share=share).collect()
        assert Counter(map(tuple, got)) == Counter(plain(i, t, rate, share) for i, t, *_ in rows())


def test_outputs_hold_what_was_hashed(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    texts = infill.outputs(docs)
    assert texts.columns == docs.columns
    assert Counter(sha(r.text) for r in texts.collect()) == Counter(r.output_sha256 for r in infill.transform(docs).collect())


def test_empty_table(spark):
    assert infill.transform(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_moves_once(spark):
    """One exchange: the restoring sort stays in the partitions of the first."""
    plan = infill.transform(spark.createDataFrame(rows(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2
