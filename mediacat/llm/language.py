"""Language of web pages and documents, by fusing evidence with Bayes' rule.

Four kinds of evidence are added up as logarithms for each language:
- the text: byte trigrams under a multinomial for each language, counted over all documents whose language
  is given. Neighbouring trigrams are not independent, so a text counts as at most
  ``TEXT_WEIGHT`` of them;
- the language the markup declares, and the suffix of the address: how often pages of each
  language (as their text has it) declare it, or have it;
- the host, as the prior: shares of its pages, smoothed by those of its parent domain, which
  are smoothed by those of all pages. A page does not count towards its own prior.
Declarations, suffixes, domains and hosts are counted by grouped aggregation over all rows.

Defined cases: null or empty text, a missing declaration, address or host give no evidence;
with no evidence at all the language is that of most pages. Repeated rows are counted and
returned as often as they occur. Without training rows of any language the result is
null. Further columns of the input are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored
from .words import LOWER, SLICE_BYTES, text_bytes, text_slices

BUCKETS = 1 << 14
TEXT_WEIGHT = 300.0
SMOOTHING = 0.5
HOST_WEIGHT = 5.0
TRUST = 0.9  # a declaration or suffix that is new says nothing; counts are mixed with this share of what was seen

MARKUP = re.compile(rb"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>|&#?\w{1,10};")


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every three bytes in a row, white space and symbols as blanks, and the first of each text and the end."""
    data, bounds = text_bytes(texts)
    data = LOWER[data]
    letters = (data >= 0x80) | ((data >= 97) & (data <= 122))
    data = np.where(letters, data, 32).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    code = ((data[:-2] << 16) | (data[1:-1] << 8) | data[2:]) * np.uint32(0x9E3779B1)
    inside = np.ones(len(code), bool)
    for back in (1, 2):
        cut = bounds[1:] - back
        inside[cut[(cut >= 0) & (cut < len(code))]] = False
    blank = (data[:-2] == 32) & (data[1:-1] == 32)
    inside &= ~blank
    total = np.concatenate([[0], np.cumsum(inside)])
    return (code[inside] >> np.uint32(18)).astype(np.int64), total[np.minimum(bounds, len(code))]


def without_markup(texts: pa.Array) -> pa.Array:
    return pa.array([b"" if t is None else MARKUP.sub(b" ", t.encode()) for t in texts.to_pylist()], pa.binary())


def language_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, bucket, n) over all rows with a language."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows in text_slices(batch):
                code, bounds = trigrams(rows.column(0))
                names = rows.column(1).to_pylist()
                owner = np.repeat(np.arange(len(names)), np.diff(bounds))
                for name in set(names):
                    own = np.isin(owner, [i for i, x in enumerate(names) if x == name])
                    counts[name] = counts.get(name, 0) + np.bincount(code[own], minlength=BUCKETS)
        for name, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.lower(lang).alias("lang"))
    return rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each bucket in each of them."""
    found = language_counts(docs, text, lang).collect()  # a row for each language and bucket at most
    names = sorted({r.lang for r in found})
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    for r in found:
        counts[r.bucket, names.index(r.lang)] += r.n
    return names, np.log(counts / np.maximum(counts.sum(axis=0), 1e-9)).astype(np.float32)


def likelihoods(rows: DataFrame, model: tuple[list[str], np.ndarray], markup: bool) -> DataFrame:
    """``rows`` with ``text`` replaced by ``ll``: the weighed log likelihood of each language."""
    held = rows.sparkSession.sparkContext.broadcast(model[1])
    columns = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema) + ", ll array<double>"
    size = len(model[0])

    def run(batches):
        table = held.value
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                texts = part.column(len(columns))
                code, bounds = trigrams(without_markup(texts) if markup else texts)
                out = np.zeros((len(bounds) - 1, size))
                for k in range(size):
                    total = np.concatenate([[0.0], np.cumsum(table[code, k], dtype=float)])
                    out[:, k] = total[bounds[1:]] - total[bounds[:-1]]
                n = np.diff(bounds)
                out *= np.where(n > TEXT_WEIGHT, TEXT_WEIGHT / np.maximum(n, 1), 1.0)[:, None]
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, size, dtype=np.int32), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(columns))] + [lists], [*columns, "ll"])

    return rows.select(*columns, "text").mapInArrow(run, schema)


def host_of(url):
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def declared_in(html):
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]{0,400}?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)), F.lit(""))


def counted(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(key, n): rows of each language for each value of a key; row k counts where ``own`` is k."""
    sums = [F.sum(F.when(F.col("own") == k, 1).otherwise(0)) for k in range(size)]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*sums).alias(f"n_{key}"))


def fuse(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` (ll, declared, suffix, host, domain) with ``language`` and ``confidence``."""
    size = len(names)
    if not size:
        return rows.select("*", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"))
    index = lambda array: (F.array_position(array, F.array_max(array)) - 1).cast("int")
    # A row without text has equal likelihoods: it counts for no language.
    own = F.when(F.array_max("ll") == F.array_min("ll"), F.lit(-1)).otherwise(index(F.col("ll")))
    rows = stored(rows.withColumn("own", own))
    whole = rows.agg(*[F.sum(F.when(F.col("own") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(size)]).first()
    totals = [float(whole[k] or 0) for k in range(size)]
    everything = sum(totals)
    out = rows
    for key in ("declared", "suffix", "domain", "host"):
        out = out.join(counted(rows, key, size), key, "left")

    def mine(k):  # a row does not count for itself
        return F.when(F.col("own") == k, 1.0).otherwise(0.0)

    scores = []
    for k in range(size):
        general = (totals[k] + SMOOTHING) / (everything + SMOOTHING * size)
        domain = smoothed("domain", k, size, F.lit(general), mine)
        prior = smoothed("host", k, size, domain, mine)
        score = F.get("ll", F.lit(k)) + F.log(prior)
        for key in ("declared", "suffix"):
            n = F.get(f"n_{key}", F.lit(k)) - mine(k)
            share = (n + SMOOTHING) / (totals[k] - mine(k) + 1.0)
            score += F.when(F.col(key).isNull(), 0.0).otherwise(F.log(share * TRUST + (1 - TRUST)))
        scores.append(score)
    out = out.withColumn("scores", F.array(*scores))
    best = F.array_max("scores")
    total = F.aggregate(F.transform("scores", lambda s: F.exp(s - best)), F.lit(0.0), lambda a, b: a + b)
    listed = F.array(*[F.lit(x) for x in names])
    return out.select(*rows.columns, F.get(listed, index(F.col("scores"))).alias("language"), (1.0 / total).alias("confidence"))


def smoothed(key: str, k: int, size: int, parent, mine):
    """Share of language k among the rows of a key, drawn towards the parent's share."""
    n = F.coalesce(F.get(f"n_{key}", F.lit(k)).cast("double"), F.lit(0.0))
    whole = sum((F.coalesce(F.get(f"n_{key}", F.lit(j)).cast("double"), F.lit(0.0)) for j in range(1, size)),
                F.coalesce(F.get(f"n_{key}", F.lit(0)).cast("double"), F.lit(0.0)))
    known = F.col(f"n_{key}").isNotNull()
    n = F.when(known, n - mine(k)).otherwise(0.0)
    whole = F.when(known & (F.col("own") >= 0), whole - 1.0).otherwise(whole)
    return (n + HOST_WEIGHT * parent) / (whole + HOST_WEIGHT)


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with the columns that ``fuse`` needs besides the likelihoods."""
    host = host_of(url)
    return pages.withColumns({
        "host": host, "declared": declared_in(html),
        "suffix": F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)),
        "domain": F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -2)),
    })


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page_id, declared, host, language, confidence) for all pages and all documents.

    Documents are the training rows; their source stands for the host, and their language
    is what they declare.
    """
    model = train(docs)
    none = F.lit(None).cast("string")
    of_pages = page_evidence(pages).select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), "host", "domain", "suffix", "declared", F.col("html").alias("text"))
    of_docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.concat(F.lit("source:"), "source").alias("host"),
        none.alias("domain"), none.alias("suffix"), F.lower("lang").alias("declared"), "text")
    if not model[0]:
        rows = of_pages.union(of_docs).withColumn("ll", F.array().cast("array<double>")).drop("text")
    else:
        rows = likelihoods(of_pages, model, True).union(likelihoods(of_docs, model, False))
    return fuse(rows, model[0]).select("doc_id", "page_id", "declared", "host", "language", "confidence")
