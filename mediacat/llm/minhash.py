"""Near copies by the similarity of their sets of five words: MinHash bands, every met pair verified.

Texts of the same words are one node. A node has ``BANDS`` keys of ``ROWS`` least hashes each; two nodes
of similarity s share none with chance (1 - s ** ROWS) ** BANDS, that is 3 in a million at 0.8. What
shares a key is verified over the whole sets, unless the numbers of shingles alone exclude the similarity. In two
rounds each key is a star around one node, and a key whose nodes are in one component is closed, so a
large group of copies gives no pairs of all with all. The nodes of the keys that stay open (pages of one template, alike
but not enough) go through a prefix join: of the shingles of a node, rarest first, so many are keys that two
similar nodes must share one. That is exact, and nodes that share only their template share no key.

Pairs that another method has met (``met``) are verified before the first round, so what they link is closed for the rounds.

Only the texts of nodes in some pair are shuffled: the others are kept back by a Bloom filter of bounded size.

Defined cases: texts without words are copies of each other; one with fewer than five words is one shingle. Null
texts have no words. Each row has a component, repeated rows the same one; an empty table has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from mediacat.operators import key_filter

from .components import connected
from .tables import stored
from .words import Words, mix, release, shingle_spans, split_words, text_slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
STARS = 2
SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each shingle of a slice, and the first of each text and the end."""
    first, last, bounds = shingle_spans(words.texts, size)
    joined, begin, end = words.spaced()
    spans = zip(begin[first].tolist(), end[last].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b]) for a, b in spans), np.uint64, len(first)), bounds


def band_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The keys of each text; a text without shingles has those of the largest hash."""
    n = len(bounds) - 1
    keys = np.zeros((n, BANDS), np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    for k, seed in enumerate(SEEDS):
        least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        if len(some):
            least[some] = np.minimum.reduceat(mix(hashes ^ seed), bounds[some])
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] + least + SEEDS[k // ROWS])
    return keys


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """(row, high, low, keys): a hash of the words and the keys of each text."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, limit=1 << 20):
                words = split_words(part.column(1))
                joined, begin, end = words.spaced()
                ends = np.append(begin, len(joined))[words.texts].tolist()
                whole = np.frombuffer(b"".join(xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(ends, ends[1:])), np.int64).reshape(-1, 2)
                hashes, bounds = shingles(words, size)
                keys = band_keys(hashes, bounds).view(np.int64)
                n = [len(np.unique(hashes[a:b])) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(whole[:, 0].copy()), pa.array(whole[:, 1].copy()), pa.array(n, pa.int64()),
                     pa.array(list(keys), pa.list_(pa.int64()))],
                    ["row", "high", "low", "n", "keys"])
            release()

    return rows.mapInArrow(run, "row long, high long, low long, n long, keys array<long>")


def texts_of(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The (row, text) of some rows, and few others; nothing is shuffled."""
    bloom = key_filter.build(nodes, ["row"])
    return key_filter.marked(rows, bloom, ["row"]).where("_maybe").select("row", "text")


def possible(n, m, similarity: float):
    """Whether sets of n and m shingles can be similar; exact, with room for rounding."""
    return F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - 1e-9


def verified(pairs: DataFrame, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are similar. ``pairs`` is a stored table."""
    rows = texts_of(pairs.select(F.col("a").alias("row")).union(pairs.select("b")), rows)
    both = (pairs.join(rows.select(F.col("row").alias("b"), F.col("text").alias("held")), "b")
            .join(rows.select(F.col("row").alias("a"), "text"), "a").select("a", "b", "text", "held"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                ok = np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    texts = pa.array([part.column(2)[i].as_py(), part.column(3)[i].as_py()], pa.string())
                    hashes, bounds = shingles(split_words(texts), size)
                    x, y = np.unique(hashes[: bounds[1]]), np.unique(hashes[bounds[1] :])
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i] = shared >= similarity * max(len(x) + len(y) - shared, 1)
                yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(ok)) for k in (0, 1)], ["a", "b"])
            release()

    return both.mapInArrow(run, "a long, b long")


def prefix_pairs(nodes: DataFrame, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """Pairs (a, b) among ``nodes`` (node, n, component; stored) that may be similar and are in two components.

    The shingles of a node are ordered by the number of nodes that have them. Of two similar sets the larger,
    of n, has a shingle in common with the lesser, of m, among its first n - ceil(s n) + 1, and there among the
    first m - ceil(2 s m / (1 + s)) + 1: else they would share fewer than the similarity s asks for.
    """
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                hashes, bounds = shingles(split_words(part.column(1)), size)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(bounds, bounds[1:])]
                owner = np.repeat(np.asarray(part.column(0)), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))], ["node", "shingle"])
            release()

    held = texts_of(nodes.select(F.col("node").alias("row")), rows).mapInArrow(run, "node long, shingle long")
    sets = stored(held.join(nodes, "node"))
    shared = sets.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = sets.join(shared, "shingle", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("df", F.lit(1)), "shingle")))
    # With room for rounding: a longer prefix loses nothing.
    rest = lambda share: F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    few = F.col("place") <= rest(2 * similarity / (1 + similarity))
    keys = stored(ranked.where((F.col("place") <= rest(similarity)) & F.col("df").isNotNull()).select("shingle", "node", "n", "component", few.alias("few")))
    lesser = keys.where("few").select("shingle", F.col("node").alias("a"), F.col("n").alias("m"), F.col("component").alias("of"))
    in_turn = F.struct("m", "a") < F.struct(F.col("n").alias("m"), F.col("node").alias("a"))
    met = keys.join(lesser, "shingle").where(in_turn & (F.col("component") != F.col("of")) & possible(F.col("n"), F.col("m"), similarity))
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def between_nodes(met: DataFrame, marked: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes that may be similar, from pairs (row, other) of rows."""
    known = marked.select("row", "high", "low").join(nodes, ["high", "low"]).select("row", "node", "n")
    sides = met.join(known, "row").select("other", F.col("node").alias("x"), F.col("n").alias("m")).join(known.withColumnRenamed("row", "other"), "other")
    return sides.where((F.col("x") != F.col("node")) & possible(F.col("n"), F.col("m"), similarity)).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def components(rows: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, met: DataFrame | None = None) -> DataFrame:
    """(row, component) for each of ``rows``, (row long, text string); component is the smallest row in reach.

    ``met`` are pairs (row, other) to verify first; the result does not depend on them.
    """
    marked = stored(sketches(rows, size))
    nodes = stored(marked.groupBy("high", "low").agg(F.min("row").alias("node"), F.min("n").alias("n")))
    each = marked.join(nodes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "n", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    open_keys = stored(each.join(shared, "key"))
    edges = tried = found = None
    if met is not None:
        tried = stored(between_nodes(met, marked, nodes, similarity))
        edges = stored(verified(tried, rows, size, similarity))
        found = connected(edges, "a", "b")
    for turn in range(STARS + 1):
        now = open_keys.withColumn("component", F.col("node"))
        if found is not None:
            known = found.select("node", F.col("component").alias("c"))
            now = open_keys.join(known, "node", "left").select("key", "node", "n", F.coalesce("c", "node").alias("component"))
        order = F.col("node") if turn == 0 else F.xxhash64(F.col("node") + turn)
        stars = (now.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "n", "component")).alias("p"), F.min("component").alias("low"),
                                        F.max("component").alias("high"))
                 .where("low < high").select("key", F.col("p.node").alias("a"), F.col("p.n").alias("m"), F.col("p.component").alias("of")))
        if turn == STARS:
            still = stored(now.join(stars.select("key"), "key", "left_semi").select("node", "n", "component").distinct())
            pairs = prefix_pairs(still, rows, size, similarity)
        else:
            pairs = (now.join(stars, "key").where((F.col("component") != F.col("of")) & possible(F.col("n"), F.col("m"), similarity))
                     .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        more = stored(verified(pairs, rows, size, similarity))
        tried = pairs if tried is None else tried.union(pairs)
        edges = more if edges is None else edges.union(more)
        found = connected(edges, "a", "b")
    named = nodes.join(found, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component"))
    return marked.join(named, ["high", "low"]).select("row", "component")
