"""Near copies by SimHash: generalised pigeonhole search over 64-bit fingerprints.

Fingerprints within ``radius`` bits are linked; documents of a connected set of links form a
component. Bits that go together are put in one part. If part i may differ in t_i bits and
the t_i sum to radius - parts + 1, two linked fingerprints are within t_i in some part i.
The number of parts and the t_i are those of least estimated work, found by dynamic
programming. Each distinct fingerprint is looked up in every part by its own bits and by those with up to
t_i bits turned; what meets is compared in full.

Only distinct fingerprints meet, and a meeting gives the edges of a spanning forest instead
of all its pairs. A meeting of many fingerprints is dealt out as pairs of blocks.

Defined cases: a text that is null, empty or white space has fingerprint zero and is linked
like any other. Rows without an id are left out. Repeated rows come out once for each row. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .tables import stored
from .words import shingle_spans, split_words, text_slices

BITS = 64
SEED = 42
# Cost of a row that is shuffled and sorted, in comparisons of two fingerprints.
ROW_COST = 300.0
BLOCK = 2048

# Lane j of an entry holds bit j of the byte, so 255 entries can be summed without overflow.
LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view(np.uint64).ravel()


def fingerprint(texts: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint of each text as a signed number."""
    words = split_words(texts)
    joined, begin, end = words.spaced()
    first, last, bounds = shingle_spans(words.texts, shingle)
    spans = zip(begin[first].tolist(), end[last].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(first))
    out = np.zeros((len(bounds) - 1, 8), np.uint8)
    total = np.diff(bounds)
    some = np.flatnonzero(total)
    if len(some):
        runs = -(-total[some] // 255)
        run_at = np.concatenate([[0], np.cumsum(runs)])
        start = np.repeat(bounds[some], runs) + 255 * (np.arange(run_at[-1]) - np.repeat(run_at[:-1], runs))
        by_byte = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            lanes = np.add.reduceat(LANES[by_byte[:, k]], start).view(np.uint8).reshape(-1, 8)
            count = np.add.reduceat(lanes.astype(np.int64), run_at[:-1], axis=0)
            out[some, k] = np.packbits(2 * count > total[some, None], axis=1, bitorder="little").ravel()
    return out.view(np.int64).ravel()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) for each row of ``docs`` that has an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fingerprint(rows.column(1), shingle))], ["doc_id", "fp"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# ---- the plan: parts and thresholds ----


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int = -1  # -1: not looked up


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set."""

    def run(batches):
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fps = batch.column(0).to_numpy().astype(np.int64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total, both = total + len(fps), both + bits.T @ bits
        i, j = np.indices(both.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1).astype(np.int32)), pa.array(np.append(j, -1).astype(np.int32)),
             pa.array(np.append(both.ravel(), total).astype(np.int64))], ["i", "j", "n"])

    rows = nodes.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    total, both = 0, np.zeros((BITS, BITS))
    for i, j, n in rows.collect():  # 64 x 64 + 1 rows
        if i < 0:
            total = n
        else:
            both[i, j] = n
    return total, both


def correlated_parts(total: int, both: np.ndarray, parts: int) -> list[Part]:
    """Bits in ``parts`` parts of nearly equal width, correlated bits together."""
    share = both.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    related = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, found = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        members = [min(free, key=lambda b: (abs(share[b] - 0.5), b))]
        free.remove(members[0])
        while len(members) < width:
            nearest = max(sorted(free), key=lambda b: related[b, members].sum())
            members.append(nearest)
            free.remove(nearest)
        found.append(Part(tuple(sorted(members))))
    return found


def project(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The named bits of each fingerprint, packed."""
    out = np.zeros(len(fps), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def collisions(nodes: DataFrame, groups: list[list[Part]]) -> dict[tuple[int, int], float]:
    """Pairs of fingerprints that are equal in a part, for the parts of several groupings."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for g, parts in enumerate(groups):
                for k, part in enumerate(parts):
                    key, n = np.unique(project(fps, part.bits), return_counts=True)
                    size = len(key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, g, np.int32)), pa.array(np.full(size, k, np.int32)),
                         pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["g", "k", "key", "n"])

    rows = nodes.select("fp").mapInArrow(run, "g int, k int, key long, n long")
    same = rows.groupBy("g", "k", "key").agg(F.sum("n").cast("double").alias("n"))
    found = same.groupBy("g", "k").agg(F.sum(F.expr("n * (n - 1) / 2")).alias("pairs")).collect()
    return {(r.g, r.k): r.pairs for r in found}


def within(part: Part, total: int, both: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... bits of a part, bits taken as independent."""
    chance = np.ones(1)
    for b in part.bits:
        p = both[b, b] / max(total, 1)
        chance = np.convolve(chance, [p * p + (1 - p) * (1 - p), 2 * p * (1 - p)])
    return np.cumsum(chance)


def allocate(parts: list[Part], cost: list[list[float]], radius: int) -> tuple[float, list[Part]]:
    """Thresholds of least cost that sum to radius - parts + 1; cost[i][t + 1] is that of t in part i."""
    best = {0: (0.0, [])}
    for row in cost:
        grown: dict[int, tuple[float, list[int]]] = {}
        for spent, (sofar, chosen) in best.items():
            for t1, more in enumerate(row):
                at = spent + t1
                if at <= radius + 1 and (at not in grown or grown[at][0] > sofar + more):
                    grown[at] = (sofar + more, [*chosen, t1 - 1])
        best = grown
    price, chosen = best[radius + 1]  # each threshold plus one: together radius + 1
    return price, [Part(p.bits, t) for p, t in zip(parts, chosen)]


def plan(nodes: DataFrame, radius: int, choices: tuple[int, ...] = (2, 3, 4, 5)) -> list[Part]:
    total, both = bit_counts(nodes)
    groups = [correlated_parts(total, both, m) for m in choices]
    equal, best = collisions(nodes, groups), None
    for g, parts in enumerate(groups):
        cost = []
        for k, part in enumerate(parts):
            chance = within(part, total, both)
            row, probes = [0.0], 0
            for t in range(min(radius, 3) + 1):
                probes += comb(len(part.bits), t)
                pairs = equal.get((g, k), 0.0) * chance[t] / max(chance[0], 1e-300)
                row.append(probes * total * ROW_COST + min(pairs, total * total / 2))
            cost.append(row)
        price, chosen = allocate(parts, cost, radius)
        if best is None or price < best[0]:
            best = (price, chosen)
    return best[1]


# ---- probing and verifying ----


def turned(width: int, threshold: int) -> np.ndarray:
    """Masks that turn 0 to ``threshold`` of ``width`` bits; the first turns none."""
    masks = [np.zeros(1, np.uint64)]
    one = np.uint64(1) << np.arange(width, dtype=np.uint64)
    for _ in range(threshold):
        masks.append(np.unique((masks[-1][:, None] ^ one).ravel()))
    flat = np.concatenate(masks)
    count = np.bitwise_count(flat)
    flat = np.unique(flat[count <= threshold])
    return flat[np.argsort(np.bitwise_count(flat), kind="stable")]


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among some fingerprints."""
    n = len(fps)
    if n <= 256:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        if near.sum() == n:
            return np.zeros(0, int), np.zeros(0, int)
    rest, parents, children = np.arange(n), [], []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            hit = np.bitwise_count(fps[rest] ^ fps[at]) <= radius
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                parents.append(np.full(len(found), at))
                children.append(found)
                front.extend(found.tolist())
    if not parents:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(parents), np.concatenate(children)


def links(nodes: DataFrame, parts: list[Part], radius: int, block: int = BLOCK) -> DataFrame:
    """(a, b): edges between the node numbers of linked fingerprints, enough to connect them."""
    used = [(k, p.bits, turned(len(p.bits), p.threshold)) for k, p in enumerate(parts) if p.threshold >= 0]

    def emit(batches):
        for batch in batches:
            for rows in (batch.slice(i, 20_000) for i in range(0, batch.num_rows, 20_000)):
                fps, node = rows.column(0).to_numpy().astype(np.int64), rows.column(1).to_numpy()
                for k, bits, masks in used:
                    key = project(fps.view(np.uint64), bits)
                    for place in range(0, len(masks), 64):
                        some = masks[place : place + 64]
                        probe = np.ones((len(some), len(fps)), np.int8)
                        probe[0] = place > 0
                        size = probe.size
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(size, k, np.int8)), pa.array((some[:, None] ^ key).ravel().view(np.int64)),
                             pa.array(probe.ravel()), pa.array(np.tile(fps, len(some))), pa.array(np.tile(node, len(some)))],
                            ["k", "key", "probe", "fp", "node"])

    rows = nodes.select("fp", "node").mapInArrow(emit, "k byte, key long, probe byte, fp long, node long")
    index = nodes.select("fp").mapInArrow(lambda b: own_keys(b, used), "k byte, key long, n long")
    busy = (index.groupBy("k", "key").agg(F.sum("n").alias("n")).where(F.col("n") > block)
            .select("k", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    # Blocks i and j of a busy key meet in task (i, j); a probe meets each block in (i, i).
    dealt = rows.join(busy, ["k", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.select("k", "key", "fp", "node", "own", "probe", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "k", "key", "fp", "node",
        F.when(F.col("probe") == 1, F.col("other")).otherwise(F.least("own", "other")).alias("x"),
        F.when(F.col("probe") == 1, F.col("other")).otherwise(F.greatest("own", "other")).alias("y"),
    )
    met = dealt.repartition("k", "key", "x", "y").sortWithinPartitions("k", "key", "x", "y")

    def verify(batches):
        for fps, node in meetings(batches):
            a, b = forest(fps.view(np.uint64), radius)
            a, b = node[a], node[b]
            other = a != b
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[other]), pa.array(np.minimum(a, b)[other])], ["a", "b"])

    return met.mapInArrow(verify, "a long, b long").distinct()


def own_keys(batches, used):
    for batch in batches:
        fps = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
        for k, bits, _ in used:
            key, n = np.unique(project(fps, bits), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), k, np.int8)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "key", "n"])


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints and nodes of each run of equal (k, key, x, y) with two rows or more."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (0, 1, 4, 5)])
        held.append((key, batch.column(2).to_numpy(), batch.column(3).to_numpy()))
        if (key[:, -1] == held[0][0][:, -1]).all() and len(held) > 1:
            continue  # the run goes on
        keys, fps, nodes = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
        cut = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, keys.shape[1])
        start = 0
        for stop in cut[:-1]:
            if stop - start > 1:
                yield fps[start:stop], nodes[start:stop]
            start = stop
        held = [(keys[:, start:], fps[start:], nodes[start:])]
    if held:
        fps, nodes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        if len(fps) > 1:
            yield fps, nodes


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) for each row; component_id is the smallest id in reach."""
    marked = stored(fingerprints(docs, doc_id, text, shingle))
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("node")))
    found = connected(links(nodes, plan(nodes, radius), radius, block), "a", "b")
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
