"""Faults of conversations, and their cheapest repair.

1. Rows get their facts by expressions; a row whose role and text were seen at an earlier turn
   is marked by a join with the first turn of each text, which splits like any join.
2. Rows without their texts are sorted by conversation and turn in ranges, so a conversation
   of any length spreads over tasks. Each task turns its rows into symbols, in blocks of at
   most ``BLOCK`` rows, and counts faults.
3. A grammar is learned from the distinct symbol sequences of all blocks: rounds of counting
   neighbouring symbols, whose most frequent pairs become rules (Re-Pair). Its size is
   bounded, and what it does not cover stays as it is.
4. Every rule has one matrix (:mod:`.transfer`). A block's matrix is the product of those of
   its compressed symbols, computed once for equal sequences. Blocks of a conversation that
   goes on elsewhere are joined per range, then over ranges, and the best way is handed
   down again; only matrices move.
5. Texts move once: sorted by conversation and turn behind the audit of their block, they
   stream through the digest of the repaired conversation. A conversation's rows pass one
   task there, one at a time, since a SHA-256 is sequential.

Defined cases: a null role or text is one space, as is a null id or turn in the damage hash.
A null conv_id is a conversation; rows with a null turn come first. Rows of one turn come
in the order of their roles and then of the SHA-256 of their texts; equal rows are duplicates.
A row with an empty role has no initial and cannot be kept. A conversation without rows after damage has zeros,
an empty audit and the hash of nothing. Empty tables give none. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import transfer
from .tables import written

BLOCK = 4_096
#: Bounds of the grammar; results do not depend on them.
ROUNDS, RULES_A_ROUND = 6, 32
KNOWN = 50_000

# White space of the definition, and what ends a text.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LAWFUL = {"su", "ua", "au"}

ROWS = ["conv_id", "turn", "role", "text", "copies"]
COUNTS = ["rows", "blank", "duplicate", "truncated", "illegal", "turns"]
BLOCKS = ("conv_id long, range int, number long, goes_on boolean, symbols string, " + ", ".join(f"{c} long" for c in COUNTS) +
          ", low long, high long, first_turn long, last_turn long, first_role string, last_role string, at_turn long, at_role string, at_hash binary")
PARTS = ("conv_id long, range int, " + ", ".join(f"{c} long" for c in COUNTS) + ", low long, high long, first_turn long, last_turn long, "
         "first_role string, last_role string, cost array<long>, rank array<long>")
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
HEADS = f"conv_id long, {FACTS}, audit string"
RESULT = f"conv_id long, {FACTS}, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after hashed damage (``ROWS``); ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _facts(rows: DataFrame) -> DataFrame:
    """Rows without texts: ``hash``, ``kind`` (blank, cut off or neither) and whether the text stood at an earlier turn."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(*ENDS), "k").otherwise("t")
    bare = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("hash"), kind.alias("kind"), "copies")
    place = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    first = (
        bare.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"))
        .agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    return bare.join(first, same, "left").withColumn("later", F.coalesce(place > F.col("first"), F.lit(False))).drop("c", "r", "h", "first")


def _record(ddl: str) -> tuple[list[str], list[pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return [n for n, _ in fields], [kinds[k] for _, k in fields]


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = _record(ddl)
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class _Block:
    """Symbols and counts of at most ``BLOCK`` rows of a conversation."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number, self.symbols, self.counts = conv_id, number, [], Counter()
        self.low = self.high = self.first = self.last = self.at = None

    def add(self, turn, role: str, key: tuple, kind: str, again: bool, before: tuple | None) -> None:
        """``before`` is the turn and role of the conversation's row before this one."""
        initial = role[:1]
        fault = {"b": "blank"}.get(kind) or ("duplicate" if again else "truncated" if kind == "t" else None)
        if fault in ("blank", "duplicate"):
            self.symbols.append(transfer.MUST_GO)
        else:
            symbol = initial if initial and initial in "sua" else "o"
            self.symbols.append(symbol.upper() if fault else symbol)
        self.counts["rows"] += 1
        self.counts[fault or "sound"] += 1
        if before is not None and before[1] + initial not in LAWFUL:
            self.counts["illegal"] += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            if before is None or before[0] != turn:
                self.counts["turns"] += 1
        if self.first is None:
            self.first, self.at = (turn, initial), key
        self.last = (turn, initial)

    def row(self, part: int, goes_on: bool) -> tuple:
        ends = [*(self.first or (None, None)), *(self.last or (None, None))]
        return (self.conv_id, part, self.number, goes_on, "".join(self.symbols), *(self.counts[c] for c in COUNTS), self.low, self.high,
                ends[0], ends[2], ends[1], ends[3], *(self.at or (None, None, None)))


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before, seen, out, number = TaskContext.get().partitionId(), None, None, None, [], 0
        inner = False  # whether the conversation began in this range and has had no block yet
        for batch in batches:
            for conv_id, turn, role, digest, kind, copies, later in zip(*(c.to_pylist() for c in batch.columns)):
                if block is None or conv_id != block.conv_id:
                    if block is not None:
                        out.append(block.row(part, not inner))
                    inner = block is not None
                    number += 1
                    block, before, seen = _Block(conv_id, number), None, None
                for _ in range(copies):
                    if len(block.symbols) == size:
                        out.append(block.row(part, True))
                        inner, number = False, number + 1
                        block = _Block(conv_id, number)
                    key = (turn, role, digest)
                    block.add(turn, role, key, kind, later or key == seen, before)
                    before, seen = (turn, role[:1]), key
            if len(out) > 5_000:
                yield _batch(out, BLOCKS)
                out = []
        if block is not None:
            out.append(block.row(part, True))  # it may go on in the next range
        yield _batch(out, BLOCKS)

    return run


def learned(blocks: DataFrame, rounds: int = ROUNDS, rules: int = RULES_A_ROUND) -> list[str]:
    """Pairs of symbols that are rules, most frequent first in each round; counts cover all blocks."""
    sequences = written(blocks.where(F.length("symbols") > 1).groupBy("symbols").agg(F.count("*").alias("n")))
    pairs: list[str] = []
    for _ in range(rounds):
        known = list(pairs)

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            grammar, found = transfer.Grammar(known), Counter()
            for batch in batches:
                for symbols, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    short, last = grammar.compressed(symbols), ""
                    for i in range(len(short) - 1):
                        pair = short[i : i + 2]
                        if pair == last:  # "aaa" has one pair that can be replaced
                            last = ""
                            continue
                        found[pair] += n
                        last = pair if pair[0] == pair[1] else ""
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"])

        top = sequences.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        new = [r["pair"] for r in top.orderBy(F.desc("n"), "pair").limit(rules).collect()]
        if not new:
            break
        pairs += new
    return pairs


class _Solver:
    """Products of blocks, kept for equal sequences while there is room."""

    def __init__(self, pairs: list[str]):
        self.grammar, self.known = transfer.Grammar(pairs), {}

    def products(self, symbols: str):
        found = self.known.get(symbols)
        if found is None:
            found = self.grammar.products(symbols)
            if len(self.known) < KNOWN and len(symbols) < 64:
                self.known[symbols] = found
        return found

    def whole(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of a conversation that is one block."""
        if not symbols:
            return 0, ""
        short, out = self.products(symbols)
        cost, state = transfer.ended(out[-1])
        return cost, self.grammar.read(short, out, transfer.NONE, state) + transfer.CLOSING[state]


def gaps(low, high, turns: int) -> int:
    return 0 if low is None else int(high) - int(low) + 1 - int(turns)


def _solved(pairs: list[str]):
    """Heads of the conversations that are one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = _Solver(pairs)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                cost, audit = solver.whole(r["symbols"])
                out.append((r["conv_id"], gaps(r["low"], r["high"], r["turns"]), r["blank"], r["duplicate"], r["truncated"], r["illegal"], cost, audit))
            yield _batch(out, HEADS)

    return run


def _plain(value):
    """A value of a pandas row as Python has it."""
    return None if value is None or value is pd.NA or (not isinstance(value, (str, bytes, list, np.ndarray)) and pd.isna(value)) else value


def _parts(pairs: list[str]):
    """Blocks of one conversation in one range as one part: its counts and its matrix."""

    def run(rows: pa.Table) -> pa.Table:
        solver, blocks = _Solver(pairs), sorted(rows.to_pylist(), key=lambda r: r["number"])
        whole = transfer.identity()
        for r in blocks:
            if r["symbols"]:
                whole = transfer.product(whole, solver.products(r["symbols"])[1][-1])
        held = [r for r in blocks if r["rows"]]
        cost, rank = whole.flat()
        told = [r for r in held if r["low"] is not None]
        out = {"conv_id": blocks[0]["conv_id"], "range": blocks[0]["range"], **{c: sum(r[c] for r in blocks) for c in COUNTS},
               "low": told[0]["low"] if told else None, "high": told[-1]["high"] if told else None}
        for name, r in (("first", 0), ("last", -1)):
            out |= {f"{name}_{c}": held[r][f"{name}_{c}"] if held else None for c in ("turn", "role")}
        return _table([out | {"cost": cost, "rank": rank}], PARTS)

    return run


def _table(rows: list[dict], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.table({n: pa.array([r.get(n) for r in rows], kinds[k]) for n, k in fields})


JOINED = "range int, before int, after int, ends boolean, " + HEADS


def _joined(rows: pa.Table) -> pa.Table:
    """Parts of one conversation, one for each range: the states around each on the best way, and one head."""
    parts = sorted(rows.to_pylist(), key=lambda r: r["range"])
    held = [r for r in parts if r["rows"]]
    total = {c: sum(r[c] for r in parts) for c in COUNTS}
    for left, right in zip(held, held[1:]):
        total["illegal"] += left["last_role"] + right["first_role"] not in LAWFUL
        total["turns"] -= left["last_turn"] is not None and left["last_turn"] == right["first_turn"]
    told, conv_id, cost, out = [r for r in held if r["low"] is not None], parts[0]["conv_id"], 0, []
    if held:
        matrices = [transfer.unflat(r["cost"], r["rank"]) for r in held]
        cost, state = transfer.ended(transfer.all_of(matrices))
        for r, (before, after) in zip(held, transfer.way(matrices, transfer.NONE, state)):
            out.append({"range": r["range"], "before": before, "after": after, "ends": r is held[-1], "conv_id": conv_id})
    out.append({"conv_id": conv_id, "gaps": gaps(told[0]["low"], told[-1]["high"], total["turns"]) if told else 0, "cost": cost}
               | {c: total[c] for c in ("blank", "duplicate", "truncated", "illegal")})
    return _table(out, JOINED)


AUDITS = "conv_id long, turn long, role string, hash binary, number long, audit string"


def _read(pairs: list[str]):
    """Audits of the blocks of a part, which the states around it settle."""

    def run(rows: pa.Table) -> pa.Table:
        solver, blocks = _Solver(pairs), [r for r in sorted(rows.to_pylist(), key=lambda r: r["number"]) if r["symbols"]]
        found = [solver.products(r["symbols"]) for r in blocks]
        out = []
        ways = transfer.way([made[-1] for _, made in found], blocks[0]["before"], blocks[0]["after"]) if blocks else []
        for r, (short, made), (before, after) in zip(blocks, found, ways):
            audit = solver.grammar.read(short, made, before, after)
            if r["ends"] and r is blocks[-1]:
                audit += transfer.CLOSING[after]
            out.append({"conv_id": r["conv_id"], "turn": r["at_turn"], "role": r["at_role"], "hash": r["at_hash"],
                        "number": (r["range"] << 40) + r["number"], "audit": audit})
        return _table(out, AUDITS)

    return run


class _Repaired:
    """One conversation as its audit and rows stream past."""

    def __init__(self, conv_id, facts: list, audit: str | None):
        self.conv_id, self.facts, self.state, self.any = conv_id, facts, transfer.NONE, False
        self.sha, self.letters, self.audit = hashlib.sha256(), deque(), []
        self.read(audit or "")

    def read(self, audit: str) -> None:
        self.letters.extend(audit)
        self.audit.append(audit)

    def put(self, role: str, text: str) -> None:
        if self.any:
            self.sha.update(b"\n")
        self.any = True
        self.sha.update(f"{role}:".encode())
        self.sha.update(text.encode())

    def insert(self) -> None:
        while self.letters and self.letters[0] == "I":
            self.letters.popleft()
            self.state = transfer.FOLLOWING[self.state]
            self.put(transfer.NAMES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit = self.letters.popleft()
        if edit == "K":
            self.state = transfer.STATE_OF[role[0]]
            self.put(role, text)
        elif edit == "R":
            self.state = transfer.FOLLOWING[self.state]
            self.put(transfer.NAMES[self.state], text)

    def result(self) -> tuple:
        self.insert()
        return (self.conv_id, *self.facts, "".join(self.audit), self.sha.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted heads, audits and rows, conversation after conversation, into ``RESULT``."""
    now = None
    for batch in batches:
        out = []
        conv, step, role, text, copies, audit = (batch.column(i).to_pylist() for i in (0, 1, 4, 7, 8, 9))
        facts = [batch.column(i).to_pylist() for i in range(10, 16)]
        for i, kind in enumerate(step):
            if kind == 0:
                if now is not None:
                    out.append(now.result())
                now = _Repaired(conv[i], [f[i] for f in facts], audit[i])
            elif copies[i] is None:
                now.read(audit[i])
            else:
                for _ in range(copies[i]):
                    now.row(role[i], text[i])
        yield _batch(out, RESULT)
    if now is not None:
        yield _batch([now.result()], RESULT)


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults and cheapest repair (``RESULT``) of each conversation of ``rows`` (``ROWS``, as :func:`damaged` gives them)."""
    order = ["conv_id", "turn", "role", "hash"]
    facts = written(_facts(rows))
    blocks = written(facts.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select(*order, "kind", "copies", "later").mapInArrow(_blocks(block), BLOCKS))
    pairs = learned(blocks)
    heads = blocks.where("not goes_on").mapInArrow(_solved(pairs), HEADS)
    long = blocks.where("goes_on")
    parts = long.groupBy("conv_id", "range").applyInArrow(_parts(pairs), PARTS)
    joined = written(parts.groupBy("conv_id").applyInArrow(_joined, JOINED))
    states = joined.where("range is not null").select(F.col("conv_id").alias("c"), F.col("range").alias("r"), "before", "after", "ends")
    settled = long.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r"))).drop("c", "r")
    audits = settled.groupBy("conv_id", "range").applyInArrow(_read(pairs), AUDITS)
    all_heads = heads.unionByName(joined.where("range is null").select(*heads.columns))
    names = [f.split()[0] for f in FACTS.split(", ")]
    null = lambda kind: F.lit(None).cast(kind)
    no_facts = [null("long").alias(c) for c in names]
    # Heads come first in a conversation, and an audit before the rows of its block.
    stream = all_heads.select(
        "conv_id", F.lit(0).alias("step"), F.lit(False).alias("told"), null("long").alias("turn"), null("string").alias("role"),
        null("binary").alias("hash"), null("long").alias("number"), null("string").alias("text"), null("int").alias("copies"), "audit", *names,
    ).union(audits.select(
        "conv_id", F.lit(1), F.col("turn").isNotNull(), "turn", "role", "hash", "number", null("string"), null("int"), "audit", *no_facts,
    )).union(rows.where("copies > 0").select(
        "conv_id", F.lit(1), F.col("turn").isNotNull(), "turn", "role", F.unhex(F.sha2("text", 256)), F.lit(1 << 62), "text", "copies",
        null("string"), *no_facts,
    ))
    place = ["conv_id", "step", "told", "turn", "role", "hash", "number"]
    return stream.repartition(F.col("conv_id")).sortWithinPartitions(*place).mapInArrow(_digests, RESULT)
