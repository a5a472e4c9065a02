import hashlib
import itertools
import random
import re
import zlib

import pytest

from mediacat.llm import conversations, transfer

SCHEMA = "conv_id long, turn long, role string, text string, copies int, kind string"
NEXT, NAMES = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = re.findall("[^\x20\x09-\x0d]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best(rows, kinds):
    """Cost, audit and repaired rows by a search over states, audits held as text."""
    front = {"": (0, "", [])}

    def inserted():
        for state in itertools.chain(*[list(front) + ["s", "u", "a"]] * 3):
            if state in front:
                cost, audit, out = front[state]
                way = cost + 3, audit + "I", out + [(NAMES[NEXT[state]], "")]
                front[NEXT[state]] = min(front.get(NEXT[state], way), way, key=lambda w: w[:2])

    for (_, _, role, text), kind in zip(rows, kinds):
        inserted()
        found = {}
        for state, (cost, audit, out) in front.items():
            ways = [(state, cost + 4, "D", out)]
            if kind not in ("blank", "duplicate"):
                more = 3 * (kind == "truncated")
                ways.append((NEXT[state], cost + 3 + more, "R", out + [(NAMES[NEXT[state]], text)]))
                if role[:1] and (role[:1] == NEXT[state] or role[:1] == "s" and state == ""):
                    ways.append((role[:1], cost + more, "K", out + [(role, text)]))
            for to, price, letter, made in ways:
                way = price, audit + letter, made
                found[to] = min(found.get(to, way), way, key=lambda w: w[:2])
        front = found
    inserted()
    return min((front[s] for s in ("", "a") if s in front), key=lambda w: w[:2])


def plain(rows):
    after, out = damaged(rows), []
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        kinds, repaired, cost, audit = faults(mine), [], 0, ""
        if mine:
            cost, audit, repaired = best(mine, kinds)
            assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def conversation(chance, conv, rows):
    texts = ["Yes.", "No!", "Is it?", "cut off", "", " \n", "Yes. ", "é…", "End.\t", "a:b\nc.", None, "long " * 300 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ass"]
    out, turn = [], 0
    for i in range(rows):
        turn += chance.choice([1, 1, 1, 1, 0, 2])
        role = ("user", "assistant")[i % 2] if chance.random() < 0.7 else chance.choice(roles)
        out.append((conv, None if chance.random() < 0.05 else turn, role, chance.choice(texts) if chance.random() < 0.5 else f"Text {chance.randrange(99999)}."))
    return out


def frame(spark, rows, parts):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("block", [3, 4096])
def test_equals_the_definition(spark, block):
    """Null ids, turns, roles and texts, ties, repeated rows, odd roles, a conversation of half of all rows; blocks that end anywhere."""
    chance = random.Random(block)
    rows = [r for conv in range(60) for r in conversation(chance, conv, chance.randrange(1, 12))] + conversation(chance, None, 9) + conversation(chance, 77, 400)
    rows += rows[:20] + [(1000 + i, i, "user", "One row.") for i in range(60)]
    chance.shuffle(rows)
    got = conversations.repair(conversations.damaged(frame(spark, rows, 6)), block).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
    assert sum(r.audit == "" and r.cost == 0 for r in got) > 0


def test_equal_rows_of_one_conversation(spark):
    """One turn and one text for all: the range sort cannot part them, and one stays."""
    rows = [(3, 1, "user", "Same.")] * 500 + [(4, None, None, None)] * 30
    got = sorted(conversations.repair(conversations.damaged(frame(spark, rows, 4)), 16).collect())
    assert list(map(tuple, got)) == plain(rows)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = conversations.repair(conversations.damaged(table)).collect()
    assert sorted(map(tuple, got), key=str) == plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_empty_table(spark):
    assert conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_grammar_changes_no_audit():
    """Every sequence of four symbols, and long ones, with and without rules."""
    chance, alphabet = random.Random(1), "xsuaoSUAO"
    bare, ruled = transfer.Grammar([]), transfer.Grammar(["ua", chr(0x100) * 2, "xx", "U" + chr(0x101), chr(0x101) + chr(0x102)])
    cases = ["".join(p) for p in itertools.product(alphabet, repeat=4)][::3] + ["".join(chance.choices("uauaxU", k=300)) for _ in range(10)]
    for symbols in cases:
        (short, made), (whole, each) = ruled.products(symbols), bare.products(symbols)
        assert whole == symbols and transfer.ended(made[-1]) == transfer.ended(each[-1])
        state = transfer.ended(made[-1])[1]
        assert ruled.read(short, made, 0, state) == bare.read(whole, each, 0, state)


def test_rules_are_shared_by_frequency(spark):
    rows = [(i, "ua" * 4, 1) for i in range(5)] + [(9, "xs", 1)]
    pairs = conversations.learned(spark.createDataFrame(rows, "conv_id int, symbols string, n int"))
    assert pairs[0] == "ua" and len(transfer.Grammar(pairs).compressed("ua" * 4)) == 1
