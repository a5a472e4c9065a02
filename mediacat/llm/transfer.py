"""Cheapest edits of a sequence of rows, as products of small min-plus matrices.

A row is one symbol: ``x`` must go; ``s u a o`` are system, user, assistant and other rows,
and capitals the same with a cut-off text. The states are what came last in the repaired
conversation: nothing, system, user, assistant. A matrix tells for each state before a
sequence and each after it the least cost, and the rank of its audit among the audits that
begin in the same state. Such audits have one letter for each row and end in one, and a
state and an audit give the next state; so two of them differ, none begins another, and
ranks alone settle ties in products. The audit itself is a rope: the state between the two
halves of a product (``middle``), followed down to single rows when it is read.

Symbols of rules begin at ``RULE``; each stands for a pair of earlier symbols.
"""

from __future__ import annotations

NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 60
RULE = 0x100

# Costs of edits, and of keeping a cut-off text.
RENAME, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
MUST_GO = "x"

#: The role that may follow a state, but for a system row at the start.
FOLLOWING = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def after(state: int, initial: str) -> int | None:
    """State after a row that is kept, if it may stand there."""
    role = STATE_OF.get(initial)
    if role == SYSTEM:
        return SYSTEM if state == NONE else None
    return role if role is not None and FOLLOWING[state] == role else None


class Matrix:
    """Costs and ranks by state before and after, and the state between two halves."""

    __slots__ = ("cost", "rank", "middle")

    def __init__(self, cost: list[list[int]], rank: list[list[int]], middle: list[list[int]] | None = None):
        self.cost, self.rank, self.middle = cost, rank, middle

    def flat(self) -> tuple[list[int], list[int]]:
        return [c for row in self.cost for c in row], [r for row in self.rank for r in row]


def unflat(cost, rank) -> Matrix:
    return Matrix([[int(c) for c in cost[4 * i : 4 * i + 4]] for i in STATES], [[int(r) for r in rank[4 * i : 4 * i + 4]] for i in STATES])


def identity() -> Matrix:
    return Matrix([[0 if i == j else FAR for j in STATES] for i in STATES], [[0] * 4 for _ in STATES])


def ranked(keys: list) -> list[int]:
    order = sorted(range(4), key=keys.__getitem__)
    return [order.index(j) for j in STATES]


def product(left: Matrix, right: Matrix) -> Matrix:
    cost, rank, middle = [], [], []
    for i in STATES:
        line, through, keys = [], [], []
        ahead, places = left.cost[i], left.rank[i]
        for j in STATES:
            best = min((ahead[m] + right.cost[m][j], places[m], m) for m in STATES)
            line.append(min(best[0], FAR))
            through.append(best[2])
            keys.append((best[0] >= FAR, places[best[2]], right.rank[best[2]][j]))
        cost.append(line)
        middle.append(through)
        rank.append(ranked(keys))
    return Matrix(cost, rank, middle)


def inserts(before: int, wanted: int) -> int | None:
    """Rows to insert to come from one state to another; two reach any state but the first two."""
    for n in range(3):
        if before == wanted:
            return n
        before = FOLLOWING[before]
    return None


def of_symbol(symbol: str) -> tuple[Matrix, list[list[str]]]:
    """Matrix and audits of a single row: inserts before it, then its own edit."""
    more = CUT_OFF if symbol.isupper() else 0
    cost, audits = [[FAR] * 4 for _ in STATES], [[""] * 4 for _ in STATES]
    for i in STATES:
        found: dict[int, tuple[int, str]] = {}
        for state in STATES:
            n = inserts(i, state)
            if n is None:
                continue
            edits = [(state, DELETE, "D")]
            if symbol != MUST_GO:
                edits.append((FOLLOWING[state], RENAME + more, "R"))
                kept = after(state, symbol.lower())
                if kept is not None:
                    edits.append((kept, more, "K"))
            for out, price, letter in edits:
                way = n * INSERT + price, "I" * n + letter
                found[out] = min(found.get(out, way), way)
        for out, (price, audit) in found.items():
            cost[i][out], audits[i][out] = price, audit
    rank = [ranked([(cost[i][j] >= FAR, audits[i][j]) for j in STATES]) for i in STATES]
    return Matrix(cost, rank), audits


#: Rows to insert after the last state for a lawful end: nothing or an assistant row.
CLOSING = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def ended(whole: Matrix) -> tuple[int, int]:
    """Least cost of a whole conversation and the state after its last row."""
    ways = [(whole.cost[NONE][j] + INSERT * len(CLOSING[j]), whole.rank[NONE][j], j) for j in STATES]
    cost, _, state = min(ways)
    return cost, state


class Grammar:
    """Matrices and audits of symbols; ``pairs`` are the rules, each of symbols before it."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        self.matrices: dict[str, Matrix] = {}
        self.audits: dict[tuple[str, int, int], str] = {}
        for symbol in MUST_GO + "suaoSUAO":
            self.matrices[symbol], audits = of_symbol(symbol)
            self.audits |= {(symbol, i, j): audits[i][j] for i in STATES for j in STATES}
        for number, (left, right) in enumerate(pairs):
            self.matrices[chr(RULE + number)] = product(self.matrices[left], self.matrices[right])

    def compressed(self, symbols: str) -> str:
        for number, pair in enumerate(self.pairs):
            if len(symbols) < 2:
                break
            symbols = symbols.replace(pair, chr(RULE + number))
        return symbols

    def audit(self, symbol: str, before: int, state: int) -> str:
        """The rope of a symbol read once; rules are shared, so are their audits."""
        known = self.audits.get((symbol, before, state))
        if known is None:
            left, right = self.pairs[ord(symbol) - RULE]
            middle = self.matrices[symbol].middle[before][state]
            known = self.audits[symbol, before, state] = self.audit(left, before, middle) + self.audit(right, middle, state)
        return known

    def products(self, symbols: str) -> tuple[str, list[Matrix]]:
        """A sequence compressed, and the products of its first one, two ... symbols."""
        short = self.compressed(symbols)
        out: list[Matrix] = []
        for symbol in short:
            out.append(product(out[-1], self.matrices[symbol]) if out else self.matrices[symbol])
        return short, out

    def read(self, short: str, out: list[Matrix], before: int, state: int) -> str:
        """The audit of a sequence between two states."""
        parts = []
        for place in range(len(short) - 1, 0, -1):
            middle = out[place].middle[before][state]
            parts.append(self.audit(short[place], middle, state))
            state = middle
        if short:
            parts.append(self.audit(short[0], before, state))
        return "".join(reversed(parts))


def way(parts: list[Matrix], before: int, state: int) -> list[tuple[int, int]]:
    """States before and after each part on the best way through all of them."""
    products = [parts[0]]
    for part in parts[1:]:
        products.append(product(products[-1], part))
    out = []
    for place in range(len(parts) - 1, 0, -1):
        middle = products[place].middle[before][state]
        out.append((middle, state))
        state = middle
    return [(before, state), *reversed(out)]


def all_of(parts: list[Matrix]) -> Matrix:
    whole = parts[0]
    for part in parts[1:]:
        whole = product(whole, part)
    return whole
