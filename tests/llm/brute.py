"""Plain versions of the operators, one text at a time."""

from __future__ import annotations

import hashlib
import re

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, size=4):
    words = SPACE.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def five_words(text):
    words = SPACE.findall(lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def alike(a, b):
    """Whether two sets of shingles have a similarity of 0.8."""
    return 5 * len(a & b) >= 4 * len(a | b)


def components(rows, radius=4, linked=None):
    """{row number: smallest id} for (id, fingerprint) rows; rows are linked by the distance of fingerprints unless told."""
    linked = linked or (lambda a, b: bin(a ^ b).count("1") <= radius)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(rows[i][1], rows[j][1]) or rows[i][0] == rows[j][0]:
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, name), name)
    return [least[root(i)] for i in range(len(rows))]


def base_rules(text):
    text = text or ""
    words = SPACE.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(marked),
            len(words) < 50 or 100 * len(marked) > 50 * len(words))


def hits(text, items, size=10):
    """Hit word numbers and the names of the occurring items."""
    words, hit, names = LETTERS.findall(lower(text)), set(), set()
    for name, item in items:
        item = LETTERS.findall(lower(item))
        windows = {tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))} if item else set()
        for window in windows:
            n = len(window)
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit |= set(range(i, i + n))
                    names.add(str(name))
    return len(words), hit, sorted(names)


def digest(names):
    return hashlib.sha256(",".join(names).encode()).hexdigest()
