"""Correction rules by the thousand, with the result of applying them one after another.

One pattern call for each rule would make the plan and the work grow with the list. Here an
Aho–Corasick automaton over all rules, built once in a task, tells which rules can change a text;
the first of them in the list's order is applied, and a text that changed is looked at again for
the rules after it. Rules match literally and in any case, as in :func:`..functions.text.corrected`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_case(text: str) -> str:
    """Text with every character in one case, character by character, so places stay.

    Two characters are equal in any case if their upper case has the same lower case; those
    whose other case is several characters stand for themselves.
    """
    if text.isascii():
        return text.lower()
    out = []
    for c in text:
        upper = c.upper()
        lower = (upper if len(upper) == 1 else c).lower()
        out.append("i" if c == "İ" else lower if len(lower) == 1 else c)
    return "".join(out)


def corrector(rules: Sequence[tuple[str, str]]) -> Callable[[str], str]:
    """A function that applies all rules in order to a text."""
    import ahocorasick

    places: dict[str, list[int]] = {}
    for place, (old, _) in enumerate(rules):
        if old:
            places.setdefault(fold_case(old), []).append(place)
    machine = ahocorasick.Automaton()
    for word, at in places.items():
        machine.add_word(word, (word, at))
    if places:
        machine.make_automaton()

    def apply(text: str) -> str:
        if not places:
            return text
        folded, last = fold_case(text), -1
        while True:
            next_rule = None
            for _, (word, at) in machine.iter(folded):
                place = next((p for p in at if p > last), None)
                if place is not None and (next_rule is None or place < next_rule[0]):
                    next_rule = place, word
            if next_rule is None:
                return text
            last, word = next_rule
            parts, start = [], 0
            while (found := folded.find(word, start)) >= 0:
                parts += [text[start:found], rules[last][1]]
                start = found + len(word)
            text = "".join([*parts, text[start:]])
            folded = fold_case(text)

    return apply


def corrected_by_many(text: str | Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``text`` after all rules, in Arrow batches. Rules without a text to look for change nothing."""
    listed = [(old, new) for old, new in rules]

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        apply = corrector(listed)
        for texts in batches:
            yield texts.map(apply, na_action="ignore")

    return run(F.col(text) if isinstance(text, str) else text)
