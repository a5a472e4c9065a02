"""Text expressions: strip, affix removal, literal corrections, null-safe blanks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import WHITESPACE


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def filled(value: Column) -> Column:
    """True when a value is neither missing nor the empty string."""
    return value.isNotNull() & (value != "")


def without_prefix(text: Column, prefix: str) -> Column:
    rest = text.substr(F.lit(len(prefix) + 1), F.length(text))
    return F.when(text.startswith(prefix), rest).otherwise(text)


def without_suffix(text: Column, suffix: str) -> Column:
    rest = text.substr(F.lit(1), F.length(text) - len(suffix))
    return F.when(text.endswith(suffix), rest).otherwise(text)


def literal_pattern(text: str) -> str:
    """Regex that matches ``text`` itself in any case, in any script."""
    return "(?iu)\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def corrected(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply ordered, case-insensitive, literal replace-all rules.

    Each rule is a call with a constant pattern, which is compiled once in a task.
    """
    for old, new in rules:
        text = F.regexp_replace(text, F.lit(literal_pattern(old)), F.lit(literal_replacement(new)))
    return text
