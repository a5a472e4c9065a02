"""Seconds <-> ``HH:MM:SS,mmm``.

Milliseconds are truncated in binary floating point (1.001 s gives ``,000``), so
seconds stay DOUBLE and are never cast to DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_millis(seconds: Column) -> Column:
    whole = F.floor(seconds)
    return whole * 1000 + F.floor((seconds % 1) * 1000)


def _two(n: Column) -> Column:
    digits = n.cast("string")
    return F.when(n < 10, F.concat(F.lit("0"), digits)).otherwise(digits)


def millis_to_timecode(ms: Column) -> Column:
    def div(c: Column, n: int) -> Column:
        return F.call_function("div", c, F.lit(n))

    secs = div(ms, 1000)
    return F.concat(
        _two(div(secs, 3600)), F.lit(":"),
        _two(div(secs, 60) % 60), F.lit(":"),
        _two(secs % 60), F.lit(","),
        F.lpad((ms % 1000).cast("string"), 3, "0"),
    )


def to_timecode(seconds: Column) -> Column:
    return millis_to_timecode(to_millis(seconds))


def timecode_to_millis(timecode: Column) -> Column:
    part = F.split(timecode, "[:,]")

    def n(i: int) -> Column:
        return F.get(part, F.lit(i)).try_cast("bigint")

    return ((n(0) * 60 + n(1)) * 60 + n(2)) * 1000 + n(3)


def timecode_to_seconds(timecode: Column) -> Column:
    ms = timecode_to_millis(timecode)
    return F.call_function("div", ms, F.lit(1000)).cast("double") + (ms % 1000).cast("double") / 1000.0
