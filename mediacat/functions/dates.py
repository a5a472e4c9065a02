"""Date parsing and ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` to a naive timestamp; empty or malformed text gives NULL."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")


def iso(ts: Column) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(full.endswith(".000000"), plain).otherwise(full)


def plain(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
