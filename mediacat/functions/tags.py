"""Tag choice inside one row: an array of (label, score) in, an array of labels out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import CUSTOM_TAG_SLACK


def by_score(scores: Column) -> Column:
    """Best score first, label name second."""
    flipped = F.transform(
        scores, lambda s: F.struct((-s["score"]).alias("loss"), s["label"].alias("label"), s["score"].alias("score"))
    )
    return F.array_sort(flipped)


def chosen(ranked: Column, max_tags: int, min_confidence: float) -> Column:
    """At most ``max_tags`` labels at or above the threshold, else the single best."""
    passed = F.filter(ranked, lambda s: s["score"] >= F.lit(min_confidence).cast("double"))
    kept = F.when(F.size(passed) > 0, F.slice(passed, 1, max_tags)).otherwise(F.slice(ranked, 1, 1))
    return F.transform(kept, lambda s: s["label"])


def with_custom(tags: Column, custom: Column, max_tags: int) -> Column:
    """Append unseen custom tags in order, up to a little over the usual limit."""
    room = F.greatest(F.lit(0), F.lit(max_tags + CUSTOM_TAG_SLACK) - F.size(tags))
    return F.concat(tags, F.slice(F.array_except(custom, tags), F.lit(1), room))
