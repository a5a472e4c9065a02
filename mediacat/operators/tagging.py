"""Topic tags: classification text, scores, choice.

``score`` is supplied by the user: ``(texts, labels) -> list of score lists``. The
built-in :func:`with_seed_scores` is a stand-in for checks, not a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    DESCRIPTION_ALONE, DESCRIPTION_WITH_SPEECH, FAILED_TAGS, MAX_TAGS, MIN_CONFIDENCE,
    NO_TEXT_TAGS, TRANSCRIPT_UNSAMPLED,
)
from ..functions.tags import by_score, chosen, with_custom
from ..functions.text import strip
from ..sources.tables import Tag

Score = Callable[[list[str], list[str]], Sequence[Sequence[float]]]
# Texts in one call of the scorer.
SCORING_BATCH = 64
SCORES_TYPE = "array<struct<label: string, score: double>>"
SCORES_ARROW = pa.list_(pa.struct([("label", pa.string()), ("score", pa.float64())]))


def _blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def classification_text(rows: DataFrame, sampled: bool = True) -> DataFrame:
    """Text to classify from ``transcript`` and ``description``; NULL when both are blank.

    A sampled transcript is used whole; an unsampled one is shortened by definition.
    """
    speech = F.coalesce("transcript", F.lit(""))
    if not sampled:
        speech = F.substring(speech, 1, TRANSCRIPT_UNSAMPLED)
    about = F.col("description")
    both = F.concat(F.substring(about, 1, DESCRIPTION_WITH_SPEECH), F.lit("\n\n"), speech)
    text = (
        F.when(_blank(about), F.when(_blank(speech), F.lit(None)).otherwise(speech))
        .when(_blank(speech), F.substring(about, 1, DESCRIPTION_ALONE))
        .otherwise(both)
    )
    return rows.withColumn("tag_text", text)


def with_seed_scores(rows: DataFrame, tags: Sequence[Tag], text: str = "tag_text") -> DataFrame:
    """Add stand-in ``scores``: share of the text's tokens that equal a tag's seed word.

    The tokens are a column of their own, so a text is cut once and not once per tag.
    """
    tokens = F.array_remove(F.split(F.col(text), r"\s+"), "")
    size = F.size("_tokens")

    def share(seed: str) -> Column:
        found = size - F.size(F.array_remove(F.col("_tokens"), seed))
        return found.cast("double") / F.greatest(size, F.lit(1))

    scores = F.array(*[
        F.struct(F.lit(tag.label).alias("label"), share(tag.seed).alias("score")) for tag in tags
    ])
    return (
        rows.withColumn("_tokens", tokens)
        .withColumn("scores", F.when(F.col(text).isNotNull(), scores))
        .drop("_tokens")
    )


def _checked(score: Score, texts: list[str], names: list[str]) -> list[list[float] | None]:
    """Scores of each text, None where the scorer fails or does not answer for every label."""
    try:
        found = [[float(v) for v in values] for values in score(texts, names)]
        if len(found) == len(texts) and all(len(values) == len(names) for values in found):
            return found
    except Exception:  # the user's scorer: the text gets the tags of a failure
        pass
    if len(texts) == 1:
        return [None]
    return [_checked(score, [text], names)[0] for text in texts]


def scored_by_hook(
    rows: DataFrame, score: Score, labels: Sequence[str], text: str = "tag_text", batch: int = SCORING_BATCH,
) -> DataFrame:
    """Add ``scores`` from a user's scorer, ``batch`` texts at a time.

    Only these texts are taken out of the rows at a time. Rows without text get NULL, and so do
    texts the scorer fails on: a batch that fails is tried text by text. Give only the key and
    the text; the rest is joined afterwards.
    """
    names = list(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                texts = part.column(text).to_pylist()
                said = [t for t in texts if t is not None]
                found = iter(_checked(score, said, names) if said else [])
                scores = [None if t is None else next(found) for t in texts]
                column = [values and [{"label": n, "score": v} for n, v in zip(names, values)] for values in scores]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(column, SCORES_ARROW)], [*part.schema.names, "scores"])

    schema = rows.schema.simpleString()[len("struct<"):-1]
    return rows.mapInArrow(run, f"{schema}, scores:{SCORES_TYPE}")


def score_map(scores: str | Column) -> Column:
    return F.map_from_entries(scores)


def scores_from_rows(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, label, score) rows to one array per key; copies of a label collapse first,
    so an array is never longer than the label list."""
    best = scores.groupBy(*keys, "label").agg(F.max("score").alias("score"))
    return best.groupBy(*keys).agg(F.collect_list(F.struct("label", "score")).alias("scores"))


def select_tags(
    rows: DataFrame, max_tags: int = MAX_TAGS, min_confidence: float = MIN_CONFIDENCE,
    text: str = "tag_text",
) -> DataFrame:
    """Add ``tags`` and ``reason``: scored, no_text or failed (text without scores)."""
    no_text = F.col(text).isNull()
    failed = F.col("scores").isNull() | (F.size("scores") == 0)
    plain = [F.array(*[F.lit(t) for t in names]) for names in (NO_TEXT_TAGS, FAILED_TAGS)]
    return (
        rows.withColumn("_ranked", by_score(F.col("scores")))
        .withColumn("reason", F.when(no_text, "no_text").when(failed, "failed").otherwise("scored"))
        .withColumn(
            "tags",
            F.when(no_text, plain[0]).when(failed, plain[1])
            .otherwise(chosen(F.col("_ranked"), max_tags, min_confidence)),
        )
        .drop("_ranked")
    )


def add_custom_tags(rows: DataFrame, custom: str, max_tags: int = MAX_TAGS) -> DataFrame:
    return rows.withColumn("tags", with_custom(F.col("tags"), F.col(custom), max_tags))
