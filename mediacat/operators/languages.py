"""Target languages of a video and the fan-out of its segments over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import FALLBACK_LANGUAGE
from ..functions.language_codes import is_mapped, script_code
from ..sources.catalog import KEY
from ..sources.tables import Language, codes, languages_array
from .ordered import block_of, join_facts


def _allowed(lang, minutes):
    unlimited = F.coalesce(lang["max_duration"], F.lit(0.0)) == 0
    return unlimited | (minutes <= lang["max_duration"])


def eligible_languages(durations: DataFrame, languages: Sequence[Language]) -> DataFrame:
    """One row per video and language its length allows (``duration_min``)."""
    fit = F.filter(languages_array(languages), lambda x: _allowed(x, F.col("duration_min")))
    return durations.select(*KEY, "duration_min", F.explode_outer(fit).alias("_l")).where(
        F.col("_l").isNotNull()
    ).select(
        *KEY, "duration_min", F.col("_l.ord").alias("ord"), F.col("_l.code").alias("language")
    )


def skipped_languages(durations: DataFrame, languages: Sequence[Language]) -> DataFrame:
    """Number of languages a video is too long for."""
    unfit = F.filter(languages_array(languages), lambda x: ~_allowed(x, F.col("duration_min")))
    return durations.select(*KEY, F.size(unfit).cast("bigint").alias("n_skipped"))


def existing_languages(subtitles: DataFrame) -> DataFrame:
    return subtitles.select(*KEY, "language").distinct()


def fully_done(subtitles: DataFrame, languages: Sequence[Language]) -> DataFrame:
    """Videos that have every configured language; length limits play no part here."""
    wanted = codes(languages)
    return (
        existing_languages(subtitles)
        .where(F.col("language").isin(*wanted))
        .groupBy(*KEY).count()
        .where(F.col("count") == len(set(wanted)))
        .select(*KEY)
    )


def remaining_languages(
    durations: DataFrame, languages: Sequence[Language], subtitles: DataFrame
) -> DataFrame:
    """Eligible languages a video does not have yet; ``ord`` keeps the configured order."""
    return eligible_languages(durations, languages).join(
        existing_languages(subtitles), [*KEY, "language"], "left_anti"
    )


def with_targets(
    segments: DataFrame, targets: DataFrame, carry: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Segments with the target languages of their video as one short array (distinct
    codes, so no longer than the language list). ``carry`` names columns of ``targets``
    that are constant per video and go along."""
    lists = (
        targets.select(*KEY, *carry, "ord", "language").distinct()
        .groupBy(*KEY, *carry)
        .agg(F.array_sort(F.collect_list(F.struct("ord", "language"))).alias("targets"))
    )
    return join_facts(segments, lists, KEY, block_of("seg_idx") if block is None else block)


def per_target(segments: DataFrame) -> DataFrame:
    """One row per segment and target language."""
    return (
        segments.select("*", F.explode_outer("targets").alias("_t"))
        .where(F.col("_t").isNotNull())
        .withColumn("language", F.col("_t.language"))
        .drop("targets", "_t")
    )


def fan_out(
    segments: DataFrame, targets: DataFrame, carry: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Every segment once per target language of its video. Segments are multiplied only
    after they have been shuffled."""
    return per_target(with_targets(segments, targets, carry, block))


def detected_language(videos: DataFrame, languages: Sequence[Language], column: str = "lang") -> DataFrame:
    """Detected language, or the fallback when it is not configured."""
    known = F.col(column).isin(*codes(languages))
    return videos.withColumn(
        "source_language", F.when(known, F.col(column)).otherwise(F.lit(FALLBACK_LANGUAGE))
    )


def with_script_codes(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """Script-tagged code of a language column, and whether the code was known."""
    return rows.withColumn(f"{prefix}_code", script_code(F.col(column))).withColumn(
        f"{prefix}_is_mapped", is_mapped(F.col(column))
    )
