"""Files with a declared schema, and small configuration lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Parquet, ORC or JSON files; columns a file lacks come back as NULL."""
    return spark.read.schema(schema).format(fmt).load(path)


def spread(rows: DataFrame, pieces: int, *keys: str) -> DataFrame:
    """Deal rows out to ``pieces`` tasks by ``keys``, for costly row work on a scan of few pieces."""
    return rows.repartition(pieces, *keys)


@dataclass(frozen=True)
class Language:
    """A configured language. ``max_duration`` is in minutes; None or 0 is no limit."""

    ord: int
    code: str
    max_duration: float | None = None


@dataclass(frozen=True)
class Tag:
    ord: int
    label: str
    seed: str = ""


def languages_array(languages: Sequence[Language]) -> Column:
    """The configured languages as one literal array of (ord, code, max_duration)."""
    return F.array(*[
        F.struct(
            F.lit(lang.ord).cast("int").alias("ord"),
            F.lit(lang.code).alias("code"),
            F.lit(lang.max_duration).cast("double").alias("max_duration"),
        )
        for lang in languages
    ])


def codes(languages: Sequence[Language]) -> list[str]:
    return [lang.code for lang in sorted(languages, key=lambda x: x.ord)]


def distinct_authors(listed: DataFrame) -> DataFrame:
    return listed.select("author").distinct()


def hotword_prompt(hotwords: DataFrame) -> DataFrame:
    """One row: the vocabulary joined by a comma and a blank, and its size."""
    return hotwords.select("word").distinct().agg(
        F.array_join(F.sort_array(F.collect_list("word")), ", ").alias("prompt"),
        F.count("*").alias("n_words"),
    )


def correction_rules(corrections: DataFrame) -> list[tuple[str, str]]:
    """The moderated rule list in its order: configuration, so it is held by the driver."""
    rows = corrections.select("ord", "from_text", "to_text").orderBy("ord", "from_text").collect()
    return [(row.from_text, row.to_text) for row in rows]
