"""Configuration as plain lists, and as tables where a job wants to join them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import astuple, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed_values import MAX_TAGS, MAX_WORDS, MIN_CONFIDENCE, SAMPLE_SECONDS
from .tables import Language, Tag


@dataclass(frozen=True)
class Config:
    languages: list[Language] = field(default_factory=list)
    tags: list[Tag] = field(default_factory=list)
    gateways: list[str] = field(default_factory=list)
    max_tags: int = MAX_TAGS
    min_confidence: float = MIN_CONFIDENCE
    use_sample: bool = True
    sample_seconds: float = SAMPLE_SECONDS
    max_words: int = MAX_WORDS


def from_mapping(values: Mapping) -> Config:
    """A parsed configuration file (nested mapping)."""
    tagging = values.get("tagging", {})
    speech = values.get("models", {}).get("whisper", {})
    return Config(
        languages=[
            Language(i, x["code"], x.get("max_duration")) for i, x in enumerate(values.get("languages", []))
        ],
        tags=[Tag(i, label) for i, label in enumerate(values.get("tags", []))],
        gateways=list(values.get("ipfs", {}).get("gateways", [])),
        max_tags=tagging.get("max_tags", MAX_TAGS),
        min_confidence=tagging.get("min_confidence", MIN_CONFIDENCE),
        use_sample=tagging.get("use_transcript_sample", True),
        sample_seconds=tagging.get("sample_duration", SAMPLE_SECONDS),
        max_words=speech.get("max_words_per_segment", MAX_WORDS),
    )


def languages_table(spark: SparkSession, config: Config) -> DataFrame:
    return spark.createDataFrame(
        [astuple(x) for x in config.languages], "ord int, code string, max_duration double"
    )


def tags_table(spark: SparkSession, config: Config) -> DataFrame:
    return spark.createDataFrame([(x.ord, x.label) for x in config.tags], "ord int, label string")


def gateways_table(spark: SparkSession, config: Config) -> DataFrame:
    return spark.createDataFrame(list(enumerate(config.gateways)), "ord int, url string")
