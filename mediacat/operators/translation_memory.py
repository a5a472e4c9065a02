"""Translations kept across passes, so that the model sees a unit once.

A unit is a text with its source and target language. Units live in a :class:`..sinks.part_store.PartStore`
under a hash of their content, spread over a fixed number of buckets: a pass asks only the buckets
its units fall in, and adds what was new as one part. A unit that failed is not kept, so a later
pass tries it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import TRANSLATION_BATCH
from ..session import shared_folder
from ..sinks.part_store import Manifest, PartStore
from .translation import UNIT, Translate, translate_distinct

SCHEMA = "bucket int, unit binary, text string, source_language string, language string, translated string"
BUCKETS = 256


def unit_id() -> Column:
    """Hash of a unit: lengths keep its parts apart."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in UNIT]
    return F.unhex(F.sha2(F.concat_ws("\x1f", *[F.length(p).cast("string") for p in parts], *parts), 256))


class TranslationMemory:
    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS, fanout: int = 4):
        self.buckets = buckets
        # Sorted by bucket, a file's statistics tell which buckets it has.
        self.store = PartStore(spark, base, SCHEMA, self._thin, fanout)

    @staticmethod
    def _thin(rows: DataFrame, live: DataFrame, now: Manifest) -> DataFrame:
        fields = [f.strip().split()[0] for f in SCHEMA.split(",")]
        rest = [c for c in fields if c not in ("bucket", "unit")]
        one = rows.groupBy("bucket", "unit").agg(F.min(F.struct(*rest)).alias("_u")).select("bucket", "unit", "_u.*")
        return one.repartitionByRange("bucket", "unit").sortWithinPartitions("bucket", "unit")

    def _named(self, units: DataFrame) -> DataFrame:
        return units.withColumn("unit", unit_id()).withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(self.buckets).cast("long")).cast("int"))

    def translate(
        self, fanned: DataFrame, translate: Translate, batch: int = TRANSLATION_BATCH, partitions: int | None = None, version: int | None = None,
    ) -> DataFrame:
        """(text, source_language, language, translated, error) of every unit of ``fanned``; the model
        is asked for those no earlier pass has. The same version again asks for nothing."""
        shared_folder(fanned.sparkSession)
        units = self._named(fanned.where(F.col("language") != F.col("source_language")).select(*UNIT).distinct()).checkpoint()
        wanted = [r["bucket"] for r in units.select("bucket").distinct().collect()]  # at most as many as there are buckets
        known = self.store.rows().where(F.col("bucket").isin(wanted)) if wanted else self.store.rows().limit(0)
        held = known.select("bucket", "unit", "translated")
        new = units.join(held.select("bucket", "unit"), ["bucket", "unit"], "left_anti")
        answers = translate_distinct(new, translate, batch, partitions).checkpoint()
        made = self._named(answers.where(F.col("error").isNull())).select("bucket", "unit", *UNIT, "translated")
        found = units.join(held, ["bucket", "unit"]).select(*UNIT, "translated", F.lit(None).cast("string").alias("error")).checkpoint()
        self.store.commit(made, self.store.newest.version + 1 if version is None else version)
        return found.unionByName(answers.select(*found.columns))
