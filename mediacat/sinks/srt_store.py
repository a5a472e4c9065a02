"""SRT texts packed in few files: no file or folder for each document.

A text is stored as it is, whole or in ordered pieces. Each pass adds one part to a
:class:`.part_store.PartStore`; a document that is written again replaces its older text, whatever
pieces that had, and parts merge as they add up. Rows of a part are sorted by document and its
parquet files carry small row groups and Bloom filters on the permlink, so one document is
read from the few groups that can hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.srt import DOCUMENT
from .part_store import Manifest, PartStore

SCHEMA = "author string, permlink string, language string, part int, whole boolean, srt string, version long"
FILES = {"parquet.block.size": str(8 << 20), "parquet.bloom.filter.enabled#permlink": "true", "compression": "zstd"}


class SrtStore:
    def __init__(self, spark: SparkSession, base: str, fanout: int = 4):
        self.store = PartStore(spark, base, SCHEMA, self._thin, fanout, options=FILES)

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        """Rows of the newest version of each document. Documents written once do not move."""
        again = rows.groupBy(*DOCUMENT).agg(F.max("version").alias("_v"), F.min("version").alias("_w")).where("_v <> _w").drop("_w")
        return rows.join(again, DOCUMENT, "left").where("_v is null or version = _v").drop("_v")

    def _thin(self, rows: DataFrame, live: DataFrame, now: Manifest) -> DataFrame:
        return self._newest(rows).sortWithinPartitions(*DOCUMENT, "part")

    def _add(self, rows: DataFrame, version: int | None) -> int:
        version = self.store.newest.version + 1 if version is None else version
        self.store.commit(rows.withColumn("version", F.lit(version).cast("long")).select(*self.store.schema.names), version)
        return version

    def write(self, documents: DataFrame, version: int | None = None) -> int:
        """Add finished texts, one row for each document; the same version again changes nothing."""
        return self._add(documents.select(*DOCUMENT, F.lit(0).alias("part"), F.lit(True).alias("whole"), "srt"), version)

    def write_parts(self, parts: DataFrame, version: int | None = None) -> int:
        """Add texts in ordered pieces (``part``, ``srt``)."""
        return self._add(parts.select(*DOCUMENT, F.col("part").cast("int").alias("part"), F.lit(False).alias("whole"), "srt"), version)

    def parts(self, version: int | None = None) -> DataFrame:
        """All texts in pieces: (document, part, srt), or those of one write; a text that was written whole is one piece."""
        rows = self._newest(self.store.rows())
        return (rows if version is None else rows.where(F.col("version") == version)).select(*DOCUMENT, "part", "srt")

    def documents(self) -> DataFrame:
        """Whole texts, for documents that fit a row; those stored whole are not moved to be put together."""
        rows = self._newest(self.store.rows())
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("part", "srt"))), lambda p: p["srt"])
        joined = rows.where("not whole").groupBy(*DOCUMENT).agg(F.array_join(pieces, "").alias("srt"))
        return rows.where("whole").select(*DOCUMENT, "srt").unionByName(joined)

    def document(self, author: str, permlink: str, language: str) -> DataFrame:
        """The pieces of one document in order; the key reaches the scan."""
        wanted = (F.col("author") == author) & (F.col("permlink") == permlink) & (F.col("language") == language)
        rows = self.store.rows().where(wanted)
        newest = rows.agg(F.max("version").alias("_v"))  # one row
        return rows.join(F.broadcast(newest), F.col("version") == F.col("_v")).select(*DOCUMENT, "part", "srt").orderBy("part")
