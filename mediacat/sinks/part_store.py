"""A keyed table that micro-batches add to, kept as levelled parts that a manifest names.

Every batch adds one part of level 0. ``fanout`` parts of a level become one part of the next,
so after n batches at most ``fanout - 1`` parts of each of log(n) levels are live. A batch
takes effect with its manifest, one small file written last: what has no manifest was never
there, and a repeated batch is recognised by its number. Manifests go round a ring of
``ring`` folders and a part's folder is used again only when no manifest of the ring names
it. So space is bounded without deleting anything, and a reader may go on with the parts of
an older manifest while newer ones are written.

There is one writer. The batch numbers are those of a stream whose checkpoint lies beside the store.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "version long, slots array<int>, levels array<int>, seen timestamp_ntz, totals map<string, long>"


@dataclass
class Manifest:
    """Live parts after a batch, the latest moment seen, and running totals."""

    version: int = -1
    slots: list[int] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    seen: object = None
    totals: dict[str, int] = field(default_factory=dict)


#: Rows of a part from the rows it is made of and all live rows, as far as the batch has come.
Thin = Callable[[DataFrame, DataFrame, Manifest], DataFrame]


class PartStore:
    def __init__(self, spark: SparkSession, base: str, schema: str, thin: Thin, fanout: int = 4, ring: int = 8,
                 options: dict[str, str] | None = None):
        self.spark, self.base, self.thin, self.fanout, self.ring, self.options = spark, base, thin, fanout, ring, options or {}
        self.schema = T.StructType.fromDDL(schema)
        try:
            found = spark.read.schema(MANIFEST).parquet(f"{base}/manifest").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            found = []
        self.manifests = {r["version"]: Manifest(r["version"], r["slots"], r["levels"], r["seen"], dict(r["totals"] or {})) for r in found}

    @property
    def newest(self) -> Manifest:
        return self.manifests[max(self.manifests)] if self.manifests else Manifest()

    def path(self, slot: int) -> str:
        return f"{self.base}/parts/slot={slot}"

    def part(self, *slots: int) -> DataFrame:
        """Rows of some parts. Their folders are named one by one, so no listing of the rest is needed."""
        if not slots:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.path(s) for s in slots])

    def rows(self, manifest: Manifest | None = None) -> DataFrame:
        """Rows of all live parts, as they are stored."""
        return self.part(*(manifest or self.newest).slots)

    def _free(self, taken: set[int]) -> int:
        used = taken.union(*[m.slots for m in self.manifests.values()])
        return next(s for s in range(len(used) + 1) if s not in used)

    def commit(self, rows: DataFrame, version: int, seen=None, count: Callable[[DataFrame, DataFrame], dict[str, int]] | None = None) -> Manifest:
        """Add a batch. ``count`` tells from the rows before and the batch's part how the totals change."""
        before = self.newest
        if version <= before.version:  # it was committed before its stream knew
            return before
        latest = max((m for m in (before.seen, seen) if m is not None), default=None)
        now = Manifest(version, list(before.slots), list(before.levels), latest, dict(before.totals))
        taken: set[int] = set()

        def write(part: DataFrame, level: int) -> int:
            slot = self._free(taken)
            taken.add(slot)
            part.select(*self.schema.names).write.options(**self.options).mode("overwrite").parquet(self.path(slot))
            now.slots.append(slot)
            now.levels.append(level)
            return slot

        new = write(self.thin(rows, self.rows(before).unionByName(rows.select(*self.schema.names)), now), 0)
        if count:
            for name, n in count(self.rows(before), self.part(new)).items():
                now.totals[name] = now.totals.get(name, 0) + n
        level = 0
        while now.levels.count(level) >= self.fanout:
            merged = [s for s, of in zip(now.slots, now.levels) if of == level]
            live = list(now.slots)
            write(self.thin(self.part(*merged), self.part(*live), now), level + 1)
            kept = [(s, of) for s, of in zip(now.slots, now.levels) if s not in merged]
            now.slots, now.levels = [s for s, _ in kept], [of for _, of in kept]
            level += 1
        row = [(now.version, now.slots, now.levels, now.seen, now.totals)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/ring={version % self.ring}")
        self.manifests[version] = now
        self.manifests.pop(version - self.ring, None)
        return now
