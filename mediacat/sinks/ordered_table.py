"""A table stored in a total order, read by place or by key without sorting it again.

Rows go through one range shuffle and are written as one file for each range, sorted, each
with its ``place`` in the file. An index beside them has a row for each file: how many rows are before it and
the key it begins with. A page asks the index for the files it needs (one or two, whatever
its depth) and reads those alone; parquet statistics on ``place`` leave out the rest of a
file. A table is written once under a path of its own; a newer one is another path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLACE, RANGE, POSITION = "_place", "_range", "position"
ROWS_PER_RANGE = 200_000
_IN_PARTITION = (1 << 33) - 1


@dataclass(frozen=True)
class By:
    """A column of an order. Missing values come first, or last where ``descending``."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc_nulls_last(self.column) if self.descending else F.asc_nulls_first(self.column)

    def beyond(self, value) -> Column:
        """Whether a row's value comes after the given one."""
        column = F.col(self.column)
        if value is None:
            return F.lit(False) if self.descending else column.isNotNull()
        return (column.isNull() | (column < value)) if self.descending else (column > value)


def after_key(order: Sequence[By], key: Sequence) -> Column:
    """Whether a row comes after the row with ``key`` in the order."""
    found = F.lit(False)
    for by, value in reversed(list(zip(order, key))):
        found = F.coalesce(by.beyond(value), F.lit(False)) | (F.col(by.column).eqNullSafe(F.lit(value)) & found)
    return found


class OrderedTable:
    """Rows at ``path`` in the order they were written in."""

    def __init__(self, spark: SparkSession, path: str, order: Sequence[By]):
        self.spark, self.path, self.order = spark, path, list(order)
        self.index = spark.read.parquet(f"{path}/index")

    @staticmethod
    def write(rows: DataFrame, path: str, order: Sequence[By], rows_per_range: int = ROWS_PER_RANGE) -> OrderedTable:
        """Store ``rows``, a table or something cheap to read twice: its size sets the number of ranges."""
        spark, order = rows.sparkSession, list(order)
        ranges = max(1, -(-rows.count() // rows_per_range))
        sort = [by.sort() for by in order]
        number = F.monotonically_increasing_id()
        (
            rows.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
            .withColumn(RANGE, F.spark_partition_id()).withColumn(PLACE, number.bitwiseAND(F.lit(_IN_PARTITION)))
            .write.mode("overwrite").parquet(f"{path}/rows")
        )
        # The first row of a file holds its first key; the window sees one row for each file.
        written = spark.read.parquet(f"{path}/rows").select("*", F.col("_metadata.file_path").alias("_file"))
        files = written.groupBy(RANGE).agg(
            F.count("*").alias("n"), F.min("_file").alias("file"),
            *[F.min_by(by.column, PLACE).alias(f"first_{by.column}") for by in order])
        before = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        files.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/index")
        return OrderedTable(spark, path, order)

    def rows(self) -> DataFrame:
        """All rows with their 1-based ``position``. Bounded broadcast: one row for each file."""
        placed = self.spark.read.parquet(f"{self.path}/rows").join(F.broadcast(self.index.select(RANGE, "before")), RANGE)
        return placed.withColumn(POSITION, F.col("before") + F.col(PLACE) + 1).drop(RANGE, PLACE, "before")

    def _files(self, files: list, schema=None) -> DataFrame:
        if not files:
            return self.spark.read.parquet(f"{self.path}/rows").where(F.lit(False)).withColumn(POSITION, F.lit(0).cast("long")).drop(RANGE, PLACE)
        before = F.create_map(*[F.lit(x) for f in files for x in (f[RANGE], f["before"])])
        read = self.spark.read.parquet(*[f["file"] for f in files])
        return read.withColumn(POSITION, before[F.col(RANGE)] + F.col(PLACE) + 1)

    def between(self, first: int, last: int) -> DataFrame:
        """Rows at the positions ``first`` to ``last``, from the files that hold them."""
        files = self.index.where((F.col("before") < last) & (F.col("before") + F.col("n") >= first)).collect()
        rows = self._files(files)
        if files:  # places reach the scan; a page lies in few files, whose places are told apart by range
            inside = F.lit(False)
            for f in files:
                inside = inside | ((F.col(RANGE) == f[RANGE]) & F.col(PLACE).between(first - 1 - f["before"], last - 1 - f["before"]))
            rows = rows.where(inside).drop(RANGE, PLACE)
        return rows

    def page(self, number: int, size: int) -> DataFrame:
        """Rows of a 1-based page and whether there is a next one (``has_more``)."""
        skip = (number - 1) * size
        total = self.index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return self.between(skip + 1, skip + size).withColumn("has_more", F.lit(total > skip + size))

    def after(self, key: Sequence | None, size: int) -> DataFrame:
        """The ``size`` rows that follow the row with ``key`` (the first ones without a key), whether or not that row is still there."""
        if key is None:
            return self.between(1, size)
        names = [f"first_{by.column}" for by in self.order]
        begins = self.index.select(RANGE, *[F.col(n).alias(by.column) for n, by in zip(names, self.order)])
        # The last file that begins no later than the key, and from there as many as the page needs.
        at = begins.where(~after_key(self.order, key)).agg(F.max(RANGE)).first()[0]
        start = self.index.where(F.col(RANGE) == (at or 0)).select("before", "n").first()
        if start is None:
            return self._files([])
        need = self.index.where((F.col(RANGE) >= (at or 0)) & (F.col("before") < start["before"] + start["n"] + size)).collect()
        rows = self._files(need).where(after_key(self.order, key)).drop(RANGE, PLACE)
        return rows.orderBy(POSITION).limit(size)  # a page: the limit is what is asked for
