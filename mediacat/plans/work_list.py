"""The work list: requested items ahead of a stored order of all candidates.

The candidates are sorted once (:class:`..sinks.ordered_table.OrderedTable`). Requests come and
go; a batch of them changes only the head and, for each range of the stored order, how many
of its rows stand in the head. A candidate's place in the list is its stored position, plus the head, less
the requested rows before it: no request sorts the candidates again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import position
from ..operators.selection import work_rank
from ..session import shared_folder
from ..sinks.ordered_table import PLACE, POSITION, RANGE, ROWS_PER_RANGE, By, OrderedTable
from ..sources.catalog import KEY, catalog_rank

ORDER = [By("prio_rank"), By("type_rank"), By("status_rank"), By("created_at"), By("cat_rank"), By("author"), By("permlink")]
COLUMNS = [*KEY, "bucket", "requested_at", "prio_rank", "type_rank", "status_rank", "created_at", POSITION]


class WorkList:
    """Requested items (``bucket`` 0) in the order they were asked for, then the candidates in work order."""

    def __init__(self, spark: SparkSession, path: str):
        self.candidates = OrderedTable(spark, path, ORDER)
        self.head: DataFrame | None = None

    @staticmethod
    def store(candidates: DataFrame, creators: DataFrame, path: str, rows_per_range: int = ROWS_PER_RANGE) -> WorkList:
        ranked = work_rank(candidates, creators).withColumn("cat_rank", catalog_rank())
        shared_folder(ranked.sparkSession)
        rows = ranked.select(*KEY, "prio_rank", "type_rank", "status_rank", "created_at", "cat_rank").checkpoint()
        OrderedTable.write(rows, path, ORDER, rows_per_range)
        return WorkList(rows.sparkSession, path)

    def request(self, queue: DataFrame) -> None:
        """Let ``queue`` (author, permlink, requested_at) be the head from now on. Only the queue is sorted."""
        self.head = position(queue.select(*KEY, "requested_at"), [F.col("requested_at"), *map(F.col, KEY)], POSITION)

    def _moved(self) -> DataFrame:
        """Where the requested keys stand among the candidates: (range, place)."""
        rows = self.candidates.spark.read.parquet(f"{self.candidates.path}/rows")
        return rows.join(self.head.select(*KEY).distinct(), KEY, "left_semi").select(RANGE, PLACE)

    def rows(self) -> DataFrame:
        """The whole list with positions."""
        table = self.candidates
        stored = table.spark.read.parquet(f"{table.path}/rows")
        if self.head is None:
            behind = table.rows().withColumn("bucket", F.lit(1)).withColumn("requested_at", F.lit(None).cast("timestamp_ntz"))
            return behind.select(*COLUMNS)
        n = self.head.agg(F.count("*")).first()[0]
        # One row for each range: what its rows move by because of the ranges before it.
        gone = self._moved().groupBy(RANGE).agg(F.count("*").alias("_gone"))
        before = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        shifts = table.index.join(gone, RANGE, "left").select(
            RANGE, (F.col("before") - F.coalesce(F.sum(F.coalesce("_gone", F.lit(0))).over(before), F.lit(0)) + n).alias("_ahead"))
        # Inside a range rows are counted in their stored order; a range is bounded by construction.
        marked = stored.join(self.head.select(*KEY).distinct().withColumn("_asked", F.lit(1)), KEY, "left")
        inside = W.partitionBy(RANGE).orderBy(PLACE).rowsBetween(W.unboundedPreceding, W.currentRow)
        left = marked.withColumn("_passed", F.sum(F.coalesce("_asked", F.lit(0))).over(inside)).where("_asked is null")
        behind = left.join(F.broadcast(shifts), RANGE).select(
            *KEY, F.lit(1).alias("bucket"), F.lit(None).cast("timestamp_ntz").alias("requested_at"), "prio_rank", "type_rank", "status_rank",
            "created_at", (F.col("_ahead") + F.col(PLACE) + 1 - F.col("_passed")).alias(POSITION))
        ahead = self.head.select(
            *KEY, F.lit(0).alias("bucket"), "requested_at", *[F.lit(None).cast("int").alias(c) for c in ("prio_rank", "type_rank", "status_rank")],
            F.lit(None).cast("timestamp_ntz").alias("created_at"), POSITION)
        return ahead.select(*COLUMNS).unionByName(behind.select(*COLUMNS))

    def first(self, size: int) -> DataFrame:
        """The next ``size`` items, from the head and only the files of the order that can hold them."""
        table = self.candidates
        if self.head is None:
            return table.between(1, size).select(*KEY, F.lit(1).alias("bucket"), POSITION)
        ahead = self.head.where(F.col(POSITION) <= size).select(*KEY, F.lit(0).alias("bucket"), POSITION)
        n = self.head.agg(F.count("*")).first()[0]
        if n >= size:
            return ahead
        # So many candidates are requested at most as the head has; those that are not follow.
        gone = {r[RANGE]: r["n"] for r in self._moved().groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
        need, last = size - n, 0
        for f in table.index.orderBy(RANGE).toLocalIterator():
            last = f["before"] + f["n"]
            need -= f["n"] - gone.get(f[RANGE], 0)
            if need <= 0:
                break
        left = table.between(1, last).join(self.head.select(*KEY).distinct(), KEY, "left_anti").orderBy(POSITION).limit(size - n)
        place = F.row_number().over(W.orderBy(POSITION)) + n  # over the items asked for
        return ahead.unionByName(left.withColumn(POSITION, place.cast("long")).select(*KEY, F.lit(1).alias("bucket"), POSITION))
