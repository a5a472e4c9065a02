"""Order-dependent work that does not put a whole key, or the whole table, in one task.

A key (say one video) may hold a third of all rows. So ordered work is done per
*block* of a key first: a block is any column that never decreases in the wanted
order, such as ``seg_idx div 4096``. Only one small row per block is then looked at
key by key. Rows are placed by (key, block) explicitly, because an input that is already
placed by key alone would otherwise be used as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_folder

BLOCK = 4096


def block_of(column: str, width: int = BLOCK) -> Column:
    return F.expr(f"{column} div {width}")


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str
) -> DataFrame:
    """1-based row number within each key."""
    tagged = df.withColumn("_block", block)
    whole = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(whole), F.lit(0)))
        .drop("_n")
    )
    inside = W.partitionBy(*keys, "_block").orderBy(*order)
    return (
        tagged.repartition(*keys, "_block")
        .withColumn("_pos", F.row_number().over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn(name, (F.col("_before") + F.col("_pos")).cast("bigint"))
        .drop("_block", "_pos", "_before")
    )


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: str, name: str
) -> DataFrame:
    """Value of the following row within each key (NULL for the last row)."""
    tagged = df.withColumn("_block", block)
    first = (
        tagged.groupBy(*keys, "_block")
        .agg(F.min_by(value, order[0] if len(order) == 1 else F.struct(*order)).alias("_first"))
        .withColumn("_ahead", F.lead("_first").over(W.partitionBy(*keys).orderBy("_block")))
        .drop("_first")
    )
    inside = W.partitionBy(*keys, "_block").orderBy(*order)
    return (
        tagged.repartition(*keys, "_block")
        .withColumn("_lead", F.lead(value).over(inside))
        .withColumn("_last", F.lead(F.lit(1)).over(inside).isNull())
        .join(first, [*keys, "_block"])
        .withColumn(name, F.when(F.col("_last"), F.col("_ahead")).otherwise(F.col("_lead")))
        .drop("_block", "_lead", "_last", "_ahead")
    )


def join_facts(
    rows: DataFrame, facts: DataFrame, keys: Sequence[str], block: Column, how: str = "inner", source: DataFrame | None = None,
) -> DataFrame:
    """Join one fact row per key to the many rows of that key.

    The fact is copied to the blocks its key has (one for an ordinary key), so the rows
    of a very large key meet it in many tasks. Neither side is broadcast: rows made out of longer ones, as
    segments out of documents, are measured far below their size. ``source`` has all keys and blocks of the rows, where
    it is cheaper to read: what the rows are made of.
    """
    tagged = rows.withColumn("_block", block)
    known = tagged if source is None else source.withColumn("_block", block)
    placed = known.select(*keys, "_block").distinct().join(facts.hint("merge"), list(keys))
    return tagged.join(placed.hint("merge"), [*keys, "_block"], how).drop("_block")


def join_list(
    rows: DataFrame, listed: DataFrame, key: str, spread_by: Sequence[str], how: str,
    salts: int | None = None,
) -> DataFrame:
    """Join a list of distinct keys to rows of which one key may hold very many.

    Rows are placed by (key, salt); by default there are as many salts as shuffle partitions. A
    listed key is copied only to the salts its rows have, so the copies are never more than the rows, however
    long the list. Spark still broadcasts a list it measures as small. ``rows`` is read twice.
    """
    n = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(n).cast("bigint")))
    copies = salted.select(key, "_salt").distinct().join(listed.hint("merge"), key)
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")


def gather_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: Column
) -> DataFrame:
    """One row per (key, block): ``items``, the ordered values of that block.

    The value is made in a projection of its own, which compiles as a whole; the
    aggregate then only collects.
    """
    pair = F.struct(*order, value.alias("_value")).alias("_pair")
    return (
        df.select(*keys, block.alias("_block"), pair)
        .repartition(*keys, "_block")
        .groupBy(*keys, "_block")
        .agg(F.sort_array(F.collect_list("_pair")).alias("_pairs"))
        .select(*keys, "_block", F.transform("_pairs", lambda p: p["_value"]).alias("items"))
    )


def join_texts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, text: Column,
    separator: str, name: str,
) -> DataFrame:
    """Ordered concatenation per key: blocks first, then the few block texts of a key."""
    parts = gather_blocks(df, keys, order, block, text).select(
        *keys, "_block", F.array_join("items", separator).alias("_text")
    )
    return parts.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_block", "_text"))), lambda p: p["_text"]),
            separator,
        ).alias(name)
    )


def position(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1-based position in a total order over the whole table.

    A range shuffle sorts the rows; the sorted rows are then kept in the shared folder,
    so that a row stays in its partition however often it is read or lost. Each position
    is the row's place in its partition plus the sizes of the partitions before it: one
    row per partition, which is the only thing looked at in a single task.
    """
    shared_folder(df.sparkSession)
    kept = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    tagged = kept.withColumn("_id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_pos", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # Bounded: as many rows as the range shuffle has partitions.
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + F.col("_pos") + 1).cast("bigint"))
        .drop("_id", "_part", "_pos", "_before")
    )
