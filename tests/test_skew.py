"""A key with a third of all rows, joined without any broadcast."""

import pytest
from pyspark.sql import functions as F

from mediacat.operators import selection, translation

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    """Sides count as large, partitions as skewed at test size."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df, capsys):
    rows = len(df.collect())
    df.explain("formatted")
    return rows, capsys.readouterr().out


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_a_popular_author_is_salted(spark, no_broadcast):
    videos = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("author"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("permlink"),
    )
    authors = spark.range(2000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("author"))
    left = selection.without_blacklisted(videos, authors, videos.where("permlink like '%99'"))
    assert left.count() == sum(1 for i in range(60000) if i % 100 != 99 and (i % 3 == 0 or i >= 2000))
    flagged = selection.flag_creators(videos, authors)
    assert flagged.where("is_priority").count() == sum(1 for i in range(2000) if i % 3)
    assert flagged.count() == 60000 and largest_share(flagged) < 0.2


def test_a_shared_text_is_split(spark, no_broadcast, capsys):
    fanned = spark.range(0, 60000, 1, 8).select(
        F.lit("u").alias("author"), F.col("id").cast("string").alias("permlink"), F.col("id").alias("seg_idx"),
        F.when(F.col("id") % 3 == 0, "a line that very many segments have in common")
        .otherwise(F.concat(F.lit("line "), F.col("id").cast("string"))).alias("text"),
        F.lit("en").alias("source_language"), F.lit("fr").alias("language"),
    )
    done = translation.translate_segments(fanned, lambda texts, s, t: [f"<{x}>" for x in texts])
    rows, plan = final_plan(done, capsys)
    assert rows == 60000 and done.where("text not like '<%>'").count() == 0
    assert "skew" in plan.lower()
