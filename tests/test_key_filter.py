"""Joins behind a Bloom filter: exact rows, and few of them shuffled."""

import pytest
from pyspark.sql import functions as F

from mediacat.operators import key_filter

KEY = ["author", "permlink"]
SCHEMA = "author string, permlink string, n int"


def sides(spark):
    rows = [(f"u{i % 50}", f"p{i}", i) for i in range(4000)] + [(None, "p1", -1), ("u1", None, -2), ("u7", "p7", -3)]
    keys = [(f"u{i % 50}", f"p{i}") for i in range(0, 4000, 20)] + [("x", "y"), (None, "p1"), ("u7", "p7"), ("u7", "p7")]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(keys, "author string, permlink string")


@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_exact_whatever_the_size_of_the_filter(spark, words):
    rows, keys = sides(spark)
    for mine, how in ((key_filter.anti_join, "left_anti"), (key_filter.semi_join, "left_semi")):
        assert sorted(map(str, mine(rows, keys, KEY, words).collect())) == sorted(map(str, rows.join(keys, KEY, how).collect()))
    assert key_filter.build(keys, KEY, words).count() <= words


def test_few_rows_go_through_the_join(spark):
    """200 of 4,000 keys match; with enough words hardly any other row is held back for the join."""
    rows, keys = sides(spark)
    maybe = key_filter.marked(rows, key_filter.build(keys, KEY), KEY).where("_maybe").count()
    true = rows.join(keys, KEY, "left_semi").count()
    assert true <= maybe <= true + 20
    crowded = key_filter.marked(rows, key_filter.build(keys, KEY, 1), KEY, 1).where("_maybe").count()
    assert crowded > 3000


def test_a_row_that_has_no_partner_is_not_shuffled(spark):
    rows, keys = sides(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = key_filter.anti_join(rows, keys, KEY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    passed = plan[plan.index("Union"):]
    first = passed[: passed.index("SortMergeJoin")]
    assert "BroadcastHashJoin" in first and "Exchange hashpartitioning(author" not in first


def test_nothing_on_either_side(spark):
    rows, keys = sides(spark)
    assert key_filter.anti_join(rows, keys.limit(0), KEY).count() == rows.count()
    assert key_filter.anti_join(rows.limit(0), keys, KEY).collect() == [] == key_filter.semi_join(rows, keys.where(F.lit(False)), KEY).collect()
