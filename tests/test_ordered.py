import random

from pyspark.sql import functions as F

from mediacat.operators import ordered as O


def rows(spark):
    """One key holds most rows, indexes have gaps."""
    rng = random.Random(5)
    made = [("hot", i) for i in range(0, 900, 3)] + [(f"k{i % 9}", i) for i in range(120)]
    rng.shuffle(made)
    return made, spark.createDataFrame([(k, i, i * 7 % 11) for k, i in made], "k string, i bigint, v bigint")


def expected(made):
    by_key = {}
    for key, i in sorted(made):
        by_key.setdefault(key, []).append(i)
    return by_key


def test_number_rows(spark):
    made, df = rows(spark)
    got = {(r.k, r.i): r.n for r in O.number_rows(df, ["k"], ["i"], O.block_of("i", 16), "n").collect()}
    assert got == {(k, i): n for k, order in expected(made).items() for n, i in enumerate(order, 1)}


def test_next_value(spark):
    made, df = rows(spark)
    got = {(r.k, r.i): r.nxt for r in O.next_value(df, ["k"], ["i"], O.block_of("i", 16), "v", "nxt").collect()}
    want = {}
    for key, order in expected(made).items():
        for i, after in zip(order, order[1:] + [None]):
            want[(key, i)] = None if after is None else after * 7 % 11
    assert got == want


def test_join_facts(spark):
    made, df = rows(spark)
    facts = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, fact int")
    got = sorted((r.k, r.i, r.fact) for r in O.join_facts(df, facts, ["k"], O.block_of("i", 16)).collect())
    assert got == sorted((k, i, {"hot": 1, "k3": 2}[k]) for k, i in made if k in ("hot", "k3"))
    semi = O.join_facts(df, facts.select("k"), ["k"], O.block_of("i", 16), "left_semi")
    assert semi.columns == df.columns and semi.count() == len(got)


def test_a_large_key_is_spread_even_when_rows_come_placed_by_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("'hot' k", "id i").repartition(8, "k")
        at = O.block_of("i", 100)
        gathered = O.gather_blocks(df, ["k"], ["i"], at, F.col("i"))
        numbered = O.number_rows(df, ["k"], ["i"], at, "n")
        for spread in (gathered, numbered):
            assert spread.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_join_texts(spark):
    made, df = rows(spark)
    text = F.col("i").cast("string")
    got = {r.k: r.t for r in O.join_texts(df, ["k"], ["i"], O.block_of("i", 16), text, "-", "t").collect()}
    assert got == {k: "-".join(map(str, order)) for k, order in expected(made).items()}


def test_position_over_the_whole_table(spark):
    made, df = rows(spark)
    placed = O.position(df, [F.desc("v"), F.col("k"), F.col("i")], "p")
    want = sorted(((k, i) for k, i in made), key=lambda x: (-(x[1] * 7 % 11), x[0], x[1]))
    assert [(r.k, r.i) for r in placed.orderBy("p").collect()] == want
    assert sorted(r.p for r in placed.collect()) == list(range(1, len(made) + 1))
    assert O.position(df.where("false"), [F.col("i")], "p").count() == 0


def test_a_list_is_not_copied_to_salts_that_no_row_has(spark, capsys):
    df = spark.createDataFrame([("hot", i) for i in range(300)] + [("k1", 1), ("k2", 2), (None, 3), ("k1", 1)], "k string, i bigint")
    listed = spark.createDataFrame([("hot", 1), ("k2", 2), ("none", 3), (None, 4)], "k string, fact int")
    made = {how: O.join_list(df, listed if how == "left" else listed.select("k"), "k", ["i"], how, salts=64)
            for how in ("left", "left_anti", "left_semi")}
    want = [(r.k, r.i) for r in df.collect()]
    facts = {"hot": 1, "k2": 2}
    by_text = lambda rows: sorted(rows, key=str)
    assert by_text((r.k, r.i, r.fact) for r in made["left"].collect()) == by_text((k, i, facts.get(k)) for k, i in want)
    assert by_text(map(tuple, made["left_anti"].collect())) == by_text(x for x in want if x[0] not in facts)
    assert by_text(map(tuple, made["left_semi"].collect())) == by_text(x for x in want if x[0] in facts)
    for rows in made.values():
        rows.explain()
        assert "explode" not in capsys.readouterr().out  # 64 copies of each listed key before


def test_a_list_that_looks_small_is_not_broadcast(spark, capsys):
    """The size of a list is estimated; one that is scanned and filtered can be far larger than its estimate."""
    df = spark.range(2000).selectExpr("concat('k', id % 50) k", "id i")
    listed = spark.range(100).where("id % 9 = 1").selectExpr("concat('k', id) k", "true listed")
    for how in ("left", "left_anti"):
        made = O.join_list(df, listed if how == "left" else listed.select("k"), "k", ["i"], how, salts=8)
        n = made.where("listed").count() if how == "left" else 2000 - made.count()
        assert n == 6 * 40
        made.explain()
        assert "Broadcast" not in capsys.readouterr().out


def test_rows_that_look_small_are_not_broadcast_to_their_facts(spark, capsys):
    """Rows that are exploded out of a few long ones have the estimate of those."""
    df = spark.range(40).selectExpr("concat('k', id % 4) k", "explode(sequence(0, 99)) i")
    facts = spark.range(3).selectExpr("concat('k', id) k", "id fact")
    for how, some in (("inner", facts), ("left_semi", facts.select("k"))):
        made = O.join_facts(df, some, ["k"], O.block_of("i", 16), how)
        assert made.count() == 3 * 1000
        made.explain()
        assert "Broadcast" not in capsys.readouterr().out
