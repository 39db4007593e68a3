import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom.operators.joins import hot_keys, salted_left_join, tiled_left_join


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def sides(spark):
    rng = random.Random(3)
    # A third of the rows on one key, a third without a key.
    keys = ["hot"] * 300 + [None] * 300 + [f"k{rng.randint(0, 80)}" for _ in range(300)]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v long")
    one = spark.createDataFrame(
        [("hot", "a"), ("hot", "b"), ("k1", "c"), (None, "d"), ("z", "e")], "k string, x string"
    )
    two = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "k string, y int")
    return left, one, two


@pytest.mark.parametrize("hot_rows", [1, 3, 50, 299, 300, 10_000])
def test_salting_changes_no_row(sides, hot_rows):
    left, one, two = sides
    plain = left.join(one, "k", "left").join(two, "k", "left")
    salted = salted_left_join(left, [one, two], "k", hot_rows)
    assert salted.columns == plain.columns
    assert rows_of(salted) == rows_of(plain)


def test_no_salting_is_a_plain_join(sides):
    left, one, two = sides
    plain = left.join(one, "k", "left").join(two, "k", "left")
    assert rows_of(salted_left_join(left, [one, two], "k", None)) == rows_of(plain)


def test_hot_rows_are_spread(sides):
    left, one, _ = sides
    plan = salted_left_join(left, [one], "k", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    salts = {r[1] for r in hot_keys(left, "k", 50).collect()}
    assert salts == {6}
    assert hot_keys(left, "k", 50).count() == 2


def test_key_column_last(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a")], "v int, k string")
    right = spark.createDataFrame([("a", 9)], "k string, x int")
    got = salted_left_join(left, [right], "k", 1)
    assert rows_of(got.select("v", "k", "x")) == Counter({(1, "a", 9): 1, (2, "a", 9): 1})


def test_nothing_hot_is_a_plain_join(sides):
    left, one, _ = sides
    assert hot_keys(left, "k", 300).isEmpty()
    plan = salted_left_join(left, [one], "k", 300)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan


def test_sketch_finds_a_third_of_the_rows_in_one_pass(spark):
    """Among more distinct keys than the sketch follows."""
    left = spark.range(0, 900_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "id as v")
    found = [tuple(r) for r in hot_keys(left, "k", 10_000).collect()]
    key = spark.sql("select xxhash64('hot')").first()[0]
    assert [k for k, _ in found] == [key] and 25 <= found[0][1] <= 31
    right = spark.createDataFrame([("hot", "a"), ("k1", "b"), ("k1", "c")], "k string, x string")
    got = salted_left_join(left, [right], "k", 10_000)
    assert got.count() == 900_001 and got.where("x is not null").count() == 300_002
    # The rows of the hot key are dealt to many tasks.
    salted = salted_left_join(left, [right], "k", 10_000).where("k = 'hot'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = salted_left_join(left, [right], "k", 10_000).where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert salted.count() == 300_000
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 150_000


def test_hot_list_of_another_table(sides):
    left, one, two = sides
    hot = hot_keys(left, "k", 50)
    plain = left.join(one, "k", "left")
    assert rows_of(salted_left_join(left, [one], "k", None, hot)) == rows_of(plain)


def test_left_side_is_shuffled_once(spark, sides):
    left, one, two = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = salted_left_join(left, [one, two], "k", 50).select(F.count("*"))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange per input by key and salt, the rest count hot keys or the result.
    assert text.count("hashpartitioning(k") == 3
    assert "CartesianProduct" not in text


@pytest.mark.parametrize("hot_rows", [1, 40, 2_000, 10**6, None])
def test_tiles_change_no_row(spark, sides, hot_rows):
    left, one, _ = sides
    # Many rows of a key on both sides, equal ones among them; a key on one side only; no key.
    many = [("hot", f"h{i % 50}") for i in range(60)] + [("k1", "c"), ("k1", "c"), ("z", "e")] * 9
    many = one.unionByName(spark.createDataFrame([*many, (None, None), ("k2", None)], "k string, x string"))
    for a, b in ((left, many), (many, left), (left, many.limit(0)), (left.limit(0), many)):
        plain = a.join(b, "k", "left")
        tiled = tiled_left_join(a, b, "k", hot_rows)
        assert tiled.columns == plain.columns
        assert rows_of(tiled) == rows_of(plain)
