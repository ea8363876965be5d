"""Spreading hot keys must not change any result."""

import pytest
from pyspark.sql import functions as F

from ledgerproof.operators.skew import spread_join


@pytest.fixture(scope="module")
def sides(spark):
    keys = ["hot"] * 500 + ["warm"] * 40 + [f"k{i}" for i in range(60)] + [None] * 300
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "lk string, n int").repartition(6)
    right = spark.createDataFrame(
        [("hot", "a"), ("hot", "b"), ("k1", "c"), ("k2", "d"), ("unseen", "e"), (None, "f")],
        "rk string, tag string",
    )
    return left, right


@pytest.fixture
def splitting(spark):
    """Partitions count as skewed from a few kilobytes on, and nothing is broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_same_rows_as_a_plain_join(sides, splitting, how):
    left, right = sides
    plain = left.join(right, F.col("lk") == F.col("rk"), how)
    spread = spread_join(left, right, "lk", "rk", how)
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_a_right_join_is_refused(sides):
    with pytest.raises(ValueError, match="left side"):
        spread_join(*sides, "lk", "rk", "full")


def tasks_of(joined):
    """Rows of each key in each task of the join."""
    stored = joined.withColumn("part", F.spark_partition_id()).groupBy("lk", "part").count()
    return [(r.lk, r["count"]) for r in stored.collect()]


@pytest.mark.parametrize("how", ["left", "left_anti", "inner"])
def test_every_hot_key_is_spread(spark, splitting, how):
    """One key with a third of the rows, 300 others that are hot alike, and rows without key."""
    n = 300_000
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("h"), F.hash("id") % 300))
        .when(F.col("id") % 6 == 2, F.concat(F.lit("k"), F.col("id")))
    )
    left = spark.range(0, n, 1, 16).select(key.alias("lk"), F.repeat(F.lit("x"), 20).alias("pad"))
    names = spark.range(50).select(F.concat(F.lit("k"), F.col("id") * 6 + 2).alias("rk"))
    right = names.union(spark.createDataFrame([("hot",)], "rk string")) if how == "inner" else names
    found = tasks_of(spread_join(left, right, "lk", "rk", how))
    hot = [c for k, c in found if k == "hot"]
    assert sum(hot) == n / 3 and len(hot) >= 4 and max(hot) <= n / 12
    if how != "inner":
        none = [c for k, c in found if k is None]
        assert sum(none) == n / 6 and len(none) > 8
        heavy = {}
        for k, c in found:
            if k and k.startswith("h") and k != "hot":
                heavy[k] = max(heavy.get(k, 0), c)
        assert len(heavy) > 290 and max(heavy.values()) < n / 100


def test_nothing_runs_before_the_join(spark, sides):
    """Building the join starts no job."""
    tracker, group = spark.sparkContext.statusTracker(), "skew-probe"
    spark.sparkContext.setJobGroup(group, group)
    spread_join(*sides, "lk", "rk", "left")
    assert not tracker.getJobIdsForGroup(group)
