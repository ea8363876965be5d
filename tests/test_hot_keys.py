"""No task gets the rows of a key that holds a third of a ledger."""

import statistics

import pytest
from pyspark.sql import functions as F
from task_rows import shuffled_rows, stages_of

from ledgerproof.operators.difference import nonzero_difference_by


@pytest.fixture
def eight_tasks(spark):
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("group", [None, "g"])
def test_an_id_with_many_amounts_is_many_keys(spark, eight_tasks, group):
    rows = 60_000
    ledger = spark.range(rows, numPartitions=4).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END").alias("k"),
        F.expr("'m' || id % 4").alias("by"),
        F.expr("'g' || id % 5").alias("g"),
        F.expr("CAST(id AS STRING) || '.25'").alias("amount"),
    )
    with stages_of(spark) as stages:
        found = nonzero_difference_by(
            ledger,
            ledger,
            left_key="k",
            left_amount=F.col("amount"),
            right_key="k",
            right_amount=F.col("amount"),
            by="by",
            right_group=group,
        ).collect()
    hot = rows // 3
    per_method = hot // 4
    if group is None:  # every hot row differs from all hot rows but itself
        assert {r.by: r.cnt for r in found} == {f"m{i}": per_method * (hot - 1) for i in range(4)}
    else:  # five sums, none of which is an amount
        assert {r.by: r.cnt for r in found} == {f"m{i}": per_method * 5 for i in range(4)}
    wide = [rows_ for s in stages if sum(rows_ := shuffled_rows(spark, s)) > rows // 2]
    assert wide
    for of_tasks in wide:
        assert max(of_tasks) < 2 * statistics.median(of_tasks), of_tasks
