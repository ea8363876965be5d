"""Joining whole rows when one key may hold a large share of them.

Reports join per-key totals, where a hot key is a single row. Only operators that
return whole rows need the join below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str
) -> DataFrame:
    """Equi-join in which no key of ``left`` ends up in a single task.

    ``right`` must hold few rows per key (distinct keys or per-key totals). Rows without
    key match nothing; they are dealt out by the task that reads them, which a repeated
    task does alike. A hot key is found by its measured size: adaptive execution splits
    every join partition that is larger than the others by ``skewedPartitionFactor``, by
    ranges of the map tasks, and gives each part the few right rows. So nothing has to be
    counted beforehand, there is no list of hot keys and no limit to their number.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"only the left side can be split, not in a {how} join")
    buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = left.withColumn(
        "left_bucket",
        F.when(F.col(left_key).isNull(), F.pmod(F.spark_partition_id(), F.lit(buckets))).otherwise(F.lit(0)),
    )
    # Exploded and not a plain literal, which would turn the second key into a condition.
    joined = dealt.join(
        right.withColumn("right_bucket", F.explode(F.array(F.lit(0)))),
        (F.col(left_key) == F.col(right_key)) & (F.col("left_bucket") == F.col("right_bucket")),
        how,
    )
    return joined.drop("left_bucket", "right_bucket")
