"""Per-key totals and the weights that replace joined rows.

A join that repeats rows (a bank id that occurs twice, a payment listed twice) is
never carried out row by row. Each side is first reduced to one row per key with a
row count; the counts of the other side then multiply the totals. The figures are
those of the plain join, but a key with n rows here and m rows there costs one row
instead of n x m, and map-side aggregation shrinks a hot key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import TOTAL


def totals_by(
    df: DataFrame, keys: Sequence[Column | str], sums: Mapping[str, Column], rows: str = "rows"
) -> DataFrame:
    """Row count and sums per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias(rows),
        *[F.sum(expr).cast(TOTAL).alias(name) for name, expr in sums.items()],
    )


def distinct_keys(df: DataFrame, key: str, alias: str) -> DataFrame:
    """The keys that occur, once each, without NULL."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias(alias)).distinct()


def with_keys(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """Per-key rows whose key the other side has."""
    return rows.join(others, F.col(key) == F.col(other_key), "left_semi")


def without_keys(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """Per-key rows whose key the other side lacks. A NULL key is kept."""
    return rows.join(others, F.col(key) == F.col(other_key), "left_anti")


def weighted(total: Column | str, weight: Column | str) -> Column:
    """A total as it would come out with each of its rows repeated ``weight`` times."""
    total = F.col(total) if isinstance(total, str) else total
    weight = F.col(weight) if isinstance(weight, str) else weight
    return total * weight.cast("bigint")


def weighted_sum(total: Column | str, weight: Column | str) -> Column:
    return F.sum(weighted(total, weight)).cast(TOTAL)


def weighted_count(rows: Column | str, weight: Column | str) -> Column:
    rows = F.col(rows) if isinstance(rows, str) else rows
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.coalesce(F.sum(rows * weight), F.lit(0)).cast("bigint")
