"""Control totals, duplicates, value counts and other profiles of one table."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import TOTAL, day_of, try_money


def control_totals(df: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Row count and decimal sums of a whole table, as one row."""
    return df.agg(
        F.count("*").alias("cnt"),
        *[F.sum(expr).cast(TOTAL).alias(name) for name, expr in sums.items()],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("cnt"))


def value_counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, cnt) of several columns, from one pass over the table."""
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns)
    )
    return df.select(F.explode(pairs).alias("p")).groupBy("p.column_name", "p.value").agg(F.count("*").alias("cnt"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, cnt) for several tables."""
    counts = [
        df.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def month_histogram(df: DataFrame, text: str) -> DataFrame:
    """Rows per month; rows without a readable date form a group of their own."""
    day = day_of(text)
    return df.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.count("*").alias("record_count")
    )


def amount_by(df: DataFrame, columns: list[str], amount: str, total: str = "total_amount") -> DataFrame:
    """Row count and tolerant sum per combination of columns."""
    return df.groupBy(*columns).agg(
        F.count("*").alias("record_count"), F.sum(try_money(amount)).cast(TOTAL).alias(total)
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")


def duplicates_by(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """How many duplicated key combinations each value of ``by`` has."""
    return duplicates(df, keys).groupBy(by).agg(F.count("*").alias("counters"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; with an order they are always the same ones."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
