"""Differences between ledgers over matched keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import MONEY, TOTAL, try_money
from .perkey import weighted


def _unreadable(text: Column) -> Column:
    """1 for a text that is no amount, else 0."""
    return (text.isNotNull() & try_money(text).isNull()).cast("int")


def _strictly(value: Column, bad: Column | str) -> Column:
    """The value, or an error if a matched row has an unreadable amount."""
    refused = F.raise_error(F.concat(F.sum(bad).cast("string"), F.lit(" matched amounts are not readable")))
    return F.when(F.sum(bad) > 0, refused.cast("bigint")).otherwise(value)


def matched_difference(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    left_amount: Column,
    right_key: str,
    right_amount: Column,
    right_group: str,
) -> DataFrame:
    """One row: matched pairs, both sums and the sum of the pairwise differences.

    ``right`` is first summed per key and ``right_group``, so a payment booked in
    several parts is compared as a whole. A pair with a missing amount has no
    difference and is left out of ``sum_diff`` only. Amounts are text; one that is no
    number stops the report if its row is matched, and is not looked at otherwise.
    """
    l = (
        left.where(F.col(left_key).isNotNull())
        .select(
            F.col(left_key).alias("k"),
            try_money(left_amount).alias("amount"),
            _unreadable(left_amount).alias("bad"),
        )
        .groupBy("k")
        .agg(
            F.sum("bad").alias("l_bad"),
            F.count("*").alias("l_rows"),
            F.count("amount").alias("l_amounts"),
            F.sum("amount").cast(TOTAL).alias("l_sum"),
        )
    )
    r = (
        right.where(F.col(right_key).isNotNull())
        .select(
            F.col(right_key).alias("k"),
            F.col(right_group).alias("g"),
            try_money(right_amount).alias("amount"),
            _unreadable(right_amount).alias("bad"),
        )
        .groupBy("k", "g")
        .agg(F.sum("amount").cast(TOTAL).alias("amount"), F.sum("bad").alias("bad"))
        .groupBy("k")
        .agg(
            F.sum("bad").alias("r_bad"),
            F.count("*").alias("r_rows"),
            F.count("amount").alias("r_amounts"),
            F.sum("amount").cast(TOTAL).alias("r_sum"),
        )
    )
    pairs = F.coalesce(F.sum(F.col("l_rows") * F.col("r_rows")), F.lit(0)).cast("bigint")
    return l.join(r, "k").agg(
        _strictly(pairs, F.col("l_bad") + F.col("r_bad")).alias("cnt"),
        F.sum(weighted("l_sum", "r_rows")).cast(TOTAL).alias("sum_left"),
        F.sum(weighted("r_sum", "l_rows")).cast(TOTAL).alias("sum_right"),
        F.sum(weighted("l_sum", "r_amounts") - weighted("r_sum", "l_amounts"))
        .cast(TOTAL)
        .alias("sum_diff"),
    )


def nonzero_difference_by(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    left_amount: Column,
    right_key: str,
    right_amount: Column,
    by: str,
    right_group: str | None = None,
) -> DataFrame:
    """Per value of ``by``: the matched pairs whose amounts differ.

    A pair needs both amounts. The differing pairs are all pairs less the equal pairs.
    Equal pairs are counted among the rows of one key and amount, all pairs from the totals
    of a key, so no pair of rows is ever built, whatever the number of rows per key. With
    ``right_group`` the right rows are first summed per key and group. Amounts are text, as
    in :func:`matched_difference`.

    Both ledgers go through the same shuffles: rows are counted per key, amount and ``by``,
    then dealt out by key *and* amount, so that a key with many amounts is many keys. Only
    totals, one row per key and ``by``, are brought together by the key alone.
    """
    l = left.select(
        F.col(left_key).alias("k"),
        F.col(by).alias("by"),
        F.lit(True).alias("left"),
        try_money(left_amount).alias("amount"),
        _unreadable(left_amount).alias("bad"),
    )
    r = right.select(
        F.col(right_key).alias("k"),
        (F.lit(0) if right_group is None else F.col(right_group)).alias("g"),
        try_money(right_amount).alias("amount"),
        _unreadable(right_amount).alias("bad"),
    )
    if right_group is not None:
        r = r.where("k IS NOT NULL").groupBy("k", "g").agg(
            F.sum("amount").cast(MONEY).alias("amount"), F.sum("bad").cast("int").alias("bad")
        )
    r = r.select("k", F.lit(None).cast(l.schema["by"].dataType).alias("by"), F.lit(False).alias("left"), "amount", "bad")
    rows = (
        l.unionByName(r)
        .where("k IS NOT NULL AND (amount IS NOT NULL OR bad > 0)")
        .groupBy("k", "amount", "by", "left")
        .agg(F.count("amount").alias("n"), F.sum("bad").alias("bad"))
    )
    of_right = lambda c: F.when(~F.col("left"), F.col(c))
    alike = F.coalesce(F.sum(of_right("n")).over(Window.partitionBy("k", "amount")), F.lit(0))
    usd = weighted("amount", "n")
    totals = (
        rows.withColumn("alike", alike)
        .groupBy("k", "by", "left")
        .agg(
            F.sum("n").alias("n"),
            F.sum(usd).cast(TOTAL).alias("usd"),
            F.sum("bad").alias("bad"),
            F.sum(F.col("n") * F.col("alike")).alias("equal_pairs"),
            F.coalesce(F.sum(weighted(usd, "alike")), F.lit(0)).cast(TOTAL).alias("equal_usd"),
        )
    )
    key = Window.partitionBy("k")
    return (
        totals.withColumns({f"right_{c}": F.sum(of_right(c)).over(key) for c in ("n", "usd", "bad")})
        .where("left AND right_n IS NOT NULL")
        .groupBy("by")
        .agg(
            _strictly(
                F.sum(F.col("n") * F.col("right_n") - F.col("equal_pairs")).cast("bigint"), F.col("bad") + F.col("right_bad")
            ).alias("cnt"),
            F.sum(weighted("usd", "right_n") - F.col("equal_usd")).cast(TOTAL).alias("sum_left"),
            F.sum(weighted("right_usd", "n") - F.col("equal_usd")).cast(TOTAL).alias("sum_right"),
        )
        .where("cnt > 0")
        .withColumn("sum_diff", (F.col("sum_left") - F.col("sum_right")).cast(TOTAL))
    )
