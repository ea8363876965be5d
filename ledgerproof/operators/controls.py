"""Proofs that figures agree: reported against loaded, and total against its parts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import TOTAL
from ..session import scratch_dir
from .perkey import with_keys, without_keys

# (per-key rows, key, keys of the other side, their name) -> the rows that stay
Match = Callable[[DataFrame, str, DataFrame, str], DataFrame]


def long_metrics(one_row: DataFrame, table: str) -> DataFrame:
    """Turns a one-row frame of figures into (table_name, metric, value) rows."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast(TOTAL).alias("value"))
        for c in one_row.columns
    ]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select(
        F.lit(table).alias("table_name"), "m.metric", "m.value"
    )


def compare_controls(actual: DataFrame, reported: DataFrame) -> DataFrame:
    """Reported figures next to the loaded ones, with difference and verdict.

    Both sides are (table_name, metric, value). A figure that only one side knows
    is listed as missing rather than dropped.
    """
    a = actual.withColumnRenamed("value", "actual")
    r = reported.withColumnRenamed("value", "expected")
    return a.join(r, ["table_name", "metric"], "full").select(
        "table_name",
        "metric",
        "expected",
        "actual",
        (F.col("actual") - F.col("expected")).cast(TOTAL).alias("diff"),
        F.when(F.col("actual").isNull() | F.col("expected").isNull(), "missing")
        .when(F.col("actual") == F.col("expected"), "ok")
        .otherwise("differs")
        .alias("verdict"),
    )


def tie_out(
    payout: DataFrame,
    bank: DataFrame,
    *,
    payout_key: str,
    payout_amount: Column,
    bank_key: str,
    bank_amount: Column,
    bank_group: str,
    match: Match = with_keys,
    differ: Match = without_keys,
) -> DataFrame:
    """Per side: total, matched and unmatched rows and money, what is left over, and
    how many keys occur more than once.

    Each ledger is read once, into one row per key and one for the whole ledger, which are
    written. The total is that of the ledger as it is; the rest comes from the keys that
    ``match`` keeps and those that ``differ`` keeps, so rows that are lost or counted twice on
    the way show up as a residual. A lost row and a doubled one of the same amount cancel in
    rows and money, but not in ``fingerprint_residual``: the sum of the rows' hashes, in any
    order. Bank rows are counted per key and ``bank_group``. A key that occurs more than once
    on the payout side means that the reports count its bank rows more than once.
    """
    p = payout.select(F.col(payout_key).alias("k"), payout_amount.alias("amount"))
    b = (
        bank.select(F.col(bank_key).alias("k"), F.col(bank_group).alias("g"), bank_amount.alias("amount"))
        .groupBy("k", "g")
        .agg(F.sum("amount").cast(TOTAL).alias("amount"))
        .drop("g")
    )
    ledgers, parts = _per_key({"payout": p, "bank": b}), []
    for side, other in (("payout", "bank"), ("bank", "payout")):
        whole, keys = (ledgers.where(f"of = '{side}' AND whole = {w}").drop("whole", "of") for w in (1, 0))
        others = ledgers.where(f"of = '{other}' AND whole = 0 AND k IS NOT NULL").select(F.col("k").alias("other"))
        figures = {
            "total": _sums(whole),
            "matched": _sums(match(keys, "k", others, "other")),
            "unmatched": _sums(differ(keys, "k", others, "other")),
            "duplicate": _sums(keys.where("k IS NOT NULL AND rows > 1"), F.count("*")),
        }
        for part, frame in figures.items():
            parts.append(frame.select(F.lit(side).alias("side"), F.lit(part).alias("part"), "rows", "usd", "print"))
    pick = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c)))
    zero, three = F.lit(0).cast(TOTAL), ("total", "matched", "unmatched")
    return (
        functools.reduce(DataFrame.unionByName, parts)
        .groupBy("side")
        .agg(
            *(pick(n, "rows").cast("bigint").alias(f"{n}_rows") for n in three),
            *(F.coalesce(pick(n, "usd"), zero).alias(f"{n}_usd") for n in three),
            *(F.coalesce(pick(n, "print"), zero).alias(f"{n}_print") for n in three),
            pick("duplicate", "rows").cast("bigint").alias("duplicate_keys"),
        )
        .withColumn(
            "residual_rows", F.expr("total_rows - matched_rows - unmatched_rows").cast("bigint")
        )
        .withColumn("residual_usd", F.expr("total_usd - matched_usd - unmatched_usd").cast(TOTAL))
        .withColumn(
            "fingerprint_residual", F.expr("total_print - matched_print - unmatched_print").cast("decimal(38,0)")
        )
        .drop(*(f"{n}_print" for n in three))
    )


def _per_key(sides: dict[str, DataFrame]) -> DataFrame:
    """of, k, whole, rows, usd, print: one row per side and key, and one of each whole side (whole = 1),
    as written."""
    totals = []
    for side, rows in sides.items():
        hashed = rows.withColumn("print", F.xxhash64("k", "amount").cast("decimal(20,0)"))
        per_key = hashed.rollup("k").agg(
            F.grouping("k").cast("int").alias("whole"),
            F.count("*").alias("rows"),
            F.sum("amount").cast(TOTAL).alias("usd"),
            F.sum("print").cast("decimal(38,0)").alias("print"),
        )
        totals.append(per_key.withColumn("of", F.lit(side)))
    every = functools.reduce(DataFrame.unionByName, totals)
    spark = every.sparkSession
    folder = scratch_dir(spark, "tie_out")
    every.write.parquet(folder)
    return spark.read.schema(every.schema).parquet(folder)


def _sums(per_key: DataFrame, rows: Column | None = None) -> DataFrame:
    rows = F.coalesce(F.sum("rows"), F.lit(0)) if rows is None else rows
    return per_key.agg(
        rows.alias("rows"), F.sum("usd").cast(TOTAL).alias("usd"), F.sum("print").cast("decimal(38,0)").alias("print")
    )
