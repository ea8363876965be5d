"""Ledgers derived from the sample tables, so every report has something to find.

The remainder rules below do not thin the data out; each plants one case of the real
ledgers: missing ids, rows absent on one side, unreadable dates, split payments, payouts
booked twice, rows out of scope. The expressions run unchanged on Spark and in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Period, ReconConfig

PERIOD = Period("1998-10-01", "1999-01-01")
CONFIG = ReconConfig(
    period=PERIOD,
    flagged_provider="prov_0",
    contractor_years=("1998", "1999"),
)

PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"

FULL_PAYOUT = {
    "tms_reconciliation_id": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END",
    "withdrawal_created_at": "CASE WHEN o_orderkey % 211 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS STRING) END",
    "total_cashout_usd": f"CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST({PRICE} AS STRING) END",
    "initial_withdrawal_amount_usd": f"CAST({PRICE} + CAST(o_orderkey % 7 AS DECIMAL(18,2)) AS STRING)",
    "payment_provider_name": "CASE WHEN o_custkey % 5 = 0 THEN ' Prov_0 ' ELSE 'prov_' || CAST(o_custkey % 5 AS STRING) END",
    "payment_method": "o_orderpriority",
    "tms_is_reconciled": "o_orderstatus",
}
FULL_PAYOUT_WHERE = "o_orderkey % 31 <> 0"
# Payouts that were booked twice.
DOUBLED_WHERE = "o_orderkey % 71 = 0"

FULL_BANK = {
    "reconciliation_id": "CAST(o_orderkey AS STRING)",
    "platform_id": "CAST(o_orderkey AS STRING)",
    "provider": "'prov_' || CAST(o_custkey % 5 AS STRING)",
    "usd_amount": "CAST(leg AS STRING)",
    "created_at": "CASE WHEN o_orderkey % 199 = 0 THEN 'bad-date' "
    "ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS STRING) || 'T08:00:00Z' END",
    "direction": "CASE WHEN o_orderkey % 41 = 0 THEN 'INCOMING' ELSE 'OUTGOING' END",
    "platform_type": "CASE WHEN o_orderkey % 43 = 0 THEN 'Fee' ELSE 'Withdrawal' END",
    "type": "CASE WHEN o_orderkey % 47 = 0 THEN 'Returned' WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'Sent' END",
    "receiver_id": "CASE WHEN o_orderkey % 59 = 0 THEN 'r1' END",
    "sender_id": "CASE WHEN o_orderkey % 61 = 0 THEN 's1' END",
    "return_id": "CASE WHEN o_orderkey % 67 = 0 THEN 'x1' END",
}
FULL_BANK_WHERE = "o_orderkey % 17 <> 0"
SPLIT_WHERE = "o_orderkey % 23 = 0"
FIRST_LEG = (
    f"CASE WHEN {SPLIT_WHERE} THEN {PRICE} - 10.00 "
    f"WHEN o_orderkey % 13 = 0 THEN {PRICE} + 1.25 ELSE {PRICE} END"
)
SECOND_LEG = "10.00"

PAYMENT = {
    "withdrawal_id": "CAST(o_orderkey AS STRING)",
    "purpose": "CASE WHEN o_orderkey % 7 = 0 THEN 'refund' ELSE 'contractor_payment' END",
    "created_at": "CAST(o_orderdate AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'cancelled' END",
    "settlement_currency": "CASE WHEN o_custkey % 2 = 0 THEN 'USD' ELSE 'EUR' END",
}
PAYMENT_WHERE = "o_orderkey % 3 <> 0"

AR_LEDGER = {
    "unique_key": "'AR-' || CAST(o_orderkey AS STRING)",
    "analytics_ns_mapping": "CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE o_orderpriority END",
    "amount_usd": f"CASE WHEN o_orderkey % 73 = 0 THEN '1,234' ELSE CAST({PRICE} AS STRING) END",
    "posting_date": "CAST(o_orderdate AS STRING)",
    "reversal_date": "CASE WHEN o_orderkey % 37 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) END",
}
# The ledger as loaded: some source rows were lost on the way in.
AR_LOADED_WHERE = "o_orderkey % 83 <> 0"

CLEARING = {
    "invoice_period": "LEFT(CAST(l_shipdate AS STRING), 7)",
    "usd_amount": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def full_payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubled payouts come from the same pass over the orders."""
    times = f"explode(CASE WHEN {DOUBLED_WHERE} THEN array(1, 2) ELSE array(1) END)"
    orders = table(spark, sf_dir, "orders").where(FULL_PAYOUT_WHERE)
    return _project(orders.withColumn("booking", F.expr(times)), FULL_PAYOUT)


def full_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both legs of a split payment come from one pass over the orders."""
    legs = (
        f"explode(CASE WHEN {SPLIT_WHERE} "
        f"THEN array(CAST({FIRST_LEG} AS DECIMAL(19,2)), CAST({SECOND_LEG} AS DECIMAL(19,2))) "
        f"ELSE array(CAST({FIRST_LEG} AS DECIMAL(19,2))) END)"
    )
    orders = table(spark, sf_dir, "orders").where(FULL_BANK_WHERE)
    return _project(orders.withColumn("leg", F.expr(legs)), FULL_BANK)


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders").where(PAYMENT_WHERE), PAYMENT)


def ar_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), AR_LEDGER)


def ar_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders").where(AR_LOADED_WHERE), AR_LEDGER)


def clearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "lineitem"), CLEARING)


def _select_sql(columns: dict[str, str], source: str, where: str | None = None) -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT {cols} FROM {source}" + (f" WHERE {where}" if where else "")


def ledger_sql() -> dict[str, str]:
    """The same ledgers as plain SQL subqueries over the sample tables."""
    first = {**FULL_BANK, "usd_amount": f"CAST({FIRST_LEG} AS STRING)"}
    second = {**FULL_BANK, "usd_amount": f"CAST({SECOND_LEG} AS STRING)"}
    return {
        "full_payout": _select_sql(FULL_PAYOUT, "orders", FULL_PAYOUT_WHERE)
        + " UNION ALL "
        + _select_sql(FULL_PAYOUT, "orders", f"{FULL_PAYOUT_WHERE} AND {DOUBLED_WHERE}"),
        "full_bank": _select_sql(first, "orders", FULL_BANK_WHERE)
        + " UNION ALL "
        + _select_sql(second, "orders", f"{FULL_BANK_WHERE} AND {SPLIT_WHERE}"),
        "payment": _select_sql(PAYMENT, "orders", PAYMENT_WHERE),
        "ar_ledger": _select_sql(AR_LEDGER, "orders"),
        "ar_loaded": _select_sql(AR_LEDGER, "orders", AR_LOADED_WHERE),
        "clearing": _select_sql(CLEARING, "lineitem"),
    }
