"""The reconciliation reports, each from staged tables to its result frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..functions import money, try_money
from ..operators import cutoff
from ..operators.difference import matched_difference, nonzero_difference_by
from ..operators.filters import bank_in_period, payout_in_period
from ..operators.summaries import amount_by, control_totals, distinct_values, month_histogram
from ..sources.sinks import write_report


def join_diff(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Matched rows: count, both sums and their difference, expected to be zero."""
    return matched_difference(
        payout_in_period(payout, cfg),
        bank_in_period(bank, cfg),
        left_key=cfg.payout.key,
        left_amount=F.col(cfg.payout.cashout),
        right_key=cfg.bank.key,
        right_amount=F.col(cfg.bank.amount),
        right_group=cfg.bank.provider,
    ).select(
        "cnt",
        F.col("sum_left").alias("sum_total_cashout_usd"),
        F.col("sum_right").alias("sum_tms_usd_amount"),
        F.col("sum_diff").alias("sum_diff_usd"),
    )


def join_diff_by_method(
    payout: DataFrame, bank: DataFrame, cfg: ReconConfig, *, sum_bank_first: bool = True
) -> DataFrame:
    """Differing matched rows per payment method.

    Without ``sum_bank_first`` the bank rows of a split payment are compared one by
    one, so each of them shows up as a difference: the duplicate-key check.
    """
    return nonzero_difference_by(
        payout_in_period(payout, cfg),
        bank_in_period(bank, cfg),
        left_key=cfg.payout.key,
        left_amount=F.col(cfg.payout.cashout),
        right_key=cfg.bank.key,
        right_amount=F.col(cfg.bank.amount),
        by=cfg.payout.method,
        right_group=cfg.bank.provider if sum_bank_first else None,
    ).select(
        F.col("by").alias(cfg.payout.method),
        "cnt",
        F.col("sum_left").alias("sum_total_cashout_usd"),
        F.col("sum_right").alias("sum_tms_usd_amount"),
        F.col("sum_diff").alias("sum_diff_usd"),
    )


def payout_totals(payout: DataFrame, cfg: ReconConfig) -> DataFrame:
    return control_totals(
        payout_in_period(payout, cfg),
        {
            "sum_total_cashout_usd": money(cfg.payout.cashout),
            "sum_initial_withdrawal_usd": money(cfg.payout.initial),
        },
    )


def bank_totals(bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    return control_totals(bank_in_period(bank, cfg), {"sum_tms_usd_amount": money(cfg.bank.amount)})


def ledger_pack(ledger: DataFrame) -> dict[str, DataFrame]:
    """The receivables pack: pivot by mapping, months, row count and reversal dates."""
    return {
        "pivot": amount_by(ledger, ["analytics_ns_mapping"], "amount_usd"),
        "months": month_histogram(ledger, "posting_date"),
        "rows": control_totals(ledger, {"total_amount": try_money("amount_usd")}),
        "reversal_dates": distinct_values(ledger, "reversal_date"),
    }


def run_all(
    payout: DataFrame,
    bank: DataFrame,
    payment: DataFrame,
    full_payout: DataFrame,
    full_bank: DataFrame,
    cfg: ReconConfig,
    out_dir: str,
) -> dict[str, str]:
    """Runs the three main reports in order and writes each as CSV; returns the folders."""
    steps: list[tuple[str, Callable[[], DataFrame], list[str]]] = [
        ("join_diff", lambda: join_diff(payout, bank, cfg), []),
        (
            "payout_not_bank",
            lambda: cutoff.payout_not_bank_cutoff(payout, bank, full_bank, cfg),
            ["tms_cutoff_year", "tms_cutoff_month", "provider_flag"],
        ),
        (
            "bank_not_payout",
            lambda: cutoff.bank_not_payout_cutoff(payout, bank, payment, full_payout, cfg),
            ["payout_from_year", "payout_from_month", "exists_in_full_payout"],
        ),
    ]
    written = {}
    for name, build, order_by in steps:
        written[name] = f"{out_dir.rstrip('/')}/{name}"
        write_report(build(), written[name], order_by)
    return written
