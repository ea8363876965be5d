"""Rows found in one ledger only, and when they turn up in the other one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CONTRACTOR, HAS_ID, NO_ID, OTHER, ReconConfig
from ..functions import TOTAL, day_of, money, normalised, try_money
from .filters import (
    bank_in_period,
    contractor_payments,
    in_scope,
    payout_in_period,
    provider_is_not,
)
from .perkey import distinct_keys, totals_by, weighted_count, weighted_sum, without_keys
from .skew import spread_join


def _period_bank_keys(bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    return distinct_keys(bank_in_period(bank, cfg), cfg.bank.key, "bank_key")


def _period_payout_keys(payout: DataFrame, cfg: ReconConfig) -> DataFrame:
    return distinct_keys(payout_in_period(payout, cfg), cfg.payout.key, "payout_key")


# -- payout rows without bank row ---------------------------------------------------------


def _unmatched_payout_totals(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """One row per unmatched id, with the totals of the flagged provider and of the others
    side by side: grouping by the id alone leaves the rows where the joins need them."""
    is_flagged = normalised(cfg.payout.provider) == cfg.flagged_provider
    flagged = F.coalesce(is_flagged, F.lit(False))
    initial, cashout = try_money(cfg.payout.initial), try_money(cfg.payout.cashout)

    def totals(condition: Column, label: str) -> Column:
        return F.struct(
            F.lit(label).alias("provider_flag"),
            F.count_if(condition).alias("rows"),
            F.sum(F.when(condition, initial)).cast(TOTAL).alias("initial_usd"),
            F.sum(F.when(condition, cashout)).cast(TOTAL).alias("cashout_usd"),
        )

    per_id = payout_in_period(payout, cfg).groupBy(F.col(cfg.payout.key).alias("key")).agg(
        totals(flagged, cfg.flagged_label).alias("flagged"),
        totals(~flagged, cfg.unflagged_label).alias("unflagged"),
    )
    return without_keys(per_id, "key", _period_bank_keys(bank, cfg), "bank_key")


def _one_row_per_flag(per_id: DataFrame, *columns: str) -> DataFrame:
    return (
        per_id.select("key", *columns, F.explode(F.array("flagged", "unflagged")).alias("side"))
        .select("key", *columns, "side.*")
        .where("rows > 0")
    )


def payout_not_bank_totals(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Count and sums of the period's payouts that the bank ledger lacks."""
    return _one_row_per_flag(_unmatched_payout_totals(payout, bank, cfg)).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("cnt"),
        F.sum("initial_usd").cast(TOTAL).alias("sum_initial_withdrawal_usd"),
        F.sum("cashout_usd").cast(TOTAL).alias("sum_total_cashout_usd"),
    )


def _bank_months(full_bank: DataFrame, cfg: ReconConfig, earliest: bool) -> DataFrame:
    """Per key and month the number of bank rows; with ``earliest`` one row per key."""
    day = day_of(cfg.bank.created_at)
    rows = full_bank.where(F.col(cfg.bank.key).isNotNull()).select(
        F.col(cfg.bank.key).alias("bank_key"), day.alias("day")
    )
    if earliest:
        first = rows.groupBy("bank_key").agg(F.min("day").alias("day"))
        return first.select("bank_key", F.year("day").alias("y"), F.month("day").alias("m"), F.lit(1).alias("times"))
    return rows.groupBy("bank_key", F.year("day").alias("y"), F.month("day").alias("m")).agg(
        F.count("*").alias("times")
    )


def payout_not_bank_cutoff(
    payout: DataFrame,
    bank: DataFrame,
    full_bank: DataFrame,
    cfg: ReconConfig,
    *,
    earliest: bool = False,
) -> DataFrame:
    """Unmatched payouts by the month in which the all-time bank ledger has them.

    A payout with several bank rows counts once per bank row, as in a plain left
    join; with ``earliest`` it counts once, in the month of its first bank row, and
    the report adds up to the unmatched total.
    """
    unmatched = _unmatched_payout_totals(payout, bank, cfg)
    months = _bank_months(full_bank, cfg, earliest)
    times = F.coalesce("times", F.lit(1))
    dated = unmatched.join(months, F.col("key") == F.col("bank_key"), "left")
    return (
        _one_row_per_flag(dated, "y", "m", "times")
        .groupBy(
            F.col("y").alias("tms_cutoff_year"),
            F.col("m").alias("tms_cutoff_month"),
            "provider_flag",
            F.when(F.col("key").isNotNull(), HAS_ID).otherwise(NO_ID).alias("if_recon_id"),
        )
        .agg(
            weighted_count("rows", times).alias("cnt"),
            weighted_sum("initial_usd", times).alias("sum_initial_withdrawal_usd"),
            weighted_sum("cashout_usd", times).alias("sum_total_cashout_usd"),
        )
    )


def payout_not_bank_cutoff_scoped(
    payout: DataFrame, bank: DataFrame, full_bank: DataFrame, cfg: ReconConfig
) -> DataFrame:
    """The older cut-off report: the all-time ledger is held to the scope as well."""
    report = payout_not_bank_cutoff(payout, bank, full_bank.where(in_scope(cfg.scope)), cfg)
    return report.groupBy(
        F.col("tms_cutoff_year").alias("cutoff_year"),
        F.col("tms_cutoff_month").alias("cutoff_month"),
        "provider_flag",
    ).agg(
        F.sum("cnt").cast("bigint").alias("cnt"),
        F.sum("sum_initial_withdrawal_usd").cast(TOTAL).alias("sum_initial_withdrawal_usd"),
    )


def unmatched_payout_rows(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The period's payout rows whose id the bank ledger lacks in the period."""
    rows = payout_in_period(payout, cfg).withColumn("withdrawal_date", day_of(cfg.payout.created_at))
    return spread_join(
        rows,
        _period_bank_keys(bank, cfg),
        cfg.payout.key,
        "bank_key",
        "left_anti",
    )


def payout_unresolved_rows(
    payout: DataFrame, bank: DataFrame, full_bank: DataFrame, cfg: ReconConfig
) -> DataFrame:
    """Payout rows with an id that no bank row ever carries, flagged provider left out.

    Both tests are anti-joins on the same key, so the rows are shuffled once, against
    the union of the two key sets.
    """
    rows = (
        payout_in_period(payout, cfg)
        .where(F.col(cfg.payout.key).isNotNull())
        .where(provider_is_not(cfg.payout.provider, cfg.flagged_provider))
        .withColumn("withdrawal_date", day_of(cfg.payout.created_at))
    )
    known = (
        bank_in_period(bank, cfg)
        .select(F.col(cfg.bank.key).alias("bank_key"))
        .unionByName(full_bank.select(F.col(cfg.bank.key).alias("bank_key")))
    )
    return spread_join(
        rows,
        distinct_keys(known, "bank_key", "bank_key"),
        cfg.payout.key,
        "bank_key",
        "left_anti",
    )


def payout_undated_rows(
    payout: DataFrame, bank: DataFrame, full_bank: DataFrame, cfg: ReconConfig
) -> DataFrame:
    """Unmatched payout rows that have no dated bank row to explain them.

    Either no bank row carries the id, or some carry it without a readable date;
    ``bank_rows`` says how many such rows there are (0 when the id is unknown).
    """
    none = F.lit(0)
    known = (
        bank_in_period(bank, cfg)
        .select(F.col(cfg.bank.key).alias("bank_key"), F.lit(1).alias("period"), none.alias("ever"), none.alias("no_day"))
        .unionByName(
            full_bank.select(
                F.col(cfg.bank.key).alias("bank_key"),
                none.alias("period"),
                F.lit(1).alias("ever"),
                day_of(cfg.bank.created_at).isNull().cast("int").alias("no_day"),
            )
        )
        .where("bank_key IS NOT NULL")
        .groupBy("bank_key")
        .agg(*[F.sum(c).alias(c) for c in ("period", "ever", "no_day")])
    )
    rows = payout_in_period(payout, cfg).withColumn("withdrawal_date", day_of(cfg.payout.created_at))
    return (
        spread_join(rows, known, cfg.payout.key, "bank_key", "left")
        .where("bank_key IS NULL OR (period = 0 AND (ever = 0 OR no_day > 0))")
        .withColumn("bank_rows", F.coalesce("no_day", none).cast("bigint"))
        .drop("bank_key", "period", "ever", "no_day")
    )


# -- bank rows without payout row ---------------------------------------------------------


def bank_not_payout_totals(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Count and sum of the bank's id and provider groups that the payout ledger lacks."""
    grouped = bank_in_period(bank, cfg).groupBy(
        F.col(cfg.bank.key).alias("key"), F.col(cfg.bank.provider).alias("provider")
    ).agg(F.sum(money(cfg.bank.amount)).cast(TOTAL).alias("usd"))
    return without_keys(grouped, "key", _period_payout_keys(payout, cfg), "payout_key").agg(
        F.count("*").alias("tms_not_in_payout_cnt"),
        F.sum("usd").cast(TOTAL).alias("tms_not_in_payout_usd_sum"),
    )


def _payment_rows(payment: DataFrame, cfg: ReconConfig, *, by_status: bool) -> DataFrame:
    """Rows per withdrawal; with ``by_status`` one line per status, next to that status' rows."""
    rows = contractor_payments(payment, cfg).where(F.col(cfg.payment.key).isNotNull())
    withdrawal = F.col(cfg.payment.key).alias("withdrawal")
    if not by_status:
        return rows.groupBy(withdrawal).agg(F.count("*").alias("payment_rows"))
    per_status = rows.groupBy(withdrawal, F.col(cfg.payment.status).alias("status")).agg(
        F.count("*").alias("status_rows")
    )
    # The window sees one row per status, however often a withdrawal is listed.
    return per_status.withColumn(
        "payment_rows", F.sum("status_rows").over(Window.partitionBy("withdrawal"))
    )


def _bank_with_payments(
    bank: DataFrame, payments: DataFrame, cfg: ReconConfig, how: str, own_month: bool = False
) -> DataFrame:
    """Bank totals per reconciliation id and platform id, joined to their payments."""
    day = day_of(cfg.bank.created_at)
    month = [F.year(day).alias("y"), F.month(day).alias("m")] if own_month else []
    rows = bank_in_period(bank, cfg)
    totals = totals_by(
        rows,
        [F.col(cfg.bank.key).alias("key"), F.col(cfg.bank.platform_id).alias("platform"), *month],
        {"usd": try_money(cfg.bank.amount)},
    )
    return spread_join(
        totals,
        payments,
        "platform",
        "withdrawal",
        how,
    )


def _bank_by_status(
    bank: DataFrame, payment: DataFrame, cfg: ReconConfig, *, how: str
) -> DataFrame:
    """Bank totals per reconciliation id, withdrawal type and payment status.

    The reports join the payments twice, once for the type and once for the status, so
    the weight is (rows of the withdrawal) x (rows of the withdrawal with that status).
    ``how`` is ``left`` to keep every bank row or ``inner`` for contractor payments only.
    """
    tagged = _bank_with_payments(bank, _payment_rows(payment, cfg, by_status=True), cfg, how)
    weight = F.coalesce(F.col("payment_rows") * F.col("status_rows"), F.lit(1))
    return tagged.groupBy(
        "key",
        F.when(F.col("withdrawal").isNotNull(), CONTRACTOR).otherwise(OTHER).alias("withdrawal_type"),
        "status",
    ).agg(weighted_count("rows", weight).alias("rows"), weighted_sum("usd", weight).alias("usd"))


def _payout_months(full_payout: DataFrame, cfg: ReconConfig, dated_only: bool) -> DataFrame:
    rows = full_payout.where(F.col(cfg.payout.key).isNotNull()).select(
        F.col(cfg.payout.key).alias("payout_key"), day_of(cfg.payout.created_at).alias("day")
    )
    if dated_only:
        rows = rows.where("day IS NOT NULL")
    return rows.groupBy("payout_key", F.year("day").alias("y"), F.month("day").alias("m")).agg(
        F.count("*").alias("times")
    )


def bank_not_payout_cutoff(
    payout: DataFrame,
    bank: DataFrame,
    payment: DataFrame,
    full_payout: DataFrame,
    cfg: ReconConfig,
) -> DataFrame:
    """Unmatched bank rows by the month of their payout, contractor type and status."""
    per_id = _bank_by_status(bank, payment, cfg, how="left")
    unmatched = without_keys(per_id, "key", _period_payout_keys(payout, cfg), "payout_key")
    months = _payout_months(full_payout, cfg, dated_only=True)
    times = F.coalesce("times", F.lit(1))
    return (
        unmatched.join(months, F.col("key") == F.col("payout_key"), "left")
        .groupBy(
            F.col("y").alias("payout_from_year"),
            F.col("m").alias("payout_from_month"),
            F.col("payout_key").isNotNull().cast("int").alias("exists_in_full_payout"),
            "withdrawal_type",
            "status",
        )
        .agg(
            weighted_count("rows", times).alias("cnt"),
            weighted_sum("usd", times).alias("sum_usd_amount"),
        )
        .orderBy("payout_from_year", "payout_from_month", "exists_in_full_payout")
    )


def bank_not_payout_by_status(
    payout: DataFrame,
    bank: DataFrame,
    payment: DataFrame,
    full_payout: DataFrame,
    cfg: ReconConfig,
) -> DataFrame:
    """The older report: contractor rows only, by month of the payout and status."""
    per_id = _bank_by_status(bank, payment, cfg, how="inner")
    unmatched = without_keys(per_id, "key", _period_payout_keys(payout, cfg), "payout_key")
    months = _payout_months(full_payout, cfg, dated_only=False)
    times = F.coalesce("times", F.lit(1))
    return (
        unmatched.join(months, F.col("key") == F.col("payout_key"), "left")
        .groupBy(F.col("y").alias("cutoff_year"), F.col("m").alias("cutoff_month"), "status")
        .agg(
            weighted_count("rows", times).alias("cnt"),
            weighted_sum("usd", times).alias("sum_usd_amount"),
        )
    )


def bank_not_payout_contractor(
    payout: DataFrame,
    bank: DataFrame,
    payment: DataFrame,
    full_payout: DataFrame,
    cfg: ReconConfig,
) -> DataFrame:
    """Unmatched contractor rows by the bank row's own month."""
    tagged = _bank_with_payments(
        bank, _payment_rows(payment, cfg, by_status=False), cfg, "inner", own_month=True
    )
    per_id = tagged.groupBy("key", "y", "m").agg(
        weighted_count("rows", "payment_rows").alias("rows"),
        weighted_sum("usd", "payment_rows").alias("usd"),
    )
    unmatched = without_keys(per_id, "key", _period_payout_keys(payout, cfg), "payout_key")
    repeats = (
        full_payout.where(F.col(cfg.payout.key).isNotNull())
        .groupBy(F.col(cfg.payout.key).alias("payout_key"))
        .agg(F.count("*").alias("times"))
    )
    times = F.coalesce("times", F.lit(1))
    return (
        unmatched.join(repeats, F.col("key") == F.col("payout_key"), "left")
        .groupBy(F.col("y").alias("cutoff_year"), F.col("m").alias("cutoff_month"))
        .agg(
            weighted_count("rows", times).alias("cnt"),
            weighted_sum("usd", times).alias("sum_usd_amount"),
        )
    )


def unmatched_bank_rows(payout: DataFrame, bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The period's bank rows in scope whose id the payout ledger lacks in the period."""
    return spread_join(
        bank_in_period(bank, cfg),
        _period_payout_keys(payout, cfg),
        cfg.bank.key,
        "payout_key",
        "left_anti",
    )


def contractor_tagged_rows(
    bank: DataFrame, payment: DataFrame, cfg: ReconConfig, *, contractor_only: bool = False
) -> DataFrame:
    """Bank rows with their withdrawal type and the number of payments behind them.

    A withdrawal paid in several rows is reported by ``payment_rows`` instead of
    repeating the bank row.
    """
    tagged = spread_join(
        bank_in_period(bank, cfg),
        _payment_rows(payment, cfg, by_status=False),
        cfg.bank.platform_id,
        "withdrawal",
        "inner" if contractor_only else "left",
    )
    return tagged.withColumn(
        "withdrawal_type", F.when(F.col("withdrawal").isNotNull(), CONTRACTOR).otherwise(OTHER)
    ).withColumn("payment_rows", F.coalesce("payment_rows", F.lit(0)).cast("bigint")).drop("withdrawal")
