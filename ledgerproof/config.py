"""What a reconciliation run is about: the period, the columns, the scope and the labels.

Every operator takes these as arguments, so a new quarter or a differently
named export is a new configuration and never a new query.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Period:
    """A half-open range of days, ``start <= day < end``, as ISO text."""

    start: str
    end: str

    @classmethod
    def quarter(cls, year: int, quarter: int) -> "Period":
        first = 3 * quarter - 2
        end_year, end_month = (year + 1, 1) if quarter == 4 else (year, first + 3)
        return cls(f"{year:04d}-{first:02d}-01", f"{end_year:04d}-{end_month:02d}-01")


@dataclass(frozen=True)
class PayoutColumns:
    key: str = "tms_reconciliation_id"
    created_at: str = "withdrawal_created_at"
    cashout: str = "total_cashout_usd"
    initial: str = "initial_withdrawal_amount_usd"
    provider: str = "payment_provider_name"
    method: str = "payment_method"


@dataclass(frozen=True)
class BankColumns:
    key: str = "reconciliation_id"
    created_at: str = "created_at"
    amount: str = "usd_amount"
    provider: str = "provider"
    platform_id: str = "platform_id"


@dataclass(frozen=True)
class PaymentColumns:
    key: str = "withdrawal_id"
    created_at: str = "created_at"
    purpose: str = "purpose"
    status: str = "status"


@dataclass(frozen=True)
class Scope:
    """Which bank rows count: equal to, different from, and empty columns."""

    equal: tuple[tuple[str, str], ...] = (
        ("direction", "OUTGOING"),
        ("platform_type", "Withdrawal"),
    )
    different: tuple[tuple[str, str], ...] = (("type", "Returned"),)
    empty: tuple[str, ...] = ("receiver_id", "sender_id", "return_id")
    # Databases often compare text without regard to case; Spark does so only on demand.
    ignore_case: bool = False


@dataclass(frozen=True)
class ReconConfig:
    period: Period
    scope: Scope = field(default_factory=Scope)
    payout: PayoutColumns = field(default_factory=PayoutColumns)
    bank: BankColumns = field(default_factory=BankColumns)
    payment: PaymentColumns = field(default_factory=PaymentColumns)
    # The one provider that settles outside the bank ledger, and its labels.
    flagged_provider: str = "prov_0"
    flagged_label: str = "flagged"
    unflagged_label: str = "not_flagged"
    # Payments that count as contractor withdrawals.
    contractor_purpose: str = "contractor_payment"
    contractor_years: tuple[str, ...] = ()


# The labels a report reader filters on.
HAS_ID = "recon_id_exist"
NO_ID = "no_recon_id"
CONTRACTOR = "contractor_withdrawal"
OTHER = "other_withdrawal"
