"""Scope, period and lookup filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig, Scope
from ..functions import in_period, is_blank, normalised, year_prefix


def in_scope(scope: Scope) -> Column:
    """All scope conditions at once. ``<>`` drops a NULL type, as SQL does."""
    fold = (lambda c: F.lower(c)) if scope.ignore_case else (lambda c: c)
    terms = [fold(F.col(c)) == fold(F.lit(value)) for c, value in scope.equal]
    terms += [fold(F.col(c)) != fold(F.lit(value)) for c, value in scope.different]
    terms += [F.col(c).isNull() for c in scope.empty]
    combined = terms[0]
    for term in terms[1:]:
        combined = combined & term
    return combined


def payout_in_period(payout: DataFrame, cfg: ReconConfig) -> DataFrame:
    return payout.where(in_period(cfg.payout.created_at, cfg.period))


def bank_in_period(bank: DataFrame, cfg: ReconConfig) -> DataFrame:
    return bank.where(in_period(cfg.bank.created_at, cfg.period) & in_scope(cfg.scope))


def contractor_payments(payment: DataFrame, cfg: ReconConfig) -> DataFrame:
    rows = payment.where(F.col(cfg.payment.purpose) == cfg.contractor_purpose)
    if cfg.contractor_years:
        rows = rows.where(year_prefix(cfg.payment.created_at, cfg.contractor_years))
    return rows


def with_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNull())


def key_lookup(df: DataFrame, key: str, values: Iterable[object]) -> DataFrame:
    """Rows with one of a few keys. Keys are text, so numbers are compared as text."""
    return df.where(F.col(key).isin(*[str(v) for v in values]))


def provider_is_not(column: str, name: str) -> Column:
    """Normalised inequality; a NULL provider is dropped, as SQL does."""
    return normalised(column) != name


def has_key(column: str) -> Column:
    return ~is_blank(column)
