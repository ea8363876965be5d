"""Late typing of text timestamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Period

ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(text: Column | str) -> Column:
    """The date in the first ten characters, or NULL when they are not ``yyyy-MM-dd``.

    The pattern guard keeps partial dates such as ``2025-1``, which a plain cast accepts.
    """
    prefix = F.left(_col(text), F.lit(10))
    return F.when(prefix.rlike(ISO_DAY), prefix.try_cast("date"))


def in_period(text: Column | str, period: Period) -> Column:
    """Rows whose day lies in the period; anything unparseable is outside every period.

    ISO days sort as text, so the period also bounds the raw column. Stating that
    bound lets a Parquet scan of the all-text table skip row groups by min/max,
    which it cannot do through a cast.
    """
    text = _col(text)
    day = day_of(text)
    return (
        (text >= F.lit(period.start))
        & (text < F.lit(period.end))
        & (day >= F.lit(period.start).cast("date"))
        & (day < F.lit(period.end).cast("date"))
    )


def in_months(text: Column | str, year: int, months: Iterable[int]) -> Column:
    """The year-and-month-list form of a period; same rows as :func:`in_period`."""
    day = day_of(text)
    return day.isNotNull() & (F.year(day) == year) & F.month(day).isin(*months)


def year_prefix(text: Column | str, years: Iterable[str]) -> Column:
    """Rows whose text starts with one of the given four-digit years."""
    return F.left(_col(text), F.lit(4)).isin(*[str(y) for y in years])
