"""Column expressions shared by all operators; none of them leaves the JVM."""

from .dates import day_of, in_period, in_months, year_prefix
from .money import MONEY, TOTAL, money, try_money
from .text import escape_preview, has_line_break, is_blank, joined_where, normalised, null_if_empty

__all__ = [
    "MONEY",
    "TOTAL",
    "day_of",
    "escape_preview",
    "has_line_break",
    "in_months",
    "in_period",
    "is_blank",
    "joined_where",
    "money",
    "normalised",
    "null_if_empty",
    "try_money",
    "year_prefix",
]
