"""Late typing of text amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
TOTAL = DecimalType(38, 2)


def try_money(text: Column | str) -> Column:
    """The amount with two decimals, or NULL when the text is no number."""
    col = F.col(text) if isinstance(text, str) else text
    return col.try_cast(MONEY)


def money(text: Column | str) -> Column:
    """The amount with two decimals; text that is no number fails the query.

    The failure is written out, so it does not depend on the session's ANSI setting.
    """
    col = F.col(text) if isinstance(text, str) else text
    refused = F.when(
        col.isNotNull(),
        F.raise_error(F.concat(F.lit("not an amount: "), col)).cast(MONEY),
    )
    return F.coalesce(col.try_cast(MONEY), refused)
