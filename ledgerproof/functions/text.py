"""Text clean-up, previews and joined name lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column | str) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(F.col(text) if isinstance(text, str) else text))


def null_if_empty(text: Column | str) -> Column:
    return F.nullif(F.col(text) if isinstance(text, str) else text, F.lit(""))


def is_blank(text: Column | str) -> Column:
    """NULL, empty or blanks only."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.trim(col), F.lit("")) == ""


def escape_preview(text: Column | str, length: int) -> Column:
    """Line breaks spelled out, cut to ``length`` characters with ``...`` behind a cut."""
    col = F.col(text) if isinstance(text, str) else text
    shown = F.replace(F.replace(col, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    return F.when(
        F.length(shown) > length, F.concat(F.left(shown, F.lit(length)), F.lit("..."))
    ).otherwise(shown)


def joined_where(
    labels: Sequence[str], conditions: Sequence[Column], separator: str = ";"
) -> Column:
    """The labels whose condition holds, joined; empty text when none does."""
    picked = [F.when(cond, F.lit(label)) for label, cond in zip(labels, conditions)]
    return F.array_join(F.array_compact(F.array(*picked)), separator)


def has_line_break(text: Column | str) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.contains(col, F.lit("\n")) | F.contains(col, F.lit("\r"))
