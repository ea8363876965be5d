"""Column names from a CSV header."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

BOM = "\ufeff"


def clean_name(raw: str | None, position: int) -> str:
    """A name of letters, digits and underscores; ``COL_<position>`` for a blank one."""
    name = re.sub(r"\W", "_", (raw or "").strip().replace(BOM, ""))
    return f"COL_{position}" if name in ("", "COL") else name


def clean_header(raw_names: Iterable[str | None]) -> list[str]:
    """Cleaned names in order; repeats become ``X_2``, ``X_3``.

    Spark resolves names without regard to case, so repeats are found that way too.
    """
    taken: set[str] = set()
    seen: dict[str, int] = {}
    names = []
    for position, raw in enumerate(raw_names, start=1):
        base = clean_name(raw, position)
        name = base
        while True:
            seen[base.lower()] = seen.get(base.lower(), 0) + 1
            if seen[base.lower()] > 1:
                name = f"{base}_{seen[base.lower()]}"
            if name.lower() not in taken:
                break
        taken.add(name.lower())
        names.append(name)
    return names


def read_header(spark: SparkSession, path: str | Sequence[str], *, quoted: bool = True) -> list[str | None]:
    """The raw header cells. Only the first record of the first file is read."""
    reader = spark.read.option("header", False).option("multiLine", quoted)
    reader = reader.option("quote", '"' if quoted else "").option("escape", '"')
    row = reader.csv(path if isinstance(path, str) else path[0]).first()
    if row is None:
        raise ValueError(f"no header in {path}")
    return list(row)


def text_schema(names: Iterable[str]) -> StructType:
    """Every column is nullable text; typing happens in the queries."""
    return StructType([StructField(name, StringType(), True) for name in names])
