"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[\p{L}\p{N}_']+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_settled: list[str] = []


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame below ``spark.checkpoint.dir`` and reads it back.

    Cuts the lineage; the files survive a lost executor and are the same for every reader.
    They stay until :func:`drop_settled` is told that no frame reads them any more.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    _settled.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled() -> list[str]:
    """The folders of the tables that :func:`settle` has written and that are still there."""
    return list(_settled)


def drop_settled(spark: SparkSession, paths: Sequence[str]) -> None:
    """Deletes settled tables in whatever store holds them."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _settled.remove(path)


def packed(df: DataFrame, columns: Sequence[str]) -> Column:
    """Columns to carry along as one struct ``row``, so that their names clash with none."""
    return F.struct(*[df[c] for c in columns] or [F.lit(0).alias("none")]).alias("row")


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def mod_hash(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


def slices(lengths: Sequence[int], limit: int = 1 << 20) -> Iterator[slice]:
    """Runs of neighbouring rows whose lengths sum to about ``limit``, one row at least."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > limit:
            yield slice(start, i)
            start, total = i, 0
        total += length
    if start < len(lengths):
        yield slice(start, len(lengths))


def token_hashes(text: Column, pattern: str = WORD) -> Column:
    """64-bit hashes of the lower-cased tokens of a text, in order; none for null."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))
