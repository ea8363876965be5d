"""Writing staged tables, typed ledgers and reports; reading databases and SQL files."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_of, try_money

ROWS_PER_FILE = 5_000_000


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def beside(path: str, purpose: str) -> str:
    """A new folder next to a table; its name starts with an underscore, so no reader lists it."""
    base, _, name = path.rstrip("/").rpartition("/")
    return f"{base}/_{name}.{purpose}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Puts a completely written folder in a table's place; only names change.

    If that fails, the old table goes back to its place.
    """
    fs, target = _folder(spark, path)
    _, new = _folder(spark, written)
    _, old = _folder(spark, beside(path, "old"))
    replaced = fs.exists(target)
    fs.mkdirs(target.getParent())
    if replaced and not fs.rename(target, old):
        raise OSError(f"{path} cannot be replaced")
    if not fs.rename(new, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"{written} cannot be put in place of {path}")
    if replaced:
        fs.delete(old, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a load has written for itself."""
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def replace_table(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Writes the table in parallel, then replaces what was there, and returns it as stored.

    The rows are written beside the old table, which stays readable until all of them are
    there and is left as it is if the write fails. ``df`` may read the table it replaces.
    """
    spark, written = df.sparkSession, beside(path, "new")
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(written)
    publish(spark, written, path)
    return spark.read.parquet(path)


def create_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create-table-as-select into the session catalog; ``path`` makes it an external table."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def switch_table(df: DataFrame, name: str, base: str) -> DataFrame:
    """Writes a new version of a catalog table below ``base``, then points the table to it.

    One change in the catalog is the switch; queries that have begun go on with the version
    they know, which stays in its folder.
    """
    spark = df.sparkSession
    version = f"{base.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    if not spark.catalog.tableExists(name):
        df.write.option("path", version).option("maxRecordsPerFile", ROWS_PER_FILE).saveAsTable(name)
        return spark.table(name)
    if df.schema.simpleString() != spark.table(name).schema.simpleString():
        raise ValueError(f"{name} has other columns than what is to replace it")
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(version)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


BATCH = "load_batch"


def append_batch(df: DataFrame, path: str, batch: str) -> DataFrame:
    """Adds a batch to a table that is stored by batch; the same batch again replaces itself.

    Only the folder of the batch is written, and it is put in place when all of it is there,
    so a load that broke off can be repeated as a whole or go on with what is missing.
    """
    keyed = df.withColumn(BATCH, F.lit(batch))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", ROWS_PER_FILE
    ).partitionBy(BATCH).parquet(path)
    return df.sparkSession.read.schema(keyed.schema).parquet(path)


def committed_batches(spark: SparkSession, path: str) -> set[str]:
    """The batches of a table that are there; one name per commit of its load."""
    fs, table = _folder(spark, path)
    if not fs.exists(table):
        return set()
    names = [f.getPath().getName() for f in fs.listStatus(table) if f.isDirectory()]
    return {n.removeprefix(f"{BATCH}=") for n in names if n.startswith(f"{BATCH}=")}


def append_missing(batches: Mapping[str, Callable[[], DataFrame]], path: str, spark: SparkSession) -> list[str]:
    """Appends the batches that the table lacks, one commit each, in order; returns their names."""
    there = committed_batches(spark, path)
    added = []
    for name, build in batches.items():
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"a batch cannot be named {name!r}")
        if name not in there:
            append_batch(build(), path, name)
            added.append(name)
    return added


def create_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, most: float = 4.0
) -> DataFrame:
    """A catalog table dealt out by ``key`` once, so that per-key reports need not shuffle it.

    Rows go to the task that writes their bucket, so there is one file per bucket. A bucket
    is read by one task. The rows of each bucket are therefore counted first, and a table of
    which one bucket has more than ``most`` times its share is stored without buckets: reports
    then shuffle it, behind their map-side aggregates, which a hot key does not disturb.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.pmod(F.hash(key), F.lit(buckets))).agg(F.count("*").alias("n"))
    row = counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("hot"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    writer = df.write
    if row.hot * buckets <= most * max(row.rows, 1):
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer = writer.mode("overwrite").option("maxRecordsPerFile", 0)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def typed_ledger(df: DataFrame, created_at: str, amounts: list[str]) -> DataFrame:
    """Adds a day, a month and decimal amounts; unreadable values become NULL."""
    day = day_of(created_at)
    typed = df.withColumn("ledger_day", day).withColumn("ledger_month", F.date_format(day, "yyyy-MM"))
    for amount in amounts:
        typed = typed.withColumn(f"{amount}_typed", try_money(amount))
    return typed


def write_typed_ledger(df: DataFrame, path: str) -> DataFrame:
    """Stores a typed ledger by month, so a period report opens only its own months.

    The rebalance hint gathers a month into files of a useful size and, at run time,
    splits a month that is too large for one task.
    """
    df.hint("rebalance", "ledger_month").write.mode("overwrite").partitionBy("ledger_month").option(
        "maxRecordsPerFile", ROWS_PER_FILE
    ).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report(report: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """One CSV file with header, for reports: aggregates of at most some hundred rows.

    The aggregate itself stays parallel; only its result goes to the writing task.
    """
    rows = report.repartition(1)
    if order_by:
        rows = rows.sortWithinPartitions(*order_by)
    rows.write.mode("overwrite").options(header=True, escape='"').csv(path)


def jdbc_options(
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    environment: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a partitioned database read; connection settings come from the environment."""
    env = os.environ if environment is None else environment
    missing = [v for v in ("LEDGER_DB_URL", "LEDGER_DB_USER", "LEDGER_DB_PASSWORD") if not env.get(v)]
    if missing:
        raise ValueError("set " + ", ".join(missing))
    return {
        "url": env["LEDGER_DB_URL"],
        "user": env["LEDGER_DB_USER"],
        "password": env["LEDGER_DB_PASSWORD"],
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_database(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def load_sql(path: str | Path) -> str:
    return Path(path).read_text(encoding="utf-8")


def statements(text: str) -> list[str]:
    """The statements of a SQL file; semicolons in strings, quoted names and comments divide nothing."""
    token = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^;]""", re.S)
    out, here = [], ""
    for part in token.findall(text):
        if part == ";":
            out.append(here)
            here = ""
        elif not part.startswith(("--", "/*")):
            here += part
    return [s.strip() for s in [*out, here] if s.strip()]


def run_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Runs SQL text over the given frames: ``{name}`` is a table, ``:name`` a parameter.

    Of several statements the result of the last one is returned; the others run before it.
    """
    return run_script(spark, text, tables, params)[-1]


def run_script(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    params: Mapping[str, object] | None = None,
) -> list[DataFrame]:
    """The results of all statements of a SQL file, in order; each may use all tables and parameters."""
    given = dict(params or {})
    results = []
    for statement in statements(text):
        named = {k: v for k, v in given.items() if re.search(rf":{re.escape(k)}\b", statement)}
        held = {k: v for k, v in tables.items() if f"{{{k}}}" in statement}
        results.append(spark.sql(statement, args=named, **held))
    if not results:
        raise ValueError("no statement to run")
    return results
