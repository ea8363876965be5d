"""Load jobs: from CSV exports to staged tables, with the checks that guard them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import csvfiles, quality
from ..sources.records import file_names
from ..sources.sinks import append_missing, beside, drop_folder, publish, replace_table

MODES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "strict": csvfiles.read_strict,
    "quoted": csvfiles.read_quoted,
    "unquoted": csvfiles.read_unquoted,
    "inferred": csvfiles.read_inferred,
}
# Modes that skip malformed records, and whether quotes count in them.
TOLERANT_MODES = {"tolerant": True, "tolerant_unquoted": False}


class LoadMismatch(RuntimeError):
    """The number of rows loaded is not the number of data lines in the files."""


@dataclass(frozen=True)
class LoadJob:
    """One table to stage. A tolerant mode needs ``reject_cap``: how many records may be skipped."""

    table: str
    path: str
    mode: str = "strict"
    reject_cap: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES and self.mode not in TOLERANT_MODES:
            raise ValueError(f"unknown load mode {self.mode!r} of {self.table}")
        if (self.mode in TOLERANT_MODES) != (self.reject_cap is not None):
            raise ValueError(f"{self.table}: tolerant modes, and only these, need a reject_cap")


METRICS = "table_name string, data_lines bigint, loaded_rows bigint, rejected_rows bigint"


def replace_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Writes a table as :func:`replace_table` does; the write itself counts the rows."""
    counts = Observation()
    stored = replace_table(df.observe(counts, F.count(F.lit(1)).alias("rows")), path)
    return stored, counts.get["rows"]


def data_lines(spark: SparkSession, path: str) -> int:
    """Physical lines of the files without their header lines, from the counted splits."""
    return quality.physical_lines(spark, path).agg(F.coalesce(F.sum("data_lines"), F.lit(0))).first()[0]


@contextmanager
def _staged(spark: SparkSession, staging: str) -> Iterator[None]:
    """What a load writes for itself goes when it is done or refused."""
    try:
        yield
    finally:
        drop_folder(spark, staging)


def _write_table(spark: SparkSession, path: str, place: str, policy: str) -> tuple[DataFrame, int]:
    """Writes a quoted or strict load beside the table and puts it in its place; also its rows."""
    staging = beside(place, "new")
    with _staged(spark, staging):
        done = csvfiles.write_cells(spark, path, staging, policy)
        publish(spark, done.good, place)
    return spark.read.parquet(place), done.loaded


def load_with_metrics(
    spark: SparkSession, jobs: Iterable[LoadJob], target: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stages the tables one after the other; returns them as stored, and the load's own counts.

    The counts are one row per job: data lines of the files, rows loaded and rejected, both
    counted by the write, and whether they agree. No table is read for them. A tolerant job
    parses once, splits good rows and rejects while writing, and puts the good ones in the
    table's place when the cap holds; what it skipped is stored as ``<table>_rejects``.
    """
    stored, counted, base = {}, [], target.rstrip("/")
    for job in jobs:
        place, rejected = f"{base}/{job.table}", 0
        if job.mode in TOLERANT_MODES:
            rejects = f"{job.table}_rejects"
            staging, quoted = beside(place, "new"), TOLERANT_MODES[job.mode]
            with _staged(spark, staging):
                done = csvfiles.write_split(
                    spark, job.path, job.reject_cap, f"{base}/{rejects}", staging, quoted=quoted
                )
                publish(spark, done.good, place)
            stored[rejects], loaded, rejected = done.rejects, done.loaded, done.rejected
            stored[job.table] = spark.read.parquet(place)
        elif job.mode in csvfiles.POLICIES:
            stored[job.table], loaded = _write_table(spark, job.path, place, job.mode)
        else:
            df = csvfiles.empty_to_null(MODES[job.mode](spark, job.path))
            stored[job.table], loaded = replace_counted(df, place)
        counted.append((job.table, data_lines(spark, job.path), loaded, rejected))
    metrics = spark.createDataFrame(counted, METRICS)
    return stored, metrics.withColumn("matches", F.expr("data_lines = loaded_rows + rejected_rows"))


def load_all(spark: SparkSession, jobs: Iterable[LoadJob], target: str) -> dict[str, DataFrame]:
    """Stages the tables one after the other; returns them as stored.

    A tolerant job also stores what it skipped, as ``<table>_rejects`` next to the table.
    """
    return load_with_metrics(spark, jobs, target)[0]


def load_in_batches(
    spark: SparkSession, path: str, target: str, mode: str = "strict", files_per_batch: int = 1
) -> list[str]:
    """Appends an export batch by batch, one commit each; returns the batches that were added.

    A batch is a run of the export's files, in the order of their names. One that is there
    already is left out, so a load that broke off goes on where it stopped, and doing it again
    adds nothing.
    """
    files = sorted(r.file for r in file_names(spark, path).select("file").collect())  # the driver lists them anyway
    runs = [files[i : i + files_per_batch] for i in range(0, len(files), files_per_batch)]
    batches = {
        f"{n:06d}": lambda run=run: csvfiles.empty_to_null(MODES[mode](spark, run)) for n, run in enumerate(runs)
    }
    return append_missing(batches, target, spark)


def check_loaded(
    spark: SparkSession, path: str, loaded: DataFrame, key: str, out_dir: str, rows: int | None = None
) -> DataFrame:
    """Passes the table on when rows and data lines agree.

    Otherwise the rows and keys of the file that the table lacks are written to
    ``out_dir`` and the load stops. No missing rows means that line breaks inside
    fields explain the difference. ``rows`` is what the load counted; without it the table
    is counted.
    """
    expected = data_lines(spark, path)
    rows = loaded.count() if rows is None else rows
    if expected == rows:
        return loaded
    rows_dir = f"{out_dir.rstrip('/')}/missing_rows"
    missing = quality.missing_records(spark, path, key, loaded, key)
    missing.write.mode("overwrite").options(header=True, escape='"').csv(rows_dir)
    names = missing.schema
    stored = spark.read.schema(names).options(header=True, multiLine=True, escape='"').csv(rows_dir)
    stored.select(F.trim(key)).write.mode("overwrite").text(f"{out_dir.rstrip('/')}/missing_keys")
    raise LoadMismatch(
        f"{path}: expected {expected} lines, loaded {rows} rows, "
        f"missing {stored.count()}; see {rows_dir}"
    )


def load_validated(
    spark: SparkSession, path: str, target: str, key: str, out_dir: str
) -> DataFrame:
    """Strict load of a ledger followed by the line-count check."""
    stored, rows = _write_table(spark, path, target, "strict")
    return check_loaded(spark, path, stored, key, out_dir, rows)
