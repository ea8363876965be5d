"""Was everything in the files loaded? Line, record and structure checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import escape_preview, has_line_break
from ..operators.perkey import distinct_keys
from ..operators.skew import spread_join
from ..operators.summaries import first_rows
from ..session import scratch_dir
from .csvfiles import PREVIEW_CHARS, PREVIEW_FIELDS, find_parsed, preview, read_parsed
from .headers import clean_header, read_header
from .records import Paths, file_totals, numbered_lines, own_cells, read_records


def physical_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Per file: physical lines without the header line. A last line without end counts."""
    return file_totals(spark, path).select("file", (F.col("lines") - 1).alias("data_lines"))


def line_vs_record_count(spark: SparkSession, path: Paths, loaded: DataFrame) -> DataFrame:
    """One row: data lines of the files, rows loaded, difference and verdict.

    Line breaks inside fields make the line count larger than the row count; the
    multi-line report then shows where.
    """
    expected = physical_lines(spark, path).agg(F.sum("data_lines").alias("n"))
    rows = loaded.agg(F.count("*").alias("n"))
    both = expected.select(F.col("n").alias("expected_lines"), F.lit(None).cast("bigint").alias("loaded_rows"))
    both = both.unionByName(
        rows.select(F.lit(None).cast("bigint").alias("expected_lines"), F.col("n").alias("loaded_rows"))
    )
    return (
        both.agg(F.max("expected_lines").alias("expected_lines"), F.max("loaded_rows").alias("loaded_rows"))
        .withColumn("diff", F.col("expected_lines") - F.col("loaded_rows"))
        .withColumn("matches", F.col("diff") == 0)
    )


def record_shape(spark: SparkSession, path: Paths) -> DataFrame:
    """One row: logical records without the header, and columns in the header."""
    columns = len(read_header(spark, path))
    return file_totals(spark, path).agg(
        F.sum(F.col("records") - 1).cast("bigint").alias("records"),
        F.lit(columns).cast("bigint").alias("columns"),
    )


# Cells shown of a record without a break in any of them, and characters shown.
FIRST_CELLS, BREAK_CHARS = 5, 120


def multiline_records(
    spark: SparkSession,
    path: Paths,
    key: str | None = None,
    preview_chars: int = BREAK_CHARS,
    first: int | None = None,
) -> DataFrame:
    """Records that span several lines, with position, key and the fields holding the breaks.

    The fields are the record's own, also those that the header does not name. ``first``
    stops after so many findings, in the order of the files.
    """
    raw_names = read_header(spark, path)
    names = clean_header(raw_names)
    labels = F.array(*(F.lit(name if name is not None else "") for name in raw_names))
    broken = F.transform(F.col("own"), lambda c, i: F.struct(i.alias("i"), c.alias("cell")))
    name_of = lambda b: F.coalesce(F.get(labels, b["i"]), F.lit(""))
    first_broken = F.get("broken", F.lit(0))
    shown = F.concat(name_of(first_broken), F.lit(": "), escape_preview(first_broken["cell"], preview_chars))
    cells = F.array_join(F.slice("own", 1, FIRST_CELLS), " | ")
    named = F.filter("broken", lambda b: b["i"] < len(names))
    key_cell = F.get("own", F.lit(names.index(key))) if key in names else F.lit("")
    several = (F.col("end_line") > F.col("start_line")) | has_line_break("raw")
    place = ["file", "record_num", "start_line", "end_line"]
    records, _ = find_parsed(spark, path, several, [F.col(c) for c in (*place, "raw")])
    found = (
        records.withColumn("own", own_cells("raw"))
        .withColumn("broken", F.filter(broken, lambda b: has_line_break(b["cell"])))
        .select(
            "file",
            "record_num",
            "start_line",
            "end_line",
            (F.col("end_line") - F.col("start_line")).alias("extra_physical_lines"),
            F.coalesce(key_cell, F.lit("")).alias("unique_key"),
            F.array_join(F.transform("broken", lambda b: b["i"].cast("string")), ";").alias(
                "fields_with_newline_indexes"
            ),
            F.array_join(F.transform(named, name_of), ";").alias("fields_with_newline_names"),
            F.when(F.size("broken") > 0, shown).otherwise(escape_preview(cells, preview_chars)).alias("preview"),
        )
    )
    return found if first is None else first_rows(found, first, ["file", "record_num"])


def multiline_totals(spark: SparkSession, path: Paths) -> DataFrame:
    """One row: records scanned, multi-line records and the sum of their extra lines.

    Only flags of the lines are looked at; no record is put together for this.
    """
    lines = numbered_lines(spark, path, columns=("inner_cr",)).where("record_num > 0")
    return lines.agg(
        F.count_if(F.col("starts")).alias("scanned_records"),
        F.count_if(F.col("starts") & (~F.col("whole") | F.col("inner_cr"))).alias("multiline_records"),
        F.count_if(~F.col("starts")).alias("extra_physical_lines"),
    )


def bad_structure(
    spark: SparkSession,
    path: Paths,
    preview_fields: int = PREVIEW_FIELDS,
    preview_chars: int = PREVIEW_CHARS,
    first: int | None = None,
) -> DataFrame:
    """Records whose field count differs from the header's, blank lines included, and
    records whose quote is never closed, shown by their first line. ``first`` stops after
    so many findings, in the order of the files."""
    columns = [
        *(F.col(c) for c in ("file", "record_num", "start_line", "end_line")),
        F.col("fields").alias("actual_fields"),
        F.col("expected").alias("expected_fields"),
        F.col("unclosed"),
        preview("raw", preview_fields, preview_chars).alias("preview"),
    ]
    found, _ = find_parsed(spark, path, F.expr("fields <> expected OR unclosed"), columns)
    return found if first is None else first_rows(found, first, ["file", "record_num"])


def quote_balance(spark: SparkSession, path: Paths) -> DataFrame:
    """Per file: lines, records, quotes, and the record that an open quote never lets end."""
    return file_totals(spark, path).select(
        "file", "lines", "records", "quotes", F.col("unclosed").alias("open_record")
    )


def record_positions(spark: SparkSession, path: Paths) -> DataFrame:
    """Per file: records, header included, their lines, and faults in their positions.

    Where one record ends the next one has to begin, with the next number. Each end and each
    beginning is a key, so a file of any size is compared in all tasks; what finds no
    counterpart, but for the first beginning and the last end, is a fault.
    """
    rows = read_records(spark, path).select("file", "record_num", "start_line", "end_line")
    edges = F.explode(
        F.array(
            F.struct(F.col("end_line").alias("line"), F.col("record_num").alias("num"), F.lit(1).alias("sign")),
            F.struct((F.col("start_line") - 1).alias("line"), (F.col("record_num") - 1).alias("num"), F.lit(-1).alias("sign")),
        )
    )
    met = rows.select("file", edges.alias("e")).groupBy("file", "e.line", "e.num").agg(F.sum("e.sign").alias("over"))
    loose = met.where("over <> 0").groupBy("file").agg((F.count("*") - 2).alias("faults"))
    totals = rows.groupBy("file").agg(
        F.count("*").alias("records"),
        F.sum(F.col("end_line") - F.col("start_line") + 1).cast("bigint").alias("lines"),
        F.max("record_num").alias("last_record"),
        F.max("end_line").alias("last_line"),
    )
    return totals.join(loose, "file")


def terminator_profile(spark: SparkSession, path: Paths) -> DataFrame:
    """Per file: lines ended by CR LF and by LF alone, and which of them prevails."""
    return file_totals(spark, path).select(
        "file",
        "crlf_lines",
        (F.col("lines") - F.col("crlf_lines")).alias("lf_lines"),
        F.when(2 * F.col("crlf_lines") >= F.col("lines"), "CRLF").otherwise("LF").alias("terminator"),
    )


def missing_rows(
    source: DataFrame, source_key: str, target: DataFrame, target_key: str
) -> DataFrame:
    """Source rows whose key the target lacks; blank keys are skipped, duplicates are kept.

    Only keys are compared. The missing ones are written, so that their size is known when
    the rows are fetched: if it is small, they go to the rows and no row is moved.
    """
    keyed = source.withColumn("lookup_key", F.trim(source_key)).where("lookup_key <> ''")
    lost = distinct_keys(keyed, "lookup_key", "lost_key").join(
        distinct_keys(target, target_key, "target_key"), F.col("lost_key") == F.col("target_key"), "left_anti"
    )
    stored = _stored(lost, "missing_keys")
    return spread_join(keyed, stored, "lookup_key", "lost_key", "left_semi").drop("lookup_key")


def missing_positions(
    spark: SparkSession, path: Paths, key: str, target: DataFrame, target_key: str
) -> DataFrame:
    """(lost_file, lost_record) of the records of a CSV file whose key the target lacks."""
    keys = read_parsed(spark, path).select(
        F.trim(F.col(f"cells.`{key}`")).alias("lookup_key"),
        F.xxhash64("file").alias("lost_file"),
        F.col("record_num").alias("lost_record"),
    )
    return spread_join(
        keys.where("lookup_key <> ''"),
        distinct_keys(target, target_key, "target_key"),
        "lookup_key",
        "target_key",
        "left_anti",
    ).drop("lookup_key")


def missing_records(
    spark: SparkSession, path: Paths, key: str, target: DataFrame, target_key: str
) -> DataFrame:
    """Missing rows of a CSV file with their record number, the header being number 1.

    Keys and places are compared first; the records at these places are then fetched.
    """
    lost = _stored(missing_positions(spark, path, key, target, target_key), "missing_records")
    here = (F.xxhash64("file") == F.col("lost_file")) & (F.col("record_num") == F.col("lost_record"))
    return read_parsed(spark, path).join(lost, here, "left_semi").select(
        (F.col("record_num") + 1).alias("source_line_num"), "cells.*"
    )


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as written to a scratch folder, where Spark knows its size."""
    folder = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
