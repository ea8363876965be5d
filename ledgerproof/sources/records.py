"""Where CSV records lie in a file, found in parallel.

A quoted field may hold line breaks, so a line alone does not tell whether it starts a
record: that takes the number of quotes before it, back to the start of the file. Here
every split is first counted on its own, for both possible states at its start; a running
sum over one small row per split then says which of the two applies. With that known, each
task joins the lines of its records by itself. Only the pieces of the records that straddle
a split's end are shuffled; the lines that hold them are picked out before they are moved.

The counts are kept: they are written once per export, with quotes and line ends, and every
reader of the session takes them from there (:func:`scan_facts`), so each of them reads the
text once.

A file with an odd number of quotes has one that is never closed. Everything behind the
start of its last record would belong to that record, so its lines are not put together,
whatever their number: the record is reported by its first line as ``unclosed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import linescan

# The scan functions travel to the executors with the query; the package need not be there.
cloudpickle.register_pickle_by_value(linescan)

# The split table is broadcast up to this many splits (a hundred bytes each, 250 TB of files in
# splits of 256 MB); beyond it the join is left to Spark.
MAX_BROADCAST_SPLITS = 1_000_000

# One path, or the files of an export.
Paths = str | Sequence[str]

# What an unquoted cell holds in place of a delimiter that stands between quotes.
_INSIDE, _ESCAPED = "\u0001\u0003", "\u0001\u0002"


def file_names(spark: SparkSession, path: Paths) -> DataFrame:
    """(file_id, file) of the files, which are listed and not read."""
    file = F.col("_metadata.file_path")
    listed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    return listed.select(F.xxhash64(file).alias("file_id"), file.alias("file"))


def raw_lines(spark: SparkSession, path: Paths, quote: str = '"') -> DataFrame:
    """Physical lines with the split they start in and their number of quotes."""
    value = F.col("value")
    without = F.octet_length(F.replace(value, F.lit(quote), F.lit("")))
    return (
        spark.read.option("lineSep", "\n")
        .text(path if isinstance(path, str) else list(path))
        .select(
            value,
            F.xxhash64(F.col("_metadata.file_path")).alias("file_id"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.when(F.contains(value, F.lit(quote)), F.octet_length(value) - without)
            .otherwise(F.lit(0))
            .alias("quotes"),
            F.contains(F.rtrim(value, F.lit("\r")), F.lit("\r")).alias("inner_cr"),
            F.endswith(value, F.lit("\r")).cast("int").alias("crlf"),
            F.monotonically_increasing_id().alias("pos"),
        )
    )


def split_offsets(lines: DataFrame) -> DataFrame:
    """One row per split: lines and records before it and in it, and the quote state at its start.

    ``head``: lines before its first record; ``tail``: the line from which its last record is
    cut off by its end, or the number of lines; ``unclosed``: number of the file's record
    with the open quote, or NULL; ``file_lines``; ``split_quotes`` and ``crlf_lines`` in the split.
    """
    fields = linescan.COUNTED
    counted = lines.select("file_id", "split_start", "quotes", "crlf", "pos").mapInArrow(
        linescan.count_splits, ", ".join(f"{f} bigint" for f in fields)
    )
    # One row per split, so even a file of 100 TB is some 400,000 rows here.
    earlier = Window.partitionBy("file_id").orderBy("split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole_file = Window.partitionBy("file_id")

    def before(total: Column) -> Column:
        return F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("bigint")

    even = F.col("start_parity") == 0
    starts = F.when(even, F.col("evens")).otherwise(F.col("lines") - F.col("evens"))
    head = F.when(even, F.lit(0)).otherwise(F.col("first_odd"))
    last = F.when(even, F.col("last_even")).otherwise(F.col("last_odd"))
    cut_off = ((F.col("start_parity") + F.col("quotes")) % 2 == 1) & (starts > 0)
    odd_file = F.sum("quotes").over(whole_file) % 2 == 1
    return (
        counted.withColumn("line_offset", before(F.col("lines")))
        .withColumn("start_parity", before(F.col("quotes")) % 2)
        .withColumns({"starts": starts, "head": head})
        .withColumn("tail", F.when(cut_off, last).otherwise(F.col("lines")))
        .withColumn("record_offset", before(F.col("starts")))
        .withColumn("unclosed", F.when(odd_file, F.sum("starts").over(whole_file) - 1))
        .withColumn("file_lines", F.sum("lines").over(whole_file))
        .withColumnRenamed("quotes", "split_quotes")
        .drop("evens", "last_even", "first_odd", "last_odd")
    )


_facts: dict[tuple, tuple[str, int]] = {}
# What decides how Spark cuts files into splits.
_SPLIT_SETTINGS = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.files.openCostInBytes",
    "spark.sql.files.minPartitionNum",
    "spark.sql.files.maxPartitionNum",
)


def _state(spark: SparkSession, path: Paths) -> tuple:
    """The files as they are now, and how they would be cut; files are listed and not read."""
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    row = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(one), F.lit(0))).first()
    settings = [spark.conf.get(s, None) for s in _SPLIT_SETTINGS]
    return *row, *settings, spark.sparkContext.defaultParallelism


def _counted(spark: SparkSession, path: Paths, quote: str) -> tuple[str, int]:
    """Folder and size of the split table of an export in its present state."""
    where = path if isinstance(path, str) else tuple(path)
    key = (spark.sparkContext.applicationId, where, quote, *_state(spark, path))
    if key not in _facts:
        folder = scratch_dir(spark, "splits")
        split_offsets(raw_lines(spark, path, quote)).write.parquet(folder)
        _facts[key] = folder, spark.read.parquet(folder).count()
    return _facts[key]


def scan_facts(spark: SparkSession, path: Paths, quote: str = '"') -> DataFrame:
    """The split table, counted once per export, state of its files and session.

    Line, record and quote counts and line ends of the files follow from it without
    reading them again, and so does where the records of a split begin.
    """
    return spark.read.parquet(_counted(spark, path, quote)[0])


def _with_offsets(spark: SparkSession, path: Paths, columns: list[str], quote: str) -> DataFrame:
    """Lines next to the offsets of their split, with ``at``, their place in it from 0.

    A broadcast leaves the lines where and in the order they are read. With too many
    splits for that, the lines are brought together by split and put in order again.
    Should Spark cut the files otherwise than it did for the split table, the query stops.
    """
    lines = raw_lines(spark, path, quote)
    folder, splits = _counted(spark, path, quote)
    offsets = spark.read.parquet(folder).drop("split_quotes", "crlf_lines")
    rows = lines.select(*dict.fromkeys([*columns, "file_id", "split_start", "quotes", "pos"]))
    place = F.col("pos") - F.col("first_pos")
    moved = F.raise_error(F.lit("the files are not cut as they were when they were counted")).cast("bigint")
    at = F.when((place >= 0) & (place < F.col("lines")), place).otherwise(moved).alias("at")
    if splits <= MAX_BROADCAST_SPLITS:
        return rows.join(F.broadcast(offsets), ["file_id", "split_start"], "left").select("*", at)
    joined = rows.join(offsets, ["file_id", "split_start"], "left").select("*", at)
    return joined.repartition("file_id", "split_start").sortWithinPartitions(
        "file_id", "split_start", "pos"
    )


def numbered_lines(
    spark: SparkSession, path: Paths, quote: str = '"', columns: tuple[str, ...] = ("value",)
) -> DataFrame:
    """Every physical line with its line number (from 1) and record number (header is 0).

    ``columns`` of the raw lines are kept. ``starts`` marks the first line of a record
    and ``whole`` a line that is a record by itself.
    """
    lines = _with_offsets(spark, path, list(columns), quote).select(
        *columns, "file_id", "split_start", "quotes", "line_offset", "record_offset", "start_parity"
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    return lines.mapInArrow(
        linescan.number_lines, f"{schema}, line_num bigint, record_num bigint, starts boolean"
    ).select(
        "file_id",
        *columns,
        "line_num",
        "record_num",
        "starts",
        (F.col("starts") & (F.col("quotes") % 2 == 0)).alias("whole"),
    )


def file_totals(spark: SparkSession, path: Paths, quote: str = '"') -> DataFrame:
    """Per file, from the split table alone: physical lines, records, header included, quotes,
    lines ended by CR LF, and the record that an open quote never lets end (NULL without one)."""
    totals = (
        scan_facts(spark, path, quote)
        .groupBy("file_id")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("starts").alias("records"),
            F.sum("split_quotes").alias("quotes"),
            F.sum("crlf_lines").alias("crlf_lines"),
            F.max("unclosed").alias("unclosed"),
        )
    )
    return file_names(spark, path).join(totals, "file_id").drop("file_id")


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with ``in_head``, ``piece_num`` (record number of a line of a straddling record, else
    NULL) and without those of an open-ended record but its first."""
    in_head = F.col("at") < F.col("head")
    number = F.col("record_offset") + F.when(in_head, F.lit(0)).otherwise(F.col("starts")) - 1
    apart = in_head | (F.col("at") >= F.col("tail"))
    piece = F.when(apart, number)
    # An open-ended record is shown by its first line.
    shown = ~number.eqNullSafe(F.col("unclosed")) | (F.col("at") == F.col("tail"))
    return lines.withColumn("piece_num", piece).where(~apart | shown)


def _joined_pieces(pieces: DataFrame, facts: DataFrame) -> DataFrame:
    """Records put together from their lines (file_id, record_num, line, value)."""
    files = facts.groupBy(F.col("file_id").alias("of_file")).agg(
        F.max("unclosed").alias("open_record"), F.max("file_lines").alias("file_lines")
    )
    lines = F.sort_array(F.collect_list(F.struct("line", "value")))
    joined = pieces.groupBy("file_id", "record_num").agg(
        F.min("line").alias("start_line"),
        F.max("line").alias("last_line"),
        F.array_join(F.transform(lines, lambda p: p["value"]), "\n").alias("raw"),
    )
    unclosed = F.col("record_num").eqNullSafe(F.col("open_record"))
    return joined.join(files, F.col("file_id") == F.col("of_file")).select(
        "file_id",
        "record_num",
        "start_line",
        F.when(unclosed, F.col("file_lines")).otherwise(F.col("last_line")).alias("end_line"),
        "raw",
        unclosed.alias("unclosed"),
    )


def _named(records: DataFrame, spark: SparkSession, path: Paths) -> DataFrame:
    """Records with their file's name instead of its number, and without a CR at their end."""
    raw = F.col("raw")
    without_cr = F.when(F.endswith(raw, F.lit("\r")), F.left(raw, F.length(raw) - 1)).otherwise(raw)
    # The driver lists the files of every read; their names are no more than that.
    named = records.join(F.broadcast(file_names(spark, path)), "file_id")
    return named.withColumn("raw", without_cr)


RECORD = ["file", "record_num", "start_line", "end_line", "raw", "unclosed"]
_JOINED = "file_id bigint, record_num bigint, start_line bigint, end_line bigint, raw string"
_NEEDED = ["value", "file_id", "split_start", "quotes", "pos", "line_offset", "record_offset", "head"]


def read_records(spark: SparkSession, path: Paths, quote: str = '"') -> DataFrame:
    """CSV records as raw text: file, record_num, start_line, end_line, raw, unclosed.

    Records within a split are joined where they are read; only the pieces of records
    that straddle a split end are shuffled. The pieces are looked for in a scan of their own,
    which hands no text to Python; :func:`records_and_pieces` needs one scan for both.
    """
    lines = _placed(_with_offsets(spark, path, ["value"], quote))
    inside = lines.where("piece_num IS NULL").select(_NEEDED).mapInArrow(linescan.join_records, _JOINED)
    pieces = lines.where("piece_num IS NOT NULL").select(
        "file_id", F.col("piece_num").alias("record_num"), (F.col("line_offset") + F.col("at") + 1).alias("line"), "value"
    )
    straddling = _joined_pieces(pieces, scan_facts(spark, path, quote))
    every = inside.withColumn("unclosed", F.lit(False)).unionByName(straddling)
    return _named(every, spark, path).select(RECORD)


def records_and_pieces(spark: SparkSession, path: Paths, quote: str = '"') -> DataFrame:
    """The columns of :func:`read_records`, file_id and ``piece``, from one scan of the text.

    A row with ``piece`` set is one line of a record that straddles a split's end: its record's
    number, its line as start and end, its text as raw. Whoever writes the other rows writes
    these beside them and reads the few of them again for :func:`records_of_pieces`.
    """
    lines = _placed(_with_offsets(spark, path, ["value"], quote)).select(*_NEEDED, "at", "piece_num")
    rows = lines.mapInArrow(linescan.split_records, f"{_JOINED}, piece boolean").withColumn("unclosed", F.lit(False))
    whole = _named(rows.withColumn("line", F.col("raw")), spark, path)
    return whole.withColumn("raw", F.when(F.col("piece"), F.col("line")).otherwise(F.col("raw"))).select(
        *RECORD, "file_id", "piece"
    )


def records_of_pieces(spark: SparkSession, path: Paths, pieces: DataFrame, quote: str = '"') -> DataFrame:
    """The records of pieces that were written (file_id, record_num, line, value), in the same columns."""
    joined = _joined_pieces(pieces, scan_facts(spark, path, quote))
    return _named(joined, spark, path).select(*RECORD, "file_id", F.lit(False).alias("piece"))


def field_count(raw: Column | str, quote: str = '"', delimiter: str = ",") -> Column:
    """Number of fields of a raw record; delimiters between quotes do not count.

    Splitting at the quotes leaves the text outside quotes at the even places.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    pieces = F.split(raw, quote)
    outside = F.array_join(F.filter(pieces, lambda _, i: i % 2 == 0), "")
    seen = F.when(F.contains(raw, F.lit(quote)), outside).otherwise(raw)
    commas = F.length(seen) - F.length(F.replace(seen, F.lit(delimiter), F.lit("")))
    return F.when(raw == "", F.lit(0)).otherwise(commas + 1)


def own_cells(raw: Column | str, quote: str = '"', delimiter: str = ",") -> Column:
    """All cells of a raw record, as many as it has, without their quotes.

    Delimiters outside quotes are marked, which is where the record is then split.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    replaced = lambda text, old, new: F.replace(text, F.lit(old), F.lit(new))
    pieces = F.split(replaced(raw, "\u0001", _ESCAPED), quote)
    marked = F.transform(
        pieces, lambda p, i: F.when(i % 2 == 0, replaced(p, delimiter, _INSIDE)).otherwise(p)
    )
    cells = F.split(F.array_join(marked, quote), _INSIDE)

    def plain(cell: Column) -> Column:
        inner = replaced(F.substring(cell, F.lit(2), F.length(cell)), quote * 2, _INSIDE)
        bare = replaced(replaced(inner, quote, ""), _INSIDE, quote)
        return replaced(F.when(F.startswith(cell, F.lit(quote)), bare).otherwise(cell), _ESCAPED, "\u0001")

    return F.when(raw == "", F.array().cast("array<string>")).otherwise(F.transform(cells, plain))
