"""CSV exports that Spark writes from the sample tables, to be staged and checked again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sample
from ..session import scratch_dir

_written: dict[tuple[str, str, str], str] = {}

# Raw lines of a damaged order export: one field too few, one too many, or whole.
DAMAGED_HEADER = "order-key,order status,priority"
DAMAGED_LINE = (
    "CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_orderkey AS STRING) || ',' || o_orderstatus "
    "WHEN o_orderkey % 103 = 0 THEN CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || o_orderpriority || ',extra' "
    "ELSE CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',\"' || o_orderpriority || '\"' END"
)
# Raw lines of an export put together from systems with different line ends.
MIXED_CR = "o_custkey % 5 = 0"
# Documents per file of an export whose files are read whole.
ROWS_PER_SMALL_FILE = 2_000


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Writes an export the first time a session asks for it and returns its folder."""
    where = (spark.sparkContext.applicationId, sf_dir, name)
    if where not in _written:
        path = scratch_dir(spark, name)
        write(path)
        _written[where] = path
    return _written[where]


def _write_csv(df: DataFrame, path: str, **options: object) -> None:
    df.write.options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **options,
    ).csv(path)


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """Texts with line breaks, quotes and commas inside quoted cells."""
    docs = sample.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return _once(spark, sf_dir, "documents", lambda p: _write_csv(docs, p))


def small_documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """The same in files of at most ``ROWS_PER_SMALL_FILE`` records each, however many documents there are."""
    docs = sample.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    small = lambda p: _write_csv(docs, p, maxRecordsPerFile=ROWS_PER_SMALL_FILE)
    return _once(spark, sf_dir, "small_documents", small)


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    orders = sample.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    return _once(spark, sf_dir, "orders", lambda p: _write_csv(orders, p))


def ar_ledger_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "ar_ledger", lambda p: _write_csv(sample.ar_ledger(spark, sf_dir), p)
    )


def _write_lines(df: DataFrame, header: str, path: str) -> None:
    """One text file per task; its first line is the header, as in an export cut into files.

    The header travels in front of a task's first row, so no task needs to see another's rows.
    """
    first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
    df.select(
        F.when(first, F.concat(F.lit(header + "\n"), F.col("line"))).otherwise(F.col("line")).alias("value")
    ).write.option("lineSep", "\n").text(path)


def damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    lines = sample.table(spark, sf_dir, "orders").select(F.expr(DAMAGED_LINE).alias("line"))
    return _once(spark, sf_dir, "damaged", lambda p: _write_lines(lines, DAMAGED_HEADER, p))


def mixed_terminators_csv(spark: SparkSession, sf_dir: str) -> str:
    line = F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    )
    line = F.when(F.expr(MIXED_CR), F.concat(line, F.lit("\r"))).otherwise(line)
    lines = sample.table(spark, sf_dir, "orders").select(line.alias("line"))
    return _once(spark, sf_dir, "mixed", lambda p: _write_lines(lines, "order_key,status,priority", p))


def quoted_names_csv(spark: SparkSession, sf_dir: str) -> str:
    """Lines with a quoted comma, to be split at every comma by the unquoted load."""
    lines = sample.table(spark, sf_dir, "customer").select(
        F.concat(
            F.col("c_custkey").cast("string"),
            F.lit(',"'),
            F.col("c_mktsegment"),
            F.lit(","),
            F.col("c_name"),
            F.lit('"'),
        ).alias("line")
    )
    return _once(spark, sf_dir, "quoted_names", lambda p: _write_lines(lines, "custkey,segment,name", p))
