"""The registered queries: one per report and operator, over the sample tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sample
from ..functions import TOTAL, day_of, in_months, in_period, money, normalised, try_money, year_prefix
from ..operators import cutoff, filters, summaries
from ..operators.controls import compare_controls, long_metrics, tie_out as tie_out_proof
from ..session import scratch_dir
from ..sources import csvfiles, quality, sinks
from . import exports, load, reports

Query = Callable[[SparkSession, str], DataFrame]
CFG = sample.CONFIG
PERIOD = sample.PERIOD
SQL_DIR = Path(__file__).parent / "sql"

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# The period tables of the real project are cuts of the all-time ones, and every report
# filters them by period again; here the all-time ledger serves as both.
def _payout(spark: SparkSession, sf: str) -> DataFrame:
    return sample.full_payout(spark, sf)


def _bank(spark: SparkSession, sf: str) -> DataFrame:
    return sample.full_bank(spark, sf)


def _day_as_text(df: DataFrame, column: str = "withdrawal_date") -> DataFrame:
    """Days as ISO text, which every client shows alike."""
    return df.withColumn(column, F.col(column).cast("string"))


# -- reports ------------------------------------------------------------------------------


@query
def join_diff(spark: SparkSession, sf: str) -> DataFrame:
    return reports.join_diff(_payout(spark, sf), _bank(spark, sf), CFG)


@query
def join_diff_by_method(spark: SparkSession, sf: str) -> DataFrame:
    return reports.join_diff_by_method(_payout(spark, sf), _bank(spark, sf), CFG)


@query
def join_diff_no_preagg(spark: SparkSession, sf: str) -> DataFrame:
    return reports.join_diff_by_method(_payout(spark, sf), _bank(spark, sf), CFG, sum_bank_first=False)


@query
def payout_not_bank_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    bank = _bank(spark, sf)
    return cutoff.payout_not_bank_cutoff(_payout(spark, sf), bank, bank, CFG)


@query
def payout_not_bank_cutoff_earliest(spark: SparkSession, sf: str) -> DataFrame:
    bank = _bank(spark, sf)
    return cutoff.payout_not_bank_cutoff(_payout(spark, sf), bank, bank, CFG, earliest=True)


@query
def payout_not_bank_cutoff_scoped(spark: SparkSession, sf: str) -> DataFrame:
    bank = _bank(spark, sf)
    return cutoff.payout_not_bank_cutoff_scoped(_payout(spark, sf), bank, bank, CFG)


@query
def payout_not_bank_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cutoff.payout_not_bank_totals(_payout(spark, sf), _bank(spark, sf), CFG)


@query
def payout_unmatched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _day_as_text(cutoff.unmatched_payout_rows(_payout(spark, sf), _bank(spark, sf), CFG))


@query
def payout_unresolved_detail(spark: SparkSession, sf: str) -> DataFrame:
    bank = _bank(spark, sf)
    return _day_as_text(cutoff.payout_unresolved_rows(_payout(spark, sf), bank, bank, CFG))


@query
def payout_undated_detail(spark: SparkSession, sf: str) -> DataFrame:
    bank = _bank(spark, sf)
    return _day_as_text(cutoff.payout_undated_rows(_payout(spark, sf), bank, bank, CFG))


@query
def bank_not_payout_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    payout = _payout(spark, sf)
    return cutoff.bank_not_payout_cutoff(
        payout, _bank(spark, sf), sample.payment(spark, sf), payout, CFG
    )


@query
def bank_not_payout_by_status(spark: SparkSession, sf: str) -> DataFrame:
    payout = _payout(spark, sf)
    return cutoff.bank_not_payout_by_status(
        payout, _bank(spark, sf), sample.payment(spark, sf), payout, CFG
    )


@query
def bank_not_payout_contractor(spark: SparkSession, sf: str) -> DataFrame:
    payout = _payout(spark, sf)
    return cutoff.bank_not_payout_contractor(
        payout, _bank(spark, sf), sample.payment(spark, sf), payout, CFG
    )


@query
def bank_not_payout_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cutoff.bank_not_payout_totals(_payout(spark, sf), _bank(spark, sf), CFG)


@query
def bank_unmatched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cutoff.unmatched_bank_rows(_payout(spark, sf), _bank(spark, sf), CFG)


@query
def bank_contractor_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cutoff.contractor_tagged_rows(
        _bank(spark, sf), sample.payment(spark, sf), CFG, contractor_only=True
    )


@query
def bank_tagged_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cutoff.contractor_tagged_rows(_bank(spark, sf), sample.payment(spark, sf), CFG)


# -- controls -----------------------------------------------------------------------------


@query
def control_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.payout_totals(_payout(spark, sf), CFG)


@query
def bank_control_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.bank_totals(_bank(spark, sf), CFG)


@query
def tie_out(spark: SparkSession, sf: str) -> DataFrame:
    return tie_out_proof(
        filters.payout_in_period(_payout(spark, sf), CFG),
        filters.bank_in_period(_bank(spark, sf), CFG),
        payout_key=CFG.payout.key,
        payout_amount=money(CFG.payout.cashout),
        bank_key=CFG.bank.key,
        bank_amount=money(CFG.bank.amount),
        bank_group=CFG.bank.provider,
    )


@query
def control_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded ledgers against the population of the system they were exported from."""
    population = sample.table(spark, sf, "orders").agg(
        F.count("*").alias("rows"), F.sum(F.expr(sample.PRICE)).cast(TOTAL).alias("usd")
    )
    payout = summaries.control_totals(_payout(spark, sf), {"usd": try_money(CFG.payout.cashout)})
    bank = summaries.control_totals(_bank(spark, sf), {"usd": try_money(CFG.bank.amount)})
    ledger = summaries.control_totals(sample.ar_ledger(spark, sf), {})
    actual = (
        long_metrics(payout.withColumnRenamed("cnt", "rows"), "full_payout")
        .unionByName(long_metrics(bank.withColumnRenamed("cnt", "rows"), "full_bank"))
        .unionByName(long_metrics(ledger.withColumnRenamed("cnt", "rows"), "ar_ledger"))
    )
    reported = (
        long_metrics(population, "full_payout")
        .unionByName(long_metrics(population, "full_bank"))
        .unionByName(long_metrics(population, "ar_ledger"))
    )
    return compare_controls(actual, reported)


@query
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.row_counts(
        {
            "ar_ledger": sample.ar_ledger(spark, sf),
            "clearing": sample.clearing(spark, sf),
            "full_bank": _bank(spark, sf),
            "full_payout": _payout(spark, sf),
            "payment": sample.payment(spark, sf),
        }
    )


# -- profiles -----------------------------------------------------------------------------


@query
def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    bank = filters.bank_in_period(_bank(spark, sf), CFG)
    return summaries.duplicates(bank.where(F.col(CFG.bank.key).isNotNull()), [CFG.bank.key])


@query
def payout_dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Payout ids of the period that occur more than once: the tie-out's precondition."""
    payout = filters.payout_in_period(_payout(spark, sf), CFG)
    return summaries.duplicates(payout.where(F.col(CFG.payout.key).isNotNull()), [CFG.payout.key])


@query
def dup_by_provider(spark: SparkSession, sf: str) -> DataFrame:
    bank = filters.bank_in_period(_bank(spark, sf), CFG)
    return summaries.duplicates_by(bank, [CFG.bank.key, CFG.bank.provider], CFG.bank.provider)


@query
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    return filters.with_null_key(_payout(spark, sf), CFG.payout.key)


@query
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Value counts of several columns in one frame: (column_name, value, cnt)."""
    picks = [
        (_bank(spark, sf), ["type", "platform_type", "direction"]),
        (sample.payment(spark, sf), ["settlement_currency", "purpose"]),
        (_payout(spark, sf), ["tms_is_reconciled"]),
    ]
    counted = [summaries.value_counts_of(df, columns) for df, columns in picks]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def month_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.month_histogram(_bank(spark, sf), CFG.bank.created_at)


@query
def drilldown(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.amount_by(
        _bank(spark, sf), ["direction", "receiver_id", "sender_id"], CFG.bank.amount, "sum_usd_amount"
    )


LOOKUP_KEYS = (46, 69, 1357)


@query
def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return filters.key_lookup(_bank(spark, sf), CFG.bank.key, LOOKUP_KEYS)


@query
def provider_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per normalised provider other than the flagged one."""
    rows = _payout(spark, sf).where(
        filters.provider_is_not(CFG.payout.provider, CFG.flagged_provider)
    )
    return rows.groupBy(normalised(CFG.payout.provider).alias("provider")).agg(
        F.count("*").alias("cnt")
    )


@query
def ledger_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ledger_pack(sample.ar_ledger(spark, sf))["pivot"]


@query
def ledger_months(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ledger_pack(sample.ar_ledger(spark, sf))["months"]


@query
def ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ledger_pack(sample.ar_ledger(spark, sf))["rows"]


@query
def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ledger_pack(sample.ar_ledger(spark, sf))["reversal_dates"]


@query
def period_sum(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.amount_by(sample.clearing(spark, sf), ["invoice_period"], "usd_amount")


@query
def first_n(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.first_rows(sample.ar_ledger(spark, sf), 100, ["unique_key"])


# -- filters ------------------------------------------------------------------------------


@query
def period_range(spark: SparkSession, sf: str) -> DataFrame:
    return _payout(spark, sf).where(in_period(CFG.payout.created_at, PERIOD))


@query
def period_year_month(spark: SparkSession, sf: str) -> DataFrame:
    return _payout(spark, sf).where(in_months(CFG.payout.created_at, 1998, (10, 11, 12)))


@query
def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _bank(spark, sf).where(filters.in_scope(CFG.scope))


@query
def year_prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    return sample.payment(spark, sf).where(year_prefix("created_at", CFG.contractor_years))


@query
def typed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    typed = sinks.typed_ledger(
        _payout(spark, sf), CFG.payout.created_at, [CFG.payout.cashout, CFG.payout.initial]
    )
    return _day_as_text(typed, "ledger_day")


# -- staging ------------------------------------------------------------------------------


def _same_line_ends(column: str) -> Column:
    return F.replace(F.col(column), F.lit("\r\n"), F.lit("\n")).alias(column)


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = csvfiles.read_strict(spark, exports.documents_csv(spark, sf))
    return docs.select("doc_id", _same_line_ends("text"), "lang", "source")


@query
def csv_small_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents out of many small files, by the reader that takes a whole file per task."""
    docs = csvfiles.read_report(spark, exports.small_documents_csv(spark, sf))
    return docs.select("doc_id", _same_line_ends("text"), "lang", "source")


@query
def csv_unquoted(spark: SparkSession, sf: str) -> DataFrame:
    return csvfiles.read_unquoted(spark, exports.quoted_names_csv(spark, sf))


@query
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Typed columns by inference, summed up per status."""
    orders = csvfiles.read_inferred(spark, exports.orders_csv(spark, sf))
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("cnt"),
        F.sum("o_custkey").cast("bigint").alias("sum_custkey"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast(TOTAL).alias("sum_price"),
    )


@query
def empty_to_null(spark: SparkSession, sf: str) -> DataFrame:
    """Blank instead of NULL ids are put right before the scope is tested."""
    ids = ["receiver_id", "sender_id", "return_id"]
    blanks = _bank(spark, sf).withColumns({c: F.coalesce(c, F.lit("")) for c in ids})
    return summaries.value_counts(
        csvfiles.empty_to_null(blanks).where(filters.in_scope(CFG.scope)), CFG.bank.provider
    )


@query
def json_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger keys out of JSON arrays that the loaded ledger lacks."""
    arrays = sample.ar_ledger(spark, sf).select(F.to_json(F.array("unique_key")).alias("keys_json"))
    return quality.missing_rows(
        csvfiles.json_keys(arrays, "keys_json", "unique_key"),
        "unique_key",
        sample.ar_loaded(spark, sf),
        "unique_key",
    )


def _reject_cap(spark: SparkSession, sf: str) -> int:
    """A twentieth of the exported records may be malformed."""
    return sample.table(spark, sf, "orders").count() // 20


@query
def load_with_reject_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The good rows of a damaged export, as long as its rejects stay below the cap."""
    return csvfiles.read_tolerant(spark, exports.damaged_csv(spark, sf), _reject_cap(spark, sf))


@query
def load_unquoted_with_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The good lines of the same export when quotes mean nothing."""
    path = exports.damaged_csv(spark, sf)
    return csvfiles.read_tolerant(spark, path, _reject_cap(spark, sf), quoted=False)


@query
def reject_summary(spark: SparkSession, sf: str) -> DataFrame:
    return csvfiles.reject_summary(spark, exports.damaged_csv(spark, sf), _reject_cap(spark, sf))


@query
def rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = csvfiles.split_rejects(spark, exports.damaged_csv(spark, sf))
    return rejected.select("raw", "fields", "expected")


@query
def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    """Stages the payout ledger as Parquet and reads one period of it back."""
    stored = sinks.replace_table(_payout(spark, sf), scratch_dir(spark, "staged_payout"))
    return stored.where(in_period(CFG.payout.created_at, PERIOD))


@query
def typed_ledger_months(spark: SparkSession, sf: str) -> DataFrame:
    """Stores the typed ledger by month and sums up the months of the period from it."""
    typed = sinks.typed_ledger(_payout(spark, sf), CFG.payout.created_at, [CFG.payout.cashout])
    stored = sinks.write_typed_ledger(typed, scratch_dir(spark, "typed_payout"))
    months = stored.where(F.col("ledger_month").cast("string").isin("1998-10", "1998-11", "1998-12"))
    return months.groupBy(F.col("ledger_month").cast("string").alias("ledger_month")).agg(
        F.count("*").alias("cnt"),
        F.sum(f"{CFG.payout.cashout}_typed").cast(TOTAL).alias("sum_total_cashout_usd"),
    )


@query
def report_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The cut-off report written as CSV and read back as text."""
    path = scratch_dir(spark, "report")
    sinks.write_report(payout_not_bank_cutoff(spark, sf), path)
    return csvfiles.read_report(spark, path)


@query
def table_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Create-table-as-select from a CSV export."""
    orders = csvfiles.read_quoted(spark, exports.orders_csv(spark, sf))
    return sinks.create_table(orders, "ledgerproof_orders", scratch_dir(spark, "orders_table"))


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, line): every row of the tables as one text."""
    lines = [
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns)).alias("line"),
        )
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, lines)


@query
def load_all(spark: SparkSession, sf: str) -> DataFrame:
    """The load job over several exports, with all rows as stored, rejects as well."""
    jobs = [
        load.LoadJob("documents", exports.documents_csv(spark, sf), "strict"),
        load.LoadJob("orders", exports.orders_csv(spark, sf), "quoted"),
        load.LoadJob("customers", exports.quoted_names_csv(spark, sf), "unquoted"),
        load.LoadJob("damaged", exports.damaged_csv(spark, sf), "tolerant", _reject_cap(spark, sf)),
    ]
    stored = load.load_all(spark, jobs, scratch_dir(spark, "load_all"))
    stored["documents"] = stored["documents"].withColumn("text", F.md5(_same_line_ends("text")))
    stored["damaged_rejects"] = stored["damaged_rejects"].select("raw", "fields", "expected")
    return _contents(stored)


@query
def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What the same load counted while it wrote, next to the lines of its files."""
    jobs = [
        load.LoadJob("documents", exports.documents_csv(spark, sf), "strict"),
        load.LoadJob("orders", exports.orders_csv(spark, sf), "quoted"),
        load.LoadJob("customers", exports.quoted_names_csv(spark, sf), "unquoted"),
        load.LoadJob("damaged", exports.damaged_csv(spark, sf), "tolerant", _reject_cap(spark, sf)),
    ]
    return load.load_with_metrics(spark, jobs, scratch_dir(spark, "load_metrics"))[1]


@query
def load_in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """An export appended in batches; the load is done again, and one batch is written twice."""
    path, target = exports.orders_csv(spark, sf), scratch_dir(spark, "batches")
    load.load_in_batches(spark, path, target, "quoted", files_per_batch=2)
    again = load.load_in_batches(spark, path, target, "quoted", files_per_batch=2)
    table = spark.read.option("recursiveFileLookup", "false").parquet(target)
    first = min(sinks.committed_batches(spark, target))
    batch = table.where(F.col(sinks.BATCH).cast("string") == first).drop(sinks.BATCH)
    # The rows are read from the folder that is replaced, so they are stored elsewhere before.
    copy = sinks.replace_table(batch, scratch_dir(spark, "one_batch"))
    stored = sinks.append_batch(copy, target, first)
    return stored.drop(sinks.BATCH).withColumn("added_again", F.lit(len(again)))


@query
def switch_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table whose second version takes the place of its first."""
    base = scratch_dir(spark, "versions")
    name = f"ledgerproof_{base[-12:]}"
    sinks.switch_table(_payout(spark, sf).limit(10), name, base)
    table = sinks.switch_table(_payout(spark, sf), name, base)
    return table.where(in_period(CFG.payout.created_at, PERIOD))


@query
def run_all_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The three main reports over ledgers that are stored in buckets of the reconciliation id."""
    base = scratch_dir(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payout, bank = (
        sinks.create_bucketed(df, f"ledgerproof_{name}_{base[-12:]}", key, buckets, f"{base}/{name}")
        for name, df, key in (("payout", _payout(spark, sf), CFG.payout.key), ("bank", _bank(spark, sf), CFG.bank.key))
    )
    written = reports.run_all(
        payout, bank, sample.payment(spark, sf), payout, bank, CFG, scratch_dir(spark, "reports")
    )
    return _contents({name: csvfiles.read_report(spark, path) for name, path in written.items()})


@query
def run_all(spark: SparkSession, sf: str) -> DataFrame:
    """The three main reports, written as CSV one after the other, with all their rows."""
    payout, bank = _payout(spark, sf), _bank(spark, sf)
    written = reports.run_all(
        payout, bank, sample.payment(spark, sf), payout, bank, CFG, scratch_dir(spark, "reports")
    )
    return _contents({name: csvfiles.read_report(spark, path) for name, path in written.items()})


@query
def sql_report(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.run_sql(
        spark,
        sinks.load_sql(SQL_DIR / "period_totals.sql"),
        {"payout": _payout(spark, sf)},
        {"start": PERIOD.start, "end": PERIOD.end},
    )


@query
def sql_script(spark: SparkSession, sf: str) -> DataFrame:
    """All statements of one SQL file: (statement, label, cnt)."""
    found = sinks.run_script(
        spark,
        sinks.load_sql(SQL_DIR / "completeness.sql"),
        {"payout": _payout(spark, sf), "bank": _bank(spark, sf)},
        {"start": PERIOD.start, "end": PERIOD.end},
    )
    named = [df.select(F.lit(i).alias("statement"), "label", "cnt") for i, df in enumerate(found, start=1)]
    return functools.reduce(DataFrame.unionByName, named)


# -- completeness -------------------------------------------------------------------------


@query
def missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_rows(
        sample.ar_ledger(spark, sf),
        "unique_key",
        sample.ar_loaded(spark, sf),
        "unique_key",
    )


@query
def first_missing(spark: SparkSession, sf: str) -> DataFrame:
    """The first findings only, in key order."""
    return summaries.first_rows(missing_rows(spark, sf).select("unique_key"), 20, ["unique_key"])


@query
def missing_csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the CSV export; the record number depends on the files, so it is left out."""
    return quality.missing_records(
        spark,
        exports.ar_ledger_csv(spark, sf),
        "unique_key",
        sample.ar_loaded(spark, sf),
        "unique_key",
    ).drop("source_line_num")


@query
def line_vs_record_count(spark: SparkSession, sf: str) -> DataFrame:
    path = exports.documents_csv(spark, sf)
    return quality.line_vs_record_count(spark, path, csvfiles.read_quoted(spark, path))


@query
def record_shape(spark: SparkSession, sf: str) -> DataFrame:
    return quality.record_shape(spark, exports.documents_csv(spark, sf))


@query
def multiline_records(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.multiline_records(spark, exports.documents_csv(spark, sf), key="doc_id")
    return report.drop("file", "record_num", "start_line", "end_line")


@query
def multiline_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.multiline_totals(spark, exports.documents_csv(spark, sf))


@query
def bad_structure(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.bad_structure(spark, exports.damaged_csv(spark, sf))
    return report.select("actual_fields", "expected_fields", "preview")


@query
def record_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Records and lines behind the headers, and what is wrong with any position."""
    report = quality.record_positions(spark, exports.documents_csv(spark, sf))
    return report.agg(
        F.sum(F.col("records") - 1).cast("bigint").alias("records"),
        F.sum(F.col("lines") - 1).cast("bigint").alias("lines"),
        F.sum("faults").cast("bigint").alias("faults"),
        F.count_if((F.col("last_record") != F.col("records") - 1) | (F.col("last_line") != F.col("lines"))).alias(
            "wrong_ends"
        ),
    )


@query
def quote_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and records behind the headers, and files with a quote left open."""
    report = quality.quote_balance(spark, exports.documents_csv(spark, sf))
    return report.agg(
        F.sum(F.col("records") - 1).cast("bigint").alias("records"),
        F.sum(F.col("lines") - 1).cast("bigint").alias("lines"),
        F.count_if(F.col("quotes") % 2 == 1).alias("odd_files"),
        F.count("open_record").alias("open_records"),
    )


@query
def terminator_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Line ends over all files of the export, header lines aside, and the files' verdicts."""
    report = quality.terminator_profile(spark, exports.mixed_terminators_csv(spark, sf))
    return report.agg(
        F.sum("crlf_lines").cast("bigint").alias("crlf_lines"),
        F.sum(F.col("lf_lines") - 1).cast("bigint").alias("lf_lines"),
        F.min("terminator").alias("first_verdict"),
        F.max("terminator").alias("last_verdict"),
    )
