"""Load jobs and reports of a run, for spark-submit.

    spark-submit --py-files ledgerproof.zip ledgerproof/job.py run.json

The configuration file::

    {"staged": "/data/staged",            where tables go; they may be there already
     "output": "/data/reports",
     "load": [{"table": "payout", "path": "raw/payout.csv", "mode": "tolerant", "reject_cap": 100},
              {"table": "bank", "path": "raw/bank.csv"}, ...],
     "tables": {"payout": "payout", "bank": "bank", "payment": "payment",
                "full_payout": "full_payout", "full_bank": "full_bank"},
     "period": {"start": "2026-01-01", "end": "2026-04-01"},      or {"year": 2026, "quarter": 1}
     "flagged_provider": "prov_0", "contractor_years": ["2025", "2026"],
     "batches": [{"table": "orders", "path": "raw/orders", "files_per_batch": 10}],
     "ledger": {"table": "ar", "path": "raw/ar.csv", "key": "unique_key"},
     "structure": {"ar": "raw/ar.csv"},
     "buckets": 2000}

Every entry but ``staged`` and ``output`` may be left out. ``load`` replaces tables and leaves its
counts as the report ``load_metrics``; ``batches`` appends what a table lacks; ``ledger`` is a strict
load that stops when rows and lines differ, followed by the ledger's reports; ``structure`` lists
the records of files that are malformed or span lines. ``tables`` asks for the reconciliation
reports, over ledgers dealt out once in ``buckets`` of their ids if that is given.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession

from ledgerproof.config import Period, ReconConfig
from ledgerproof.plans import load, reports
from ledgerproof.session import BASE_CONF
from ledgerproof.sources import quality, sinks

TABLES = ("payout", "bank", "payment", "full_payout", "full_bank")
STEPS = ("batches", "ledger", "structure", "buckets")
SETTINGS = ("flagged_provider", "flagged_label", "unflagged_label", "contractor_purpose")


def read_config(spark: SparkSession, path: str) -> dict:
    """The configuration from any store that Spark reads."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"{path} is empty")
    config = json.loads(text[0])
    known = {"staged", "output", "load", "tables", "period", "contractor_years", *STEPS, *SETTINGS}
    if unknown := set(config) - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return config


def recon_config(config: dict) -> ReconConfig:
    period = config["period"]
    span = Period.quarter(**period) if "quarter" in period else Period(**period)
    more = {k: config[k] for k in SETTINGS if k in config}
    return ReconConfig(period=span, contractor_years=tuple(config.get("contractor_years", ())), **more)


def _check_structure(spark: SparkSession, files: dict[str, str], output: str) -> dict[str, str]:
    """Malformed and multi-line records of each export; the readers share its split table."""
    written = {}
    for name, path in files.items():
        for kind, report in (("bad", quality.bad_structure), ("multiline", quality.multiline_records)):
            written[f"{kind}_{name}"] = f"{output}/{kind}_{name}"
            # As many rows as there are findings, so no single file.
            report(spark, path).write.mode("overwrite").options(header=True, escape='"').csv(written[f"{kind}_{name}"])
    return written


def _load_ledger(spark: SparkSession, ledger: dict[str, str], staged: str, output: str) -> dict[str, str]:
    """The checked load of a ledger and its reports; what it lacks is left in ``ledger_check``."""
    stored = load.load_validated(
        spark, ledger["path"], f"{staged}/{ledger['table']}", ledger["key"], f"{output}/ledger_check"
    )
    written = {}
    for name, report in reports.ledger_pack(stored).items():
        written[f"ledger_{name}"] = f"{output}/ledger_{name}"
        sinks.write_report(report, written[f"ledger_{name}"])
    return written


def _ledgers(spark: SparkSession, config: dict, cfg: ReconConfig) -> list[DataFrame]:
    """The staged tables of the reports, the matched ones in buckets of their ids if asked for."""
    staged, buckets = config["staged"].rstrip("/"), config.get("buckets")
    keys = {"payout": cfg.payout.key, "full_payout": cfg.payout.key, "bank": cfg.bank.key, "full_bank": cfg.bank.key}
    frames: dict[str, DataFrame] = {}
    for name in TABLES:
        table = config["tables"][name]
        if table not in frames:
            frames[table] = spark.read.parquet(f"{staged}/{table}")
            if buckets and name in keys:
                place = f"{staged}/{table}_by_id"
                frames[table] = sinks.create_bucketed(frames[table], f"{table}_by_id", keys[name], buckets, place)
    return [frames[config["tables"][name]] for name in TABLES]


def run(spark: SparkSession, config: dict) -> dict[str, str]:
    """Stages and checks what the configuration lists, then writes its reports; returns the reports' folders.

    The counts of the loads go to ``load_metrics`` below the output folder.
    """
    staged, output = config["staged"].rstrip("/"), config["output"].rstrip("/")
    written = {}
    if jobs := [load.LoadJob(**job) for job in config.get("load", [])]:
        # Beside the reports, whose list is theirs alone.
        metrics = load.load_with_metrics(spark, jobs, staged)[1]
        sinks.write_report(metrics, f"{output}/load_metrics", ["table_name"])
    for batch in config.get("batches", []):
        options = {k: v for k, v in batch.items() if k not in ("table", "path")}
        load.load_in_batches(spark, batch["path"], f"{staged}/{batch['table']}", **options)
    written |= _check_structure(spark, config.get("structure", {}), output)
    if "ledger" in config:
        written |= _load_ledger(spark, config["ledger"], staged, output)
    if "tables" in config:
        cfg = recon_config(config)
        written |= reports.run_all(*_ledgers(spark, config, cfg), cfg, output)
    return written


def main(arguments: list[str]) -> None:
    builder = SparkSession.builder.appName("ledgerproof")
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for name, path in run(spark, read_config(spark, arguments[0])).items():
        print(f"{name}: {path}")
    spark.stop()


if __name__ == "__main__":
    if len(sys.argv) != 2:
        sys.exit(__doc__)
    main(sys.argv[1:])
