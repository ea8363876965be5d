"""The submitted job from raw files to reports."""

import json

import pytest

from ledgerproof import job, sample
from ledgerproof.sources.csvfiles import read_report

SF = "/root/testdata/sf0.001"


def test_job_from_files_to_reports(spark, tmp_path):
    frames = {
        "full_payout": sample.full_payout(spark, SF),
        "full_bank": sample.full_bank(spark, SF),
        "payment": sample.payment(spark, SF),
    }
    for name, df in frames.items():
        df.write.options(header=True, quote='"', escape='"').csv(str(tmp_path / "raw" / name))
    config = {
        "staged": str(tmp_path / "staged"),
        "output": str(tmp_path / "reports"),
        "load": [{"table": name, "path": str(tmp_path / "raw" / name)} for name in frames],
        "tables": dict(zip(job.TABLES, ["full_payout", "full_bank", "payment", "full_payout", "full_bank"])),
        "period": {"year": 1998, "quarter": 4},
        "contractor_years": ["1998", "1999"],
    }
    file = tmp_path / "run.json"
    file.write_text(json.dumps(config))
    read = job.read_config(spark, str(file))
    assert read == config and job.recon_config(read) == sample.CONFIG
    written = job.run(spark, read)
    assert list(written) == ["join_diff", "payout_not_bank", "bank_not_payout"]
    from ledgerproof.plans.queries import QUERIES

    direct = QUERIES["join_diff"](spark, SF).first()
    assert [str(v) for v in direct] == list(read_report(spark, written["join_diff"]).first())


def test_unknown_settings_are_refused(spark, tmp_path):
    file = tmp_path / "run.json"
    file.write_text('{"staged": "x", "outptu": "y"}')
    with pytest.raises(ValueError, match="outptu"):
        job.read_config(spark, str(file))
    assert job.recon_config({"period": {"start": "2026-01-01", "end": "2026-02-01"}}).period.end == "2026-02-01"


def test_job_with_all_its_steps(spark, tmp_path):
    """Batches, a checked ledger with its reports, structure reports, and ledgers in buckets."""
    frames = {
        "full_payout": sample.full_payout(spark, SF),
        "full_bank": sample.full_bank(spark, SF),
        "payment": sample.payment(spark, SF),
        "ar": sample.ar_ledger(spark, SF),
    }
    raw = lambda name: str(tmp_path / "raw" / name)
    for name, df in frames.items():
        df.write.options(header=True, quote='"', escape='"').csv(raw(name))
    config = {
        "staged": str(tmp_path / "staged"),
        "output": str(tmp_path / "reports"),
        "load": [{"table": name, "path": raw(name)} for name in ("full_payout", "full_bank")],
        "batches": [{"table": "payment", "path": raw("payment"), "mode": "quoted"}],
        "ledger": {"table": "ar", "path": raw("ar"), "key": "unique_key"},
        "structure": {"ar": raw("ar")},
        "tables": dict(zip(job.TABLES, ["full_payout", "full_bank", "payment", "full_payout", "full_bank"])),
        "period": {"year": 1998, "quarter": 4},
        "contractor_years": ["1998", "1999"],
        "buckets": 3,
    }
    file = tmp_path / "run.json"
    file.write_text(json.dumps(config))
    try:
        written = job.run(spark, job.read_config(spark, str(file)))
    finally:
        for name in ("full_payout_by_id", "full_bank_by_id"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    packs = ["ledger_pivot", "ledger_months", "ledger_rows", "ledger_reversal_dates"]
    assert list(written) == ["bad_ar", "multiline_ar", *packs, "join_diff", "payout_not_bank", "bank_not_payout"]
    from ledgerproof.plans.queries import QUERIES

    for name in ("join_diff", "ledger_pivot"):
        direct = {tuple(None if v is None else str(v) for v in r) for r in QUERIES[name](spark, SF).collect()}
        assert {tuple(r) for r in read_report(spark, written[name]).collect()} == direct
    assert read_report(spark, str(tmp_path / "reports" / "load_metrics")).where("matches = 'true'").count() == 2
