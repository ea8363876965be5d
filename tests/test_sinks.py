import csv
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from ledgerproof import sample
from ledgerproof.config import Period
from ledgerproof.functions import in_period
from ledgerproof.plans import load, reports
from ledgerproof.session import cluster_conf, setting_in_bytes
from ledgerproof.sources import csvfiles, sinks

SF = "/root/testdata/sf0.001"


def test_report_is_one_headed_csv_file(spark, tmp_path):
    df = spark.createDataFrame([(2025, None, 'a "b", c', 3)], "y int, m int, flag string, cnt bigint")
    sinks.write_report(df, str(tmp_path / "r"))
    sinks.write_report(df, str(tmp_path / "r"))  # a second run replaces the first
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1
    with open(files[0], newline="") as f:
        assert list(csv.reader(f)) == [["y", "m", "flag", "cnt"], ["2025", "", 'a "b", c', "3"]]


def test_run_all_writes_the_three_reports(spark, tmp_path):
    payout, bank = sample.full_payout(spark, SF), sample.full_bank(spark, SF)
    written = reports.run_all(
        payout, bank, sample.payment(spark, SF), payout, bank, sample.CONFIG, str(tmp_path)
    )
    assert list(written) == ["join_diff", "payout_not_bank", "bank_not_payout"]
    heads = {n: next(Path(p).glob("*.csv")).read_text().splitlines()[0] for n, p in written.items()}
    assert heads["join_diff"] == "cnt,sum_total_cashout_usd,sum_tms_usd_amount,sum_diff_usd"


def test_monthly_ledger_opens_only_its_months(spark, tmp_path):
    typed = sinks.typed_ledger(
        sample.full_payout(spark, SF), "withdrawal_created_at", ["total_cashout_usd"]
    )
    stored = sinks.write_typed_ledger(typed, str(tmp_path / "typed"))
    assert stored.count() == typed.count()
    plan = stored.where("ledger_month = '1998-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ledger_month" in plan


def test_create_table_replaces_the_old_one(spark, tmp_path):
    try:
        for i in range(2):
            df = spark.createDataFrame([("a",)], "c string")
            table = sinks.create_table(df, "staged_probe", str(tmp_path / f"t{i}"))
        assert table.count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS staged_probe")


def test_sql_file_with_parameters(spark):
    df = sinks.run_sql(
        spark,
        "SELECT count(*) AS n FROM {t} WHERE c = :c",
        {"t": spark.createDataFrame([("a",), ("b",)], "c string")},
        {"c": "a"},
    )
    assert df.first().n == 1


def test_database_settings_come_from_the_environment():
    with pytest.raises(ValueError, match="LEDGER_DB_PASSWORD"):
        sinks.jdbc_options("t", "id", "0", "9", 4, {"LEDGER_DB_URL": "jdbc:x", "LEDGER_DB_USER": "u"})
    env = {"LEDGER_DB_URL": "jdbc:x", "LEDGER_DB_USER": "u", "LEDGER_DB_PASSWORD": "p"}
    options = sinks.jdbc_options("t", "id", "0", "9", 4, env)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"


def test_load_job_stages_every_table_in_order(spark, tmp_path):
    raw, staged = tmp_path / "raw", tmp_path / "staged"
    raw.mkdir()
    (raw / "a.csv").write_text('Key ID,when\nk1,"1998-10-02, noon"\nk2,1999-01-01\n')
    (raw / "b.csv").write_text("k,v\n1,2\n3\n4,5\n")
    (raw / "c.csv").write_text('k,v,w\n1,"x,y"\n')
    jobs = [
        load.LoadJob("a", str(raw / "a.csv"), "strict"),
        load.LoadJob("b", str(raw / "b.csv"), "tolerant", reject_cap=1),
        load.LoadJob("c", str(raw / "c.csv"), "unquoted"),
    ]
    tables = load.load_all(spark, jobs, str(staged))
    assert [(name, df.count()) for name, df in tables.items()] == [
        ("a", 2), ("b_rejects", 1), ("b", 2), ("c", 1)
    ]
    assert tuple(tables["b_rejects"].select("record_num", "start_line", "raw", "fields", "expected").first()) == (
        2, 3, "3", 1, 2
    )
    with pytest.raises(csvfiles.RejectedRows, match="more than 0 malformed records"):
        load.load_all(spark, [load.LoadJob("b", str(raw / "b.csv"), "tolerant", reject_cap=0)], str(staged))
    for wrong in (dict(mode="tolerant"), dict(mode="strict", reject_cap=3), dict(mode="unheard of")):
        with pytest.raises(ValueError):
            load.LoadJob("b", "b.csv", **wrong)
    a = spark.read.parquet(str(staged / "a"))
    assert a.columns == ["Key_ID", "when"]
    assert a.where(in_period("when", Period("1998-10-01", "1999-01-01"))).count() == 1
    with pytest.raises(PySparkException, match="malformed record 2, lines 3-3 .* 1 fields instead of 2: 3 |"):
        load.load_all(spark, [load.LoadJob("b", str(raw / "b.csv"), "strict")], str(staged))


def test_validated_load_stops_and_leaves_the_missing_rows(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text('unique_key,v\nA,1\nB,"2\n2"\nC,3\n')
    target = str(tmp_path / "ledger")
    with pytest.raises(load.LoadMismatch, match="expected 4 lines, loaded 3 rows, missing 0"):
        load.load_validated(spark, str(path), target, "unique_key", str(tmp_path / "out1"))
    assert spark.read.parquet(target).count() == 3
    path.write_text("unique_key,v\nA,1\nB,2\n")
    assert load.load_validated(spark, str(path), target, "unique_key", str(tmp_path / "out2")).count() == 2
    lost = spark.createDataFrame([("A", "1")], "unique_key string, v string")
    with pytest.raises(load.LoadMismatch, match="expected 2 lines, loaded 1 rows, missing 1"):
        load.check_loaded(spark, str(path), lost, "unique_key", str(tmp_path / "out3"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out3" / "missing_rows"))
    assert [tuple(r) for r in rows.collect()] == [("3", "B", "2")]
    keys = spark.read.text(str(tmp_path / "out3" / "missing_keys"))
    assert [r.value for r in keys.collect()] == ["B"]


def test_cluster_settings_grow_with_the_data():
    small, large = cluster_conf(10**9, 16), cluster_conf(5 * 10**12, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 32
    assert int(large["spark.sql.shuffle.partitions"]) > 18_000


def test_size_settings():
    values = ("300", "128MB", "134217728b", "1g", "64k")
    assert [setting_in_bytes(v) for v in values] == [300, 128 << 20, 128 << 20, 1 << 30, 64 << 10]
