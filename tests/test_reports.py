"""Reports on ledgers full of duplicates, against plain SQL joins in DuckDB."""

import random
import re

import duckdb
import pytest
from oracle_check import as_bag
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerproof import sample
from ledgerproof.functions import money
from ledgerproof.operators import cutoff, filters, perkey, summaries
from ledgerproof.operators.controls import tie_out
from ledgerproof.plans import reports
from ledgerproof.plans.oracles import ORACLES

CFG = sample.ReconConfig(
    period=sample.PERIOD, contractor_years=("1998", "1999")
)
DATES = ["1998-09-30", "1998-10-01", "1998-11-15T01:00:00Z", "1998-12-31", "1999-01-01", "1999-02-02", "bad", None]


def ledgers(seed: int):
    rng = random.Random(seed)

    def key(*own):
        return rng.choice([None, "hot", "hot", "hot", *(f"r{i}" for i in range(25)), *own])

    def amount():
        return rng.choice(["10.00", "10.00", "12.50", "7.25", "-3.10", None])

    payout = [
        (key("p0", "p0", "p1"), rng.choice(DATES), amount(), amount(), rng.choice([" Prov_0 ", "prov_1", None]),
         rng.choice(["card", "wire", None]), "x")
        for _ in range(140)
    ]
    bank = [
        (key(), rng.choice([None, "w0", "w0", *(f"w{i}" for i in range(12))]),
         rng.choice(["prov_0", "prov_1", None]), amount(), rng.choice(DATES),
         rng.choice(["OUTGOING"] * 6 + ["INCOMING", None]), rng.choice(["Withdrawal"] * 6 + ["Fee"]),
         rng.choice(["Sent"] * 6 + ["Returned", None]), rng.choice([None] * 9 + ["r"]), None, None)
        for _ in range(160)
    ]
    payment = [
        (rng.choice([None, *(f"w{i}" for i in range(10))]),
         rng.choice(["contractor_payment"] * 4 + ["refund"]), rng.choice(["1998-01-01", "1999-05-05", "1997-01-01"]),
         rng.choice(["paid", "pending", "cancelled", None]), "USD")
        for _ in range(40)
    ]
    return {"full_payout": payout, "full_bank": bank, "payment": payment}


COLUMNS = {
    "full_payout": list(sample.FULL_PAYOUT),
    "full_bank": list(sample.FULL_BANK),
    "payment": list(sample.PAYMENT),
}


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = ledgers(request.param)
    con = duckdb.connect()
    frames = {}
    for name, data in rows.items():
        cols = COLUMNS[name]
        con.execute(f"CREATE TABLE t_{name} ({', '.join(c + ' VARCHAR' for c in cols)})")
        con.executemany(f"INSERT INTO t_{name} VALUES ({', '.join('?' * len(cols))})", data)
        frames[name] = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)).repartition(3)
    return frames, con


def sql_on_tables(name: str) -> str:
    sql = ORACLES[name]
    for table, text in sample.ledger_sql().items():
        sql = sql.replace(f"{table} AS ({text})", f"{table} AS (SELECT * FROM t_{table})")
    return sql


REPORTS = {
    "join_diff": lambda p, b, a: reports.join_diff(p, b, CFG),
    "join_diff_by_method": lambda p, b, a: reports.join_diff_by_method(p, b, CFG),
    "join_diff_no_preagg": lambda p, b, a: reports.join_diff_by_method(p, b, CFG, sum_bank_first=False),
    "payout_not_bank_cutoff": lambda p, b, a: cutoff.payout_not_bank_cutoff(p, b, b, CFG),
    "payout_not_bank_cutoff_earliest": lambda p, b, a: cutoff.payout_not_bank_cutoff(p, b, b, CFG, earliest=True),
    "payout_not_bank_cutoff_scoped": lambda p, b, a: cutoff.payout_not_bank_cutoff_scoped(p, b, b, CFG),
    "payout_not_bank_totals": lambda p, b, a: cutoff.payout_not_bank_totals(p, b, CFG),
    "payout_unmatched_rows": lambda p, b, a: cutoff.unmatched_payout_rows(p, b, CFG),
    "payout_unresolved_detail": lambda p, b, a: cutoff.payout_unresolved_rows(p, b, b, CFG),
    "bank_not_payout_cutoff": lambda p, b, a: cutoff.bank_not_payout_cutoff(p, b, a, p, CFG),
    "bank_not_payout_by_status": lambda p, b, a: cutoff.bank_not_payout_by_status(p, b, a, p, CFG),
    "bank_not_payout_contractor": lambda p, b, a: cutoff.bank_not_payout_contractor(p, b, a, p, CFG),
    "bank_not_payout_totals": lambda p, b, a: cutoff.bank_not_payout_totals(p, b, CFG),
    "bank_unmatched_rows": lambda p, b, a: cutoff.unmatched_bank_rows(p, b, CFG),
    "bank_contractor_rows": lambda p, b, a: cutoff.contractor_tagged_rows(b, a, CFG, contractor_only=True),
    "bank_tagged_rows": lambda p, b, a: cutoff.contractor_tagged_rows(b, a, CFG),
    "control_totals": lambda p, b, a: reports.payout_totals(p, CFG),
    "bank_control_totals": lambda p, b, a: reports.bank_totals(b, CFG),
    "tie_out": lambda p, b, a: tie_out(
        filters.payout_in_period(p, CFG),
        filters.bank_in_period(b, CFG),
        payout_key=CFG.payout.key,
        payout_amount=money(CFG.payout.cashout),
        bank_key=CFG.bank.key,
        bank_amount=money(CFG.bank.amount),
        bank_group=CFG.bank.provider,
    ),
    "dup_by_provider": lambda p, b, a: summaries.duplicates_by(
        filters.bank_in_period(b, CFG), [CFG.bank.key, CFG.bank.provider], CFG.bank.provider
    ),
}


@pytest.mark.parametrize("name", REPORTS)
def test_report_equals_plain_sql(case, name):
    frames, con = case
    got = REPORTS[name](frames["full_payout"], frames["full_bank"], frames["payment"])
    if "withdrawal_date" in got.columns:
        got = got.withColumn("withdrawal_date", F.col("withdrawal_date").cast("string"))
    result = con.execute(sql_on_tables(name))
    want = as_bag([d[0] for d in result.description], result.fetchall())
    assert as_bag(got.columns, got.collect()) == want
    assert sum(want[1].values()) > 0


def test_tie_out_leaves_nothing_over(case):
    frames, _ = case
    rows = REPORTS["tie_out"](frames["full_payout"], frames["full_bank"], frames["payment"]).collect()
    assert [(r.residual_rows, r.residual_usd) for r in rows] == [(0, 0), (0, 0)]
    assert all(r.matched_rows and r.unmatched_rows for r in rows)


def lossy(seed):
    """A matcher that drops some of what it should keep."""
    return lambda rows, key, others, other: perkey.with_keys(rows, key, others, other).where(f"hash({key}, {seed}) % 3 <> 0")


def test_tie_out_finds_lost_and_doubled_rows(case):
    frames, _ = case
    p = filters.payout_in_period(frames["full_payout"], CFG)
    b = filters.bank_in_period(frames["full_bank"], CFG)
    options = dict(
        payout_key=CFG.payout.key, payout_amount=money(CFG.payout.cashout), bank_key=CFG.bank.key,
        bank_amount=money(CFG.bank.amount), bank_group=CFG.bank.provider,
    )
    sound = {r.side: r for r in tie_out(p, b, **options).collect()}
    lost = {r.side: r for r in tie_out(p, b, match=lossy(1), **options).collect()}
    for side in ("payout", "bank"):
        missing = sound[side].matched_rows - lost[side].matched_rows
        assert lost[side].residual_rows == missing > 0
        assert lost[side].total_rows == sound[side].total_rows
        assert lost[side].residual_usd == sound[side].matched_usd - lost[side].matched_usd
    doubled = tie_out(p, b, differ=lambda *a: perkey.without_keys(*a).union(perkey.without_keys(*a)), **options)
    assert all(r.residual_rows == -r.unmatched_rows / 2 < 0 for r in doubled.collect())


def test_tie_out_counts_repeated_keys(case):
    frames, _ = case
    row = REPORTS["tie_out"](frames["full_payout"], frames["full_bank"], frames["payment"]).where("side = 'payout'").first()
    period = filters.payout_in_period(frames["full_payout"], CFG)
    repeated = summaries.duplicates(period.where(F.col(CFG.payout.key).isNotNull()), [CFG.payout.key])
    assert row.duplicate_keys == repeated.count() > 0


def test_undated_rows_say_how_often_they_repeat(case):
    """Repeating each row by its bank_rows gives the row count of the plain left join."""
    frames, con = case
    p, b = frames["full_payout"], frames["full_bank"]
    got = cutoff.payout_undated_rows(p, b, b, CFG).collect()
    plain = sql_on_tables("payout_unmatched_rows")
    ctes = plain[: plain.rindex("\nSELECT")]
    want = con.execute(
        f"{ctes}, full_side AS (SELECT * , CASE WHEN regexp_matches(left(created_at, 10), '^[0-9-]{{10}}$') "
        "THEN TRY_CAST(left(created_at, 10) AS DATE) END AS fd FROM full_bank) "
        "SELECT count(*) FROM p_only x LEFT JOIN full_side f ON x.tms_reconciliation_id = f.reconciliation_id "
        "WHERE f.fd IS NULL"
    ).fetchone()[0]
    assert sum(max(r.bank_rows, 1) for r in got) == want


def test_empty_ledgers(spark, case):
    frames, _ = case
    empty = frames["full_payout"].limit(0)
    row = reports.join_diff(empty, frames["full_bank"], CFG).first()
    assert (row.cnt, row.sum_diff_usd) == (0, None)


@pytest.mark.parametrize("sum_bank_first", [True, False])
def test_bad_amounts_outside_the_period_do_not_stop_strict_reports(spark, case, sum_bank_first):
    frames, _ = case
    p, b = frames["full_payout"], frames["full_bank"]
    late = {"withdrawal_created_at": "2001-01-01", "total_cashout_usd": "no amount"}
    bad_p = p.limit(20).withColumns({c: F.lit(v) for c, v in late.items()})
    bad_b = b.limit(20).withColumns({"created_at": F.lit("2001-01-01"), "usd_amount": F.lit("no amount")})
    report = reports.join_diff_by_method(p.union(bad_p), b.union(bad_b), CFG, sum_bank_first=sum_bank_first)
    same = reports.join_diff_by_method(p, b, CFG, sum_bank_first=sum_bank_first)
    assert sorted(map(str, report.collect())) == sorted(map(str, same.collect()))


@pytest.mark.parametrize(
    "report",
    [
        lambda p, b: reports.join_diff(p, b, CFG),
        lambda p, b: reports.join_diff_by_method(p, b, CFG),
        lambda p, b: reports.join_diff_by_method(p, b, CFG, sum_bank_first=False),
    ],
)
def test_only_matched_amounts_have_to_be_readable(spark, case, report):
    frames, _ = case
    p, b = frames["full_payout"], frames["full_bank"]
    bad = {"withdrawal_created_at": "1998-11-01", "total_cashout_usd": "no amount"}
    row = p.limit(1).withColumns({c: F.lit(v) for c, v in bad.items()})
    alone = row.withColumn(CFG.payout.key, F.lit("nobody has this"))
    same = sorted(map(str, report(p, b).collect()))
    assert sorted(map(str, report(p.union(alone), b).collect())) == same
    with pytest.raises(PySparkException, match="not readable"):
        report(p.union(row.withColumn(CFG.payout.key, F.lit("hot"))), b).collect()


def shuffles(df) -> list[str]:
    """Exchanges of the plan before it runs, without those that are used again."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [line for line in plan.splitlines() if " Exchange " in line or "- Exchange" in line]
    return [re.search(r"Exchange (\w+)", line)[1] for line in found if "Reused" not in line]


@pytest.mark.parametrize("first", [True, False])
def test_differences_shuffle_each_side_twice(case, spark, first):
    """Both sides together: behind the map-side aggregate, by key and amount, totals by key and
    method, and these by key; then the methods. Summing bank rows first costs one of its own.
    Dealing rows out by the key alone would take one less, and put a hot key into one task."""
    frames, _ = case
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reports.join_diff_by_method(frames["full_payout"], frames["full_bank"], CFG, sum_bank_first=first)
        found = shuffles(df)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len([x for x in found if x == "hashpartitioning"]) <= (6 if first else 5), found
