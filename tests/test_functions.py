from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerproof.config import Period
from ledgerproof.functions import (
    day_of,
    escape_preview,
    in_months,
    in_period,
    joined_where,
    money,
    normalised,
    null_if_empty,
    try_money,
    year_prefix,
)

TEXTS = [
    "1998-10-01", "1998-10-01T08:00:00Z", "1998-12-31 23:59:59", "1999-01-01", "1998-09-30T23:00",
    "1998-13-01", "1998-11-31", "1998-1", "1998", "1998/10/01", "10/01/1998", "", " 1998-10-05",
    "n/a", "1998-10-0x", "1998-10-01x", "1998-12-31~", None,
]
DAYS = {
    "1998-10-01": date(1998, 10, 1),
    "1998-10-01T08:00:00Z": date(1998, 10, 1),
    "1998-12-31 23:59:59": date(1998, 12, 31),
    "1999-01-01": date(1999, 1, 1),
    "1998-09-30T23:00": date(1998, 9, 30),
    "1998-10-01x": date(1998, 10, 1),
    "1998-12-31~": date(1998, 12, 31),
}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_day_of_reads_only_full_iso_days(spark):
    rows = texts(spark, TEXTS).select("t", day_of("t").alias("d")).collect()
    assert {r.t: r.d for r in rows} == {t: DAYS.get(t) for t in TEXTS}


def test_both_period_forms_keep_the_same_rows(spark):
    df = texts(spark, TEXTS)
    by_range = {r.t for r in df.where(in_period("t", Period("1998-10-01", "1999-01-01"))).collect()}
    by_month = {r.t for r in df.where(in_months("t", 1998, (10, 11, 12))).collect()}
    expected = {t for t, d in DAYS.items() if date(1998, 10, 1) <= d < date(1999, 1, 1)}
    assert by_range == by_month == expected


def test_quarters():
    assert Period.quarter(2026, 1) == Period("2026-01-01", "2026-04-01")
    assert Period.quarter(2025, 4) == Period("2025-10-01", "2026-01-01")


def test_period_bounds_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "staged")
    texts(spark, TEXTS).write.parquet(path)
    df = spark.read.parquet(path).where(in_period("t", Period("1998-10-01", "1999-01-01")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,1998-10-01)" in plan and "LessThan(t,1999-01-01)" in plan


def test_money(spark):
    df = texts(spark, ["12.345", " 5 ", "1E3", "1,234", "", None, "-0.5"])
    got = [r[0] for r in df.select(try_money("t")).collect()]
    assert got == [Decimal("12.35"), Decimal("5.00"), Decimal("1000.00"), None, None, None, Decimal("-0.50")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_money_fails_on_text_but_not_on_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert texts(spark, [None]).select(money("t").alias("m")).first().m is None
        with pytest.raises(PySparkException, match="not an amount: 1,234"):
            texts(spark, ["1,234"]).select(money("t")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_text_helpers(spark):
    df = texts(spark, ["  Prov_A ", "", "a\r\nb", None])
    rows = df.select(
        normalised("t").alias("n"), null_if_empty("t").alias("e"), escape_preview("t", 3).alias("p")
    ).collect()
    assert [r.n for r in rows] == ["prov_a", "", "a\r\nb", None]
    assert [r.e for r in rows] == ["  Prov_A ", None, "a\r\nb", None]
    assert [r.p for r in rows] == ["  P...", "", "a\\r...", None]


def test_year_prefix_and_joined_names(spark):
    df = texts(spark, ["1998-x", "2001", None])
    assert [r.t for r in df.where(year_prefix("t", (1998,))).collect()] == ["1998-x"]
    joined = df.select(
        joined_where(["x", "y"], [F.col("t").contains("1998"), F.col("t").contains("-")]).alias("j")
    )
    assert [r.j for r in joined.collect()] == ["x;y", "", ""]


def test_scope_without_regard_to_case(spark):
    from ledgerproof.config import Scope
    from ledgerproof.operators.filters import in_scope

    rows = [("OUTGOING", "Sent"), ("outgoing", "sent"), ("Outgoing", "RETURNED"), ("OUTGOING", None)]
    df = spark.createDataFrame(rows, "direction string, type string")
    exact = Scope(equal=(("direction", "OUTGOING"),), empty=())
    folded = Scope(equal=(("direction", "OUTGOING"),), empty=(), ignore_case=True)
    assert df.where(in_scope(exact)).count() == 1
    assert df.where(in_scope(folded)).count() == 2
