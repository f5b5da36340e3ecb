from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemarts.functions import banking
from lakemarts.operators import lending, profile


def column(spark, rows, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_risk_band(spark):
    got = column(spark, [740, 741, 670, 580, 581, None], "int", banking.risk_band)
    assert got == ["Good", "Excellent", "Fair", "Poor", "Fair", None]


def test_mask_card(spark):
    got = column(spark, ["4000123412349876", None], "string", banking.masked_card)
    assert got == ["****-****-****-9876", None]


def test_cap(spark):
    amounts = [Decimal("15000.01"), Decimal("14999.99"), None]
    got = column(spark, amounts, "decimal(12,2)", banking.capped)
    assert got == [Decimal("15000.00"), Decimal("14999.99"), None]


def test_month(spark):
    moment = [datetime(2024, 2, 29, 23, 59, 59)]
    assert column(spark, moment, "timestamp_ntz", banking.month_of) == [datetime(2024, 2, 1)]


def test_rounding_is_half_up(spark):
    row = spark.sql("SELECT 2.675 AS a, -2.5 AS b").select(F.round("a", 2), F.round("b", 0)).first()
    assert [Decimal(str(v)) for v in row] == [Decimal("2.68"), Decimal("-3")]


def test_money_or_zero(spark):
    got = column(spark, [None, Decimal("1.25")], "decimal(12,2)", banking.money_or_zero)
    assert got == [Decimal("0.00"), Decimal("1.25")]


def test_instalment_split(spark):
    loans = spark.createDataFrame(
        [(1, Decimal("8000.00"), Decimal("7.50"), 36), (2, None, Decimal("7.50"), 12)],
        "loan_id int, principal_amount decimal(15,2), interest_rate decimal(5,2), term_months int",
    )
    split = lending.instalment_split(loans).orderBy("loan_id").collect()
    assert tuple(split[0])[4:] == (Decimal("222.22"), Decimal("1.39"), Decimal("220.83"))
    assert tuple(split[1])[4:] == (None, None, None)


def test_repayment_schedule(spark):
    loans = spark.createDataFrame(
        [(1, date(2024, 3, 31), 2), (2, date(2024, 3, 31), 0), (3, date(2024, 3, 31), None)],
        "loan_id int, anchor date, n int",
    )
    rows = lending.repayment_schedule(loans, "anchor", "n").collect()
    assert sorted((r.loan_id, r.payment_number, r.payment_date) for r in rows) == [
        (1, 1, date(2024, 3, 1)),
        (1, 2, date(2024, 1, 31)),
    ]


def test_product_rules(spark):
    zero, some = Decimal("0.00"), Decimal("3.00")
    rows = [
        (1, "Current Account", some, some),
        (2, "Instant Savings", some, some),
        (3, "Student Account", some, some),
        (4, "Student Account", zero, None),
        (5, "Fixed ISA", zero, zero),
    ]
    accounts = spark.createDataFrame(
        rows,
        "account_id int, account_type string, interest_rate_apr decimal(5,2),"
        "monthly_maintenance_fee decimal(6,2)",
    )
    broken = lending.product_rule_violations(accounts).collect()
    assert sorted((r.account_id, r.broken_rule) for r in broken) == [
        (1, "interest"),
        (3, "fee"),
        (3, "interest"),
    ]


def test_alert_rate(spark):
    row = lending.alert_rate(spark.range(4), spark.range(100)).first()
    assert tuple(row) == (4, 100, 0.04)
    assert lending.alert_rate(spark.range(4), spark.range(0)).first().alert_rate is None


def test_dirt_profile(spark):
    rows = [("Fuel",), ("FUEL",), (" fuel ",), ("Gym",), ("  ",), ("",), (None,)]
    got = profile.dirt_profile(spark.createDataFrame(rows, "sector string")).first().asDict()
    assert got == {
        "column_name": "sector",
        "total_rows": 7,
        "null_rows": 1,
        "blank_rows": 2,
        "padded_rows": 1,
        "values_seen": 4,
        "values_merged": 2,
        "variant_rows": 3,
    }


CITIES = [(1, "LONDON"), (2, " london "), (3, "London"), (4, "Leeds"), (5, None), (6, " ")]


def test_canonical_case(spark):
    df = spark.createDataFrame(CITIES, "id int, city string")
    fixed = profile.canonical_case(df, "city", ["London", "York"]).orderBy("id").collect()
    assert [r.city for r in fixed] == ["London"] * 3 + ["Leeds", None, " "]


def test_canonical_case_from_table(spark):
    df = spark.createDataFrame(CITIES, "id int, city string")
    # Two spellings of one name and a null must not change the row count.
    known = spark.createDataFrame([("London",), ("london",), (None,)], "name string")
    fixed = profile.canonical_case_from(df, "city", known, "name").orderBy("id").collect()
    assert [r.city for r in fixed] == ["London"] * 3 + ["Leeds", None, " "]


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_schedule_takes_either_integer(spark, kind):
    loans = spark.createDataFrame([(1, date(2024, 1, 31), 1)], f"id int, anchor date, n {kind}")
    assert lending.repayment_schedule(loans, "anchor", "n").first().payment_date == date(2024, 1, 1)


def test_learned_spellings(spark):
    words = ["York", "York ", "YORK", "leeds", "LEEDS", "Bath", None, "", "  ", " bath", "bath"]
    df = spark.createDataFrame(list(enumerate(words)), "id int, city string")
    learned = {tuple(r) for r in profile.learned_spellings(df, "city").collect()}
    # Equally frequent: the smallest, by bytes.
    assert learned == {("York", 3, 2), ("LEEDS", 2, 2), ("bath", 3, 2)}
    fixed = [r.city for r in profile.canonical_case_learned(df, "city").orderBy("id").collect()]
    assert fixed == ["York", "York", "York", "LEEDS", "LEEDS", "bath", None, "", "  ", "bath", "bath"]
    assert profile.canonical_case_learned(df.limit(0), "city").count() == 0


def test_canonical_case_of_no_spellings(spark):
    df = spark.createDataFrame([(1, "a")], "id int, city string")
    assert profile.canonical_case(df, "city", []).collect() == df.collect()
