from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakemarts.operators import quality
from lakemarts.operators.joins import left_join, left_join_chain
from lakemarts.schemas import TABLES, ForeignKey
from tests.test_marts import table


def found(df):
    return sorted(tuple(row) for row in df.collect())


def test_ranges(spark):
    scores = [dict(alert_id=i, risk_score=s) for i, s in enumerate([0, 100, 101, None, -1])]
    alerts = table(spark, "fraud_alerts", *scores)
    assert found(quality.audit_check({"fraud_alerts": alerts})) == [
        ("fraud_alerts", "risk_score", 2)
    ]
    bad = quality.check_violations(alerts, TABLES["fraud_alerts"])
    assert sorted(r.risk_score for r in bad.collect()) == [-1, 101]
    cards = table(spark, "credit_cards", dict(card_id=1))
    assert quality.check_violations(cards, TABLES["credit_cards"]).count() == 0


def test_not_null(spark):
    accounts = table(spark, "accounts", dict(account_id=1), dict(account_id=None))
    assert found(quality.audit_not_null({"accounts": accounts})) == [
        ("accounts", "account_id", 1),
        ("accounts", "account_type", 2),
        ("accounts", "account_uuid", 2),
        ("accounts", "customer_uuid", 2),
    ]


def test_lengths(spark):
    accounts = table(
        spark, "accounts", dict(currency="GBP", status="x" * 21), dict(currency="EURO")
    )
    assert found(quality.audit_length({"accounts": accounts})) == [
        ("accounts", "account_type", 0),
        ("accounts", "currency", 1),
        ("accounts", "status", 1),
    ]


def test_row_rules_of_a_table_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "alerts")
    table(spark, "fraud_alerts", dict(alert_id=1, risk_score=101)).write.parquet(path)
    audit = quality.audit_rows(
        {"fraud_alerts": spark.read.parquet(path)}, "not null", "range", "length"
    )
    assert audit._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    counts = {(r.rule, r.column_name): r.violations for r in audit.collect()}
    assert counts[("range", "risk_score")] == 1
    assert counts[("not null", "alert_type")] == 1
    assert counts[("length", "alert_type")] == 0
    assert len(counts) == 7


def test_unique_ignores_nulls(spark):
    scores = table(
        spark,
        "credit_scores",
        *[dict(score_id=i, customer_uuid=k) for i, k in enumerate(["a", "a", "a", "b", None, None])],
    )
    assert found(quality.audit_unique({"credit_scores": scores})) == [
        ("credit_scores", "customer_uuid", 1, 2),
        ("credit_scores", "score_id", 0, 0),
    ]
    assert found(quality.unique_violations(scores, "customer_uuid")) == [("a", 3)]


def test_references(spark):
    loans = table(spark, "loan_applications", dict(loan_id=1), dict(loan_id=1))
    paid = table(
        spark, "loan_repayments", *[dict(loan_id=i) for i in (1, 1, 2, 2, 3, None)]
    )
    tables = {"loan_applications": loans, "loan_repayments": paid}
    assert found(quality.audit_fk(tables)) == [
        ("loan_repayments", "loan_id", "loan_applications", 2, 3)
    ]
    reference = ForeignKey("loan_id", "loan_applications", "loan_id")
    assert found(quality.orphan_keys(paid, reference, loans)) == [(2, 2), (3, 1)]


def test_defaults_fill_absent_columns_only(spark):
    noon = datetime(2026, 3, 1, 12, 0, 0, 250)
    bare = spark.createDataFrame([(1,)], "account_id int")
    filled = quality.apply_defaults(bare, TABLES["accounts"], noon).first()
    assert tuple(filled) == (1, "GBP", "Active", date(2026, 3, 1))
    explicit = spark.createDataFrame([(1, None)], "account_id int, currency string")
    assert quality.apply_defaults(explicit, TABLES["accounts"], noon).first().currency is None
    created = quality.apply_defaults(bare, TABLES["customers"], noon).first()
    assert created.created_at == noon and created.country == "United Kingdom"
    fee = quality.apply_defaults(bare, TABLES["loan_repayments"], noon)
    assert fee.first().late_fee_applied == Decimal("0.00")
    assert dict(fee.dtypes)["late_fee_applied"] == "decimal(8,2)"


def test_audits_of_some_tables(spark):
    customers = table(spark, "customers", dict(customer_id=1, customer_uuid="a"))
    assert quality.audit_check({"customers": customers}).count() == 0
    assert quality.audit_fk({"customers": customers}).count() == 0
    assert quality.audit_unique({}).columns[-1] == "surplus_rows"
    assert quality.row_counts({}).count() == 0
    with pytest.raises(ValueError, match="customers"):
        quality.audit_fk({"accounts": table(spark, "accounts")})


def test_row_counts(spark):
    tables = {"b": spark.range(2), "a": spark.range(5), "c": spark.range(0)}
    assert [tuple(r) for r in quality.row_counts_sorted(tables).collect()] == [
        ("a", 5),
        ("b", 2),
        ("c", 0),
    ]


LEFT = [("a", 1), ("b", 2), (None, 3), ("a", 4)]
RIGHT = [("a", 10), ("a", 11), (None, 12), ("z", 13)]


def test_left_join_is_the_built_in_one(spark):
    left = spark.createDataFrame(LEFT, "k string, x int")
    right = spark.createDataFrame(RIGHT, "k string, y int")
    ours, plain = left_join(left, right, "k"), left.join(right, "k", "left")
    assert ours.dtypes == plain.dtypes
    assert sorted(ours.collect(), key=repr) == sorted(plain.collect(), key=repr)


KEYS = st.sampled_from([None, "a", "b", "c"])
SIDE = st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=SIDE, right=SIDE)
def test_left_join_on_random_rows(spark, left, right):
    left = spark.createDataFrame(left, "k string, x int")
    right = spark.createDataFrame(right, "k string, y int")
    plain = left.join(right, "k", "left").collect()
    assert sorted(left_join(left, right, "k").collect(), key=repr) == sorted(plain, key=repr)


def test_left_join_with_key_in_the_middle_and_a_shared_name(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    right = spark.createDataFrame([("a", 10)], "k string, x int")
    assert sorted(map(tuple, left_join(left, right, "k").collect())) == [
        ("a", 1, 10),
        ("b", 2, None),
    ]


def test_left_join_chain(spark):
    left = spark.createDataFrame(LEFT, "k string, x int")
    right = spark.createDataFrame(RIGHT, "k string, y int")
    third = spark.createDataFrame([("b", 7)], "k string, z int")
    ours = left_join_chain(left, [right, third], "k")
    plain = left.join(right, "k", "left").join(third, "k", "left")
    assert sorted(ours.collect(), key=repr) == sorted(plain.collect(), key=repr)
