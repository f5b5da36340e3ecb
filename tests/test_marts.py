from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemarts.plans import marts
from lakemarts.registry.queries import QUERIES, silver
from lakemarts.schemas import TABLES

DATA_DIR = "/root/testdata/sf0.001"
D = Decimal


def table(spark, name, *rows):
    """Rows given as dicts; columns left out are null."""
    schema = TABLES[name].schema
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)


def one(df):
    (row,) = df.collect()
    return row.asDict()


# --- contract -----------------------------------------------------------------

CONTRACT = {
    "financial_health": {
        "customer_uuid": "string",
        "city": "string",
        "country": "string",
        "employment_status": "string",
        "customer_segment": "string",
        "annual_income": "decimal(12,2)",
        "total_accounts_owned": "bigint",
        "total_deposit_balance": "decimal(26,2)",
        "bureau_credit_score": "int",
        "credit_risk_rating": "string",
        "dti_ratio": "decimal(5,2)",
        "missed_payments_count": "int",
    },
    "transactions": {
        "transaction_month": "timestamp",
        "transaction_type": "string",
        "spending_sector": "string",
        "channel": "string",
        "status": "string",
        "transaction_city": "string",
        "total_transaction_count": "bigint",
        "total_transaction_amount": "decimal(23,2)",
        "avg_transaction_amount": "decimal(13,2)",
    },
    "loans": {
        "loan_type": "string",
        "loan_status": "string",
        "term_months": "int",
        "total_loans_count": "bigint",
        "total_principal_borrowed": "decimal(26,2)",
        "total_amount_repaid": "decimal(23,2)",
        "principal_repaid_component": "decimal(23,2)",
        "interest_profit_earned": "decimal(23,2)",
        "total_late_fees_collected": "decimal(19,2)",
    },
    "fraud": {
        "alert_type": "string",
        "status": "string",
        "total_alerts_raised": "bigint",
        "avg_risk_score": "double",
        "max_risk_score": "int",
    },
}
CONTRACT["loans_exact"] = CONTRACT["loans"]


@pytest.mark.parametrize("mart", CONTRACT)
def test_names_and_types(spark, mart):
    from lakemarts.plans.medallion import MART_PLANS

    plan, inputs = MART_PLANS[mart]
    assert dict(plan(*[table(spark, name) for name in inputs]).dtypes) == CONTRACT[mart]


# --- financial health ---------------------------------------------------------

ANN = dict(customer_id=1, customer_uuid="a", city="Leeds", annual_income=D("10.00"))
BALANCE = dict(customer_uuid="a", account_id=1, current_balance=D("100.00"))
SCORE = dict(customer_uuid="a", bureau_score=700, risk_rating="Good")


def health(spark, people, accounts=(), scores=()):
    return marts.mart_financial_health(
        table(spark, "customers", *people),
        table(spark, "accounts", *accounts),
        table(spark, "credit_scores", *scores),
    )


def test_customer_without_account_or_score(spark):
    row = one(health(spark, [ANN]))
    assert row["total_accounts_owned"] == 0
    assert row["total_deposit_balance"] == D("0.00")
    for name in ("bureau_credit_score", "credit_risk_rating", "dti_ratio", "missed_payments_count"):
        assert row[name] is None


def test_second_score_row_doubles_the_balance(spark):
    row = one(health(spark, [ANN], [BALANCE], [SCORE, dict(SCORE, risk_rating="Poor")]))
    assert row["total_deposit_balance"] == D("200.00")
    assert row["total_accounts_owned"] == 1
    assert row["credit_risk_rating"] == "Poor"


def test_largest_rating_is_lexical(spark):
    scores = [dict(SCORE, risk_rating=r) for r in ("Poor", "Excellent")]
    assert one(health(spark, [ANN], [], scores))["credit_risk_rating"] == "Poor"


def test_customer_in_two_places_gets_two_rows(spark):
    rows = health(spark, [ANN, dict(ANN, city="York")], [BALANCE]).collect()
    assert sorted((r.city, r.total_deposit_balance) for r in rows) == [
        ("Leeds", D("100.00")),
        ("York", D("100.00")),
    ]


def test_null_keys_never_match(spark):
    nameless = dict(ANN, customer_uuid=None)
    row = one(health(spark, [nameless], [dict(BALANCE, customer_uuid=None)]))
    assert row["total_accounts_owned"] == 0 and row["total_deposit_balance"] == D("0.00")


KEY = st.sampled_from([None, "a", "b", "c"])
MONEY = st.one_of(st.none(), st.integers(-500, 500).map(lambda n: D(n).scaleb(-2)))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    people=st.lists(st.tuples(KEY, st.sampled_from([None, "x", "y"])), min_size=1, max_size=6),
    accounts=st.lists(st.tuples(KEY, st.sampled_from([None, 1, 2, 3]), MONEY), max_size=8),
    scores=st.lists(st.tuples(KEY, st.sampled_from([None, 1, 2])), max_size=5),
)
def test_health_equals_join_then_aggregate(spark, people, accounts, scores):
    """Any repeats, nulls and orphans: the same rows as the direct form."""
    people = table(spark, "customers", *[dict(customer_uuid=k, city=c) for k, c in people])
    accounts = table(
        spark,
        "accounts",
        *[dict(customer_uuid=k, account_id=i, current_balance=b) for k, i, b in accounts],
    )
    scores = table(
        spark, "credit_scores", *[dict(customer_uuid=k, bureau_score=s) for k, s in scores]
    )
    direct = spark.sql(
        """SELECT c.customer_uuid, c.city, count(DISTINCT a.account_id) AS n,
             coalesce(sum(a.current_balance), 0) AS b, max(s.bureau_score) AS s
           FROM {c} c LEFT JOIN {a} a ON c.customer_uuid = a.customer_uuid
           LEFT JOIN {s} s ON c.customer_uuid = s.customer_uuid
           GROUP BY c.customer_uuid, c.city""",
        c=people,
        a=accounts,
        s=scores,
    )
    mart = marts.mart_financial_health(people, accounts, scores).select(
        "customer_uuid",
        "city",
        "total_accounts_owned",
        "total_deposit_balance",
        "bureau_credit_score",
    )
    assert sorted(map(tuple, mart.collect()), key=repr) == sorted(
        map(tuple, direct.collect()), key=repr
    )


# --- transactions -------------------------------------------------------------


def spend(spark, amounts):
    moment = datetime(2024, 2, 29, 23, 59, 59)
    rows = [
        dict(transaction_id=i, amount=a, transaction_timestamp=moment)
        for i, a in enumerate(amounts)
    ]
    return one(marts.mart_transactions(table(spark, "transactions", *rows)))


def test_group_without_amounts(spark):
    row = spend(spark, [None, None])
    assert row["total_transaction_count"] == 2
    assert row["total_transaction_amount"] is None and row["avg_transaction_amount"] is None
    assert row["transaction_month"] == datetime(2024, 2, 1)


def test_month_does_not_depend_on_the_session_zone(spark):
    moment = datetime(2024, 3, 1, 0, 30)
    rows = table(spark, "transactions", dict(transaction_id=1, transaction_timestamp=moment))
    try:
        for zone in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            month = marts.mart_transactions(rows).selectExpr(
                "CAST(transaction_month AS STRING)"
            )
            assert month.first()[0] == "2024-03-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_mean_is_rounded_at_six_digits_and_then_at_two(spark):
    base = table(spark, "transactions", dict(transaction_id=1))
    rows = base.select(
        *[c for c in base.columns if c != "amount"],
        F.explode(
            F.concat(
                F.array_repeat(F.lit("1.00").cast("decimal(12,2)"), 100_001),
                F.array_repeat(F.lit("1.01").cast("decimal(12,2)"), 100_000),
            )
        ).alias("amount"),
    )
    assert one(marts.mart_transactions(rows))["avg_transaction_amount"] == D("1.01")


def test_counts_add_up_to_the_rows(spark):
    counted = QUERIES["mart_transactions"](spark, DATA_DIR).agg(F.sum("total_transaction_count"))
    assert counted.first()[0] == silver(spark, DATA_DIR, "transactions").count()


# --- loans --------------------------------------------------------------------

LOAN = dict(loan_id=1, loan_type="Auto Loan", principal_amount=D("1000.00"), term_months=12)
PAID = dict(loan_id=1, amount_paid=D("10.00"), late_fee_applied=D("25.00"))


def loans(spark, mart, lent, repaid=()):
    return mart(
        table(spark, "loan_applications", *lent), table(spark, "loan_repayments", *repaid)
    )


def test_principal_per_repayment_and_exact(spark):
    direct = one(loans(spark, marts.mart_loans, [LOAN], [PAID] * 3))
    exact = one(loans(spark, marts.mart_loans_exact, [LOAN], [PAID] * 3))
    assert direct.pop("total_principal_borrowed") == D("3000.00")
    assert exact.pop("total_principal_borrowed") == D("1000.00")
    assert direct == exact
    assert exact["total_amount_repaid"] == D("30.00")
    assert exact["total_late_fees_collected"] == D("75.00")


def test_loan_without_repayments(spark):
    row = one(loans(spark, marts.mart_loans, [LOAN]))
    assert row["total_loans_count"] == 1
    assert row["total_principal_borrowed"] == D("1000.00")
    assert row["total_amount_repaid"] == D("0.00")


def test_group_without_principal_is_null_not_zero(spark):
    row = one(loans(spark, marts.mart_loans, [dict(LOAN, principal_amount=None)], [PAID]))
    assert row["total_principal_borrowed"] is None


LOAN_ROW = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from(["x", None]), MONEY)
PAID_ROW = st.tuples(st.sampled_from([None, 1, 2, 9]), MONEY)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    lent=st.lists(LOAN_ROW, min_size=1, max_size=6),
    repaid=st.lists(PAID_ROW, max_size=8),
)
def test_loans_equal_join_then_aggregate(spark, lent, repaid):
    lent = table(
        spark,
        "loan_applications",
        *[dict(loan_id=i, loan_type=t, principal_amount=p) for i, t, p in lent],
    )
    repaid = table(spark, "loan_repayments", *[dict(loan_id=i, amount_paid=a) for i, a in repaid])
    direct = spark.sql(
        """SELECT l.loan_type, count(DISTINCT l.loan_id) AS n, sum(l.principal_amount) AS p,
             coalesce(sum(r.amount_paid), 0) AS a
           FROM {l} l LEFT JOIN {r} r ON l.loan_id = r.loan_id GROUP BY l.loan_type""",
        l=lent,
        r=repaid,
    )
    mart = marts.mart_loans(lent, repaid).select(
        "loan_type", "total_loans_count", "total_principal_borrowed", "total_amount_repaid"
    )
    assert sorted(map(tuple, mart.collect()), key=repr) == sorted(
        map(tuple, direct.collect()), key=repr
    )


def test_one_health_row_per_customer(spark):
    mart = QUERIES["mart_financial_health"](spark, DATA_DIR)
    assert mart.count() == mart.select("customer_uuid").distinct().count()
