from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from lakemarts.plans import marts, pages

D = Decimal


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_overview(spark):
    mart = spark.createDataFrame(
        [
            ("Standard", "Good", 2, D("10.50"), D("10.00")),
            ("Standard", "Good", 1, D("-0.50"), D("20.01")),
            ("Standard", None, 0, D("0.00"), None),
        ],
        "customer_segment string, credit_risk_rating string, total_accounts_owned bigint,"
        "total_deposit_balance decimal(26,2), dti_ratio decimal(5,2)",
    )
    assert rows(pages.page_overview(mart)) == [
        ("Standard", "Good", 2, 3, D("10.00"), D("15.01")),
        ("Standard", None, 1, 0, D("0.00"), None),
    ]


def test_transaction_mean_leaves_out_missing_amounts(spark):
    may, june = datetime(2024, 5, 1), datetime(2024, 6, 1)
    totals = spark.createDataFrame(
        [
            (may, "Completed", 3, D("30.00"), 2),
            (may, "Failed", 1, D("100.00"), 1),
            (june, "Failed", 2, None, 0),
        ],
        "transaction_month timestamp, status string, total_transaction_count bigint,"
        "total_transaction_amount decimal(23,2), priced_count bigint",
    )
    assert rows(pages.page_transactions(totals)) == [
        (may, 4, D("130.00"), D("43.33"), 3, 0.75),
        (june, 2, None, None, 0, 0.0),
    ]


def test_loans(spark):
    types = ["total_loans_count bigint"] + [
        f"{name} decimal(26,2)"
        for name in (
            "total_principal_borrowed",
            "total_amount_repaid",
            "principal_repaid_component",
            "interest_profit_earned",
            "total_late_fees_collected",
        )
    ]
    mart = spark.createDataFrame(
        [
            ("Active", 2, D("100.00"), D("5.00"), D("4.00"), D("1.00"), D("25.00")),
            ("Active", 1, None, D("1.00"), D("1.00"), D("0.00"), D("0.00")),
        ],
        "loan_status string, " + ", ".join(types),
    )
    assert rows(pages.page_loans(mart)) == [
        ("Active", 3, D("100.00"), D("6.00"), D("5.00"), D("1.00"), D("25.00"))
    ]


def test_fraud_mean_is_that_of_all_scores(spark):
    alerts = spark.createDataFrame(
        [(1, "v", "Resolved", 90), (2, "v", "Open", 60), (3, "v", "Open", 61), (4, "v", "Open", None)]
        + [(5, "none", None, None)],
        "alert_id int, alert_type string, status string, risk_score int",
    )
    # 211 / 3; the mean of the rounded group means 90 and 60.5, by alerts, is 67.88.
    assert rows(pages.page_fraud(marts.fraud_totals(alerts))) == [
        ("none", 1, 0, None, None),
        ("v", 4, 1, D("70.33"), 90),
    ]
