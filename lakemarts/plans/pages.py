"""Reads over the marts, one per dashboard page.

The marts are already aggregated, so each page is one small group-by. Means are
taken from totals and the counts of the values in them, which the stage tables of
the marts carry; a mean of means is never taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETED = "Completed"
RESOLVED = "Resolved"


def page_overview(financial_health: DataFrame) -> DataFrame:
    """Customers, accounts, deposits and DTI per segment and rating."""
    return financial_health.groupBy("customer_segment", "credit_risk_rating").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_accounts_owned").alias("accounts"),
        F.sum("total_deposit_balance").cast("decimal(28,2)").alias("deposit_balance"),
        F.round(F.avg("dti_ratio"), 2).alias("avg_dti_ratio"),
    )


def page_transactions(transaction_totals: DataFrame) -> DataFrame:
    """Volume, value and completed share per month.

    The mean amount is that of the transactions with an amount, as in the mart.
    """
    counted = F.col("total_transaction_count")
    completed = F.sum(F.when(F.col("status") == COMPLETED, counted).otherwise(0))
    amount = F.sum("total_transaction_amount").cast("decimal(28,2)")
    number = F.sum(counted)
    priced = F.nullif(F.sum("priced_count"), F.lit(0)).cast("decimal(20,0)")
    return transaction_totals.groupBy("transaction_month").agg(
        number.alias("transaction_count"),
        amount.alias("transaction_amount"),
        F.round(amount.cast("decimal(30,2)") / priced, 2)
        .cast("decimal(28,2)")
        .alias("amount_per_transaction"),
        completed.alias("completed_count"),
        (completed.cast("double") / F.nullif(number, F.lit(0)).cast("double")).alias(
            "completed_share"
        ),
    )


def page_loans(loans_exact: DataFrame) -> DataFrame:
    """Principal lent, repaid, interest and fees per loan status (D3)."""
    return loans_exact.groupBy("loan_status").agg(
        F.sum("total_loans_count").alias("loans"),
        *[
            F.sum(total).cast("decimal(28,2)").alias(name)
            for total, name in (
                ("total_principal_borrowed", "principal_borrowed"),
                ("total_amount_repaid", "amount_repaid"),
                ("principal_repaid_component", "principal_repaid"),
                ("interest_profit_earned", "interest_earned"),
                ("total_late_fees_collected", "late_fees"),
            )
        ],
    )


def page_fraud(fraud_totals: DataFrame) -> DataFrame:
    """Alerts, resolved alerts and risk per alert type.

    The mean risk is that of all scores; alerts without one do not weigh in.
    """
    raised = F.col("total_alerts_raised")
    scored = F.nullif(F.sum("scored_count"), F.lit(0)).cast("decimal(20,0)")
    return fraud_totals.groupBy("alert_type").agg(
        F.sum(raised).alias("alerts"),
        F.sum(F.when(F.col("status") == RESOLVED, raised).otherwise(0)).alias("resolved_alerts"),
        F.round(F.sum("risk_score_total").cast("decimal(20,0)") / scored, 2)
        .cast("decimal(20,2)")
        .alias("avg_risk_score"),
        F.max("max_risk_score").alias("max_risk_score"),
    )
