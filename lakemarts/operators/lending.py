"""Operators over loans, accounts and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.functions.banking import instalment, interest_part

# Only these account types bear interest; this one is free.
INTEREST_BEARING = ("Savings", "ISA")
FREE_OF_FEES = "Student"


def instalment_split(loans: DataFrame) -> DataFrame:
    """Adds the instalment of each loan and its two parts."""
    amount = instalment(F.col("principal_amount"), F.col("term_months"))
    interest = interest_part(F.col("instalment_amount"), F.col("interest_rate"))
    return (
        loans.withColumn("instalment_amount", amount)
        .withColumn("interest_component", interest)
        .withColumn(
            "principal_component",
            (F.col("instalment_amount") - F.col("interest_component")).cast("decimal(12,2)"),
        )
    )


def repayment_schedule(
    loans: DataFrame, anchor: str, payments: str, step_days: int = 30
) -> DataFrame:
    """One row per payment: number j is due ``step_days * j`` before ``anchor``.

    ``anchor`` and ``payments`` name a date and an integer column. A loan
    with fewer than one payment yields no rows.
    """
    due = loans.where(F.col(payments) >= 1).withColumn(
        "payment_number", F.explode(F.sequence(F.lit(1), F.col(payments)))
    )
    days_back = (F.col("payment_number") * step_days).cast("int")
    return due.withColumn("payment_date", F.date_sub(F.col(anchor), days_back))


def product_rule_violations(accounts: DataFrame) -> DataFrame:
    """Accounts with interest or fees their product does not have.

    The input plus ``broken_rule``, one row for each rule an account breaks.
    """
    kind = F.col("account_type")
    bears_interest = kind.contains(INTEREST_BEARING[0]) | kind.contains(INTEREST_BEARING[1])
    broken = F.array_compact(
        F.array(
            F.when(~bears_interest & (F.col("interest_rate_apr") != 0), "interest"),
            F.when(
                kind.contains(FREE_OF_FEES) & (F.col("monthly_maintenance_fee") != 0), "fee"
            ),
        )
    )
    return accounts.withColumn("broken_rule", F.explode(broken))


def alert_rate(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """``total_alerts, total_transactions, alert_rate`` in one row."""
    counts = alerts.agg(
        F.count(F.lit(1)).alias("a"), F.lit(0).cast("bigint").alias("t")
    ).unionByName(
        transactions.agg(F.lit(0).cast("bigint").alias("a"), F.count(F.lit(1)).alias("t"))
    )
    return counts.agg(
        F.sum("a").alias("total_alerts"), F.sum("t").alias("total_transactions")
    ).withColumn(
        "alert_rate",
        F.col("total_alerts").cast("double")
        / F.nullif(F.col("total_transactions"), F.lit(0)).cast("double"),
    )
