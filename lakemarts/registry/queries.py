"""Every operator as a named query over the given tables.

A query takes a session and a data folder and returns a lazy DataFrame over
whole tables. ``oracles`` holds the same questions in SQL for a second engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.functions.banking import capped, masked_card, money_or_zero, month_of, risk_band
from lakemarts.operators import cleaning, lending, profile, quality
from lakemarts.operators.dedup import dedup_by_key
from lakemarts.operators.joins import left_join, left_join_chain
from lakemarts.plans import marts, medallion, pages
from lakemarts.schemas import TABLES
from lakemarts.settings import LakeSettings
from lakemarts.sources.bank_views import SPENDING_SECTORS, bank_table, bank_tables, given_table
from lakemarts.sources.catalog import create_database, save_table
from lakemarts.sources.readers import read_table, sample_rows

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = datetime(2026, 1, 1, 12, 30)


def silver(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return cleaning.clean_table(bank_table(spark, data_dir, name))


def silvers(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    return {name: silver(spark, data_dir, name) for name in TABLES}


def _mart(spark: SparkSession, data_dir: str, mart: str) -> DataFrame:
    plan, inputs = medallion.MART_PLANS[mart]
    return plan(*[silver(spark, data_dir, name) for name in inputs])


#: Lakes made by each session, by purpose.
_LAKES: WeakKeyDictionary[SparkSession, dict[str, LakeSettings]] = WeakKeyDictionary()


def _new_lake(spark: SparkSession, purpose: str) -> LakeSettings:
    """A lake in the session's warehouse; that of this session's last call is dropped.

    Lakes of other purposes and other sessions stay.
    """
    lakes = _LAKES.setdefault(spark, {})
    if purpose in lakes:
        for database in spark.catalog.listDatabases(f"{lakes[purpose].database_prefix}*"):
            spark.sql(f"DROP SCHEMA {database.name} CASCADE")
    lakes[purpose] = LakeSettings(database_prefix=f"lakemarts_{purpose}_{uuid.uuid4().hex[:12]}_")
    return lakes[purpose]


# --- sources and sinks --------------------------------------------------------


def bronze_load(spark: SparkSession, data_dir: str) -> DataFrame:
    """All eight tables landed and read back: rows and sum of keys per table."""
    lake = _new_lake(spark, "bronze_load")
    medallion.land_bronze(spark, bank_tables(spark, data_dir), lake, RUN_TIME)
    return quality.union_all(
        [
            df.agg(
                F.count(F.lit(1)).alias("record_count"),
                F.sum(TABLES[name].primary_key).alias("key_total"),
            ).withColumn("table_name", F.lit(name))
            for name, df in medallion.bronze_tables(spark, lake).items()
        ]
    )


def bronze_load_messy(spark: SparkSession, data_dir: str) -> DataFrame:
    """Accounts landed from padded upper-case names, with a column more and two fewer."""
    lake = _new_lake(spark, "bronze_load_messy")
    accounts = bank_table(spark, data_dir, "accounts").drop("status", "opened_date")
    note = F.concat(F.lit("  branch "), (F.col("account_id") % 7).cast("string"))
    noted = accounts.withColumn("branch_note", note)
    messy = noted.toDF(*[f" {name.upper()} " for name in noted.columns])
    medallion.land_bronze(spark, {"accounts": messy}, lake, RUN_TIME)
    return medallion.bronze_table(spark, lake, "accounts")


def save_roundtrip(spark: SparkSession, data_dir: str) -> DataFrame:
    """A Silver table saved to the catalog and read back."""
    lake = _new_lake(spark, "save_roundtrip")
    database = lake.database("scratch")
    create_database(spark, database, lake)
    save_table(silver(spark, data_dir, "credit_cards"), f"{database}.cards", lake)
    return read_table(spark, f"{database}.cards")


def lakehouse_refresh(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bronze landed, then Silver and Gold rebuilt: rows per table."""
    lake = _new_lake(spark, "lakehouse_refresh")
    medallion.land_bronze(spark, bank_tables(spark, data_dir), lake, RUN_TIME)
    return medallion.refresh_lakehouse(spark, lake)


def sample_cards(spark: SparkSession, data_dir: str) -> DataFrame:
    return sample_rows(bank_table(spark, data_dir, "credit_cards"), 1000, "card_id")


def sample_repayments(spark: SparkSession, data_dir: str) -> DataFrame:
    repayments = bank_table(spark, data_dir, "loan_repayments")
    return sample_rows(repayments, 500, *repayments.columns)


# --- cleaning -----------------------------------------------------------------


def clean_names(spark: SparkSession, data_dir: str) -> DataFrame:
    customers = bank_table(spark, data_dir, "customers")
    return cleaning.clean_names(customers.toDF(*[f" {c.upper()}\t" for c in customers.columns]))


def trim_strings(spark: SparkSession, data_dir: str) -> DataFrame:
    return cleaning.trim_strings(bank_table(spark, data_dir, "customers"))


def mask_pii(spark: SparkSession, data_dir: str) -> DataFrame:
    return cleaning.mask_pii(bank_table(spark, data_dir, "customers"))


def blank_to_null(spark: SparkSession, data_dir: str) -> DataFrame:
    return cleaning.blank_to_null(bank_table(spark, data_dir, "fraud_alerts"))


def dedup_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Customers replayed with other padding; cleaning makes the copies equal."""
    customers = bank_table(spark, data_dir, "customers")
    replayed = customers.withColumn("first_name", F.concat("first_name", F.lit(" ")))
    return cleaning.clean_table(customers.unionByName(replayed))


def dedup_repeated_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    """Silver transactions, with only the rows of repeated keys shuffled."""
    transactions = bank_table(spark, data_dir, "transactions")
    return dedup_by_key(transactions, "transaction_id", cleaning.clean_columns)


def _replayed_accounts(spark: SparkSession, data_dir: str, replayed: Column) -> DataFrame:
    """Accounts and, once more with other padding, those of a replayed batch."""
    accounts = bank_table(spark, data_dir, "accounts")
    padded = F.concat(F.lit(" "), F.col("account_type"))
    return accounts.unionByName(accounts.where(replayed).withColumn("account_type", padded))


def dedup_unique_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    """No key repeats: no row is shuffled."""
    accounts = bank_table(spark, data_dir, "accounts")
    return dedup_by_key(accounts, "account_id", cleaning.clean_columns)


def dedup_few_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    """One account in a hundred replayed: only rows of these keys are shuffled."""
    accounts = _replayed_accounts(spark, data_dir, F.col("account_id") % 100 == 0)
    return dedup_by_key(accounts, "account_id", cleaning.clean_columns)


def dedup_key_blocks(spark: SparkSession, data_dir: str) -> DataFrame:
    """A run of neighbouring accounts replayed, told apart by blocks of 256 keys."""
    accounts = _replayed_accounts(spark, data_dir, F.col("account_id").between(256, 511))
    return dedup_by_key(
        accounts, "account_id", cleaning.clean_columns, broadcast_keys=4, block_bits=8
    )


# --- functions, joins and aggregates ------------------------------------------


def month_trunc(spark: SparkSession, data_dir: str) -> DataFrame:
    return bank_table(spark, data_dir, "transactions").select(
        "transaction_id",
        "account_id",
        month_of(F.col("transaction_timestamp")).cast("timestamp_ntz").alias("transaction_month"),
    )


def round_half_up(spark: SparkSession, data_dir: str) -> DataFrame:
    share = F.col("current_balance") * F.lit("0.125").cast("decimal(4,3)")
    return bank_table(spark, data_dir, "accounts").select(
        "account_id", F.round(share, 2).cast("decimal(18,2)").alias("eighth")
    )


def coalesce_zero(spark: SparkSession, data_dir: str) -> DataFrame:
    return bank_table(spark, data_dir, "accounts").select(
        "account_id", money_or_zero(F.col("current_balance")).alias("balance_or_zero")
    )


def left_join_accounts(spark: SparkSession, data_dir: str) -> DataFrame:
    customers = silver(spark, data_dir, "customers").select("customer_uuid", "city", "country")
    accounts = silver(spark, data_dir, "accounts").select(
        "customer_uuid", "account_id", "current_balance"
    )
    return left_join(customers, accounts, "customer_uuid")


def left_joined_chain(spark: SparkSession, data_dir: str) -> DataFrame:
    customers = silver(spark, data_dir, "customers").select("customer_uuid", "city", "country")
    accounts = silver(spark, data_dir, "accounts").select(
        "customer_uuid", "account_id", "current_balance"
    )
    scores = silver(spark, data_dir, "credit_scores").select(
        "customer_uuid", "score_id", "bureau_score", "risk_rating"
    )
    return left_join_chain(customers, [accounts, scores], "customer_uuid")


def count_nonnull(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "transactions")
        .groupBy("transaction_type", "transaction_city")
        .agg(F.count("amount").alias("amounts"), F.count(F.lit(1)).alias("all_rows"))
    )


def count_distinct(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "transactions")
        .groupBy("transaction_type", "channel")
        .agg(F.countDistinct("account_id").alias("active_accounts"))
    )


def sum_decimal(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "accounts")
        .groupBy("customer_uuid")
        .agg(F.sum("current_balance").alias("balance"))
    )


def avg_decimal(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "transactions")
        .groupBy("transaction_type", "transaction_city")
        .agg(F.round(F.avg("amount"), 2).alias("avg_amount"))
    )


def avg_int(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "fraud_alerts")
        .groupBy("status")
        .agg(F.round(F.avg("risk_score"), 2).alias("avg_risk_score"))
    )


def max_numeric(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        bank_table(spark, data_dir, "credit_scores")
        .groupBy("delinquency_history_count")
        .agg(
            F.max("bureau_score").alias("max_score"),
            F.max("debt_to_income_ratio").alias("max_dti"),
        )
    )


def max_string(spark: SparkSession, data_dir: str) -> DataFrame:
    """The last rating in the alphabet, not the highest risk."""
    return (
        silver(spark, data_dir, "credit_scores")
        .groupBy("delinquency_history_count")
        .agg(F.max("risk_rating").alias("max_rating"))
    )


# --- marts and pages ----------------------------------------------------------


def mart_transactions(spark: SparkSession, data_dir: str) -> DataFrame:
    """The mart, its month without a zone so that both engines show it alike."""
    mart = _mart(spark, data_dir, "transactions")
    return mart.withColumn("transaction_month", F.col("transaction_month").cast("timestamp_ntz"))


def page_overview(spark: SparkSession, data_dir: str) -> DataFrame:
    return pages.page_overview(_mart(spark, data_dir, "financial_health"))


def page_transactions(spark: SparkSession, data_dir: str) -> DataFrame:
    page = pages.page_transactions(
        marts.transaction_totals(silver(spark, data_dir, "transactions"))
    )
    return page.withColumn("transaction_month", F.col("transaction_month").cast("timestamp_ntz"))


def page_loans(spark: SparkSession, data_dir: str) -> DataFrame:
    return pages.page_loans(_mart(spark, data_dir, "loans_exact"))


def page_fraud(spark: SparkSession, data_dir: str) -> DataFrame:
    return pages.page_fraud(marts.fraud_totals(silver(spark, data_dir, "fraud_alerts")))


# --- audits and rules ---------------------------------------------------------


def _on_bronze(audit: Callable[[quality.Tables], DataFrame]) -> Query:
    return lambda spark, data_dir: audit(bank_tables(spark, data_dir))


def audit_not_null(spark: SparkSession, data_dir: str) -> DataFrame:
    """On cleaned Bronze rows, where a blank in a required column has become null."""
    cleaned = {
        name: cleaning.clean_columns(df) for name, df in bank_tables(spark, data_dir).items()
    }
    return quality.audit_not_null(cleaned)


def broken_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    """All declared rules of a run, lengths on Bronze and the others on Silver."""
    lake = _new_lake(spark, "broken_rules")
    return medallion.bronze_broken_rules(spark, bank_tables(spark, data_dir), lake)


def apply_defaults(spark: SparkSession, data_dir: str) -> DataFrame:
    accounts = bank_table(spark, data_dir, "accounts").drop("status", "opened_date")
    return quality.apply_defaults(accounts, TABLES["accounts"], RUN_TIME)


def with_risk_band(spark: SparkSession, data_dir: str) -> DataFrame:
    return bank_table(spark, data_dir, "credit_scores").select(
        "score_id", "bureau_score", risk_band(F.col("bureau_score")).alias("risk_band")
    )


def mask_card(spark: SparkSession, data_dir: str) -> DataFrame:
    """Card numbers made of a fixed digit and the card's key, then masked."""
    number = F.concat(F.lit("4"), F.lpad(F.col("card_id").cast("string"), 15, "0"))
    return bank_table(spark, data_dir, "credit_cards").select(
        "card_id", masked_card(number).alias("card_number_masked")
    )


def cap_amount(spark: SparkSession, data_dir: str) -> DataFrame:
    return bank_table(spark, data_dir, "transactions").select(
        "transaction_id", "account_id", capped(F.col("amount")).alias("amount")
    )


def instalment_split(spark: SparkSession, data_dir: str) -> DataFrame:
    loans = bank_table(spark, data_dir, "loan_applications").select(
        "loan_id", "principal_amount", "interest_rate", "term_months"
    )
    return lending.instalment_split(loans)


def repayment_schedule(spark: SparkSession, data_dir: str) -> DataFrame:
    """Two to eleven payments per loan, none for a loan without a principal."""
    payments = F.when(F.col("principal_amount").isNull(), 0).otherwise(2 + F.col("loan_id") % 10)
    loans = bank_table(spark, data_dir, "loan_applications").select(
        "loan_id", "start_date", payments.alias("payments")
    )
    return lending.repayment_schedule(loans, "start_date", "payments")


def audit_product_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    broken = lending.product_rule_violations(bank_table(spark, data_dir, "accounts"))
    return broken.select("account_id", "account_type", "broken_rule")


def dirt_profile(spark: SparkSession, data_dir: str) -> DataFrame:
    return profile.dirt_profile(bank_table(spark, data_dir, "transactions"))


def canonical_case(spark: SparkSession, data_dir: str) -> DataFrame:
    transactions = bank_table(spark, data_dir, "transactions").select(
        "transaction_id", "account_id", "spending_sector"
    )
    return profile.canonical_case(transactions, "spending_sector", SPENDING_SECTORS)


def canonical_case_table(spark: SparkSession, data_dir: str) -> DataFrame:
    customers = bank_table(spark, data_dir, "customers").select("customer_id", "city")
    nation = given_table(spark, data_dir, "nation")
    return profile.canonical_case_from(customers, "city", nation, "n_name")


def canonical_case_learned(spark: SparkSession, data_dir: str) -> DataFrame:
    """Sectors in the spelling that most transactions have."""
    transactions = bank_table(spark, data_dir, "transactions").select(
        "transaction_id", "account_id", "spending_sector"
    )
    return profile.canonical_case_learned(transactions, "spending_sector")


def learned_spellings(spark: SparkSession, data_dir: str) -> DataFrame:
    return profile.learned_spellings(bank_table(spark, data_dir, "transactions"), "spending_sector")


def alert_rate(spark: SparkSession, data_dir: str) -> DataFrame:
    return lending.alert_rate(
        bank_table(spark, data_dir, "fraud_alerts"), bank_table(spark, data_dir, "transactions")
    )


QUERIES: dict[str, Query] = {
    "bronze_load": bronze_load,
    "bronze_load_messy": bronze_load_messy,
    "save_roundtrip": save_roundtrip,
    "lakehouse_refresh": lakehouse_refresh,
    "sample_rows": sample_cards,
    "sample_repayments": sample_repayments,
    "clean_names": clean_names,
    "trim_strings": trim_strings,
    "mask_pii": mask_pii,
    "blank_to_null": blank_to_null,
    "dedup_rows": dedup_rows,
    "dedup_by_key": dedup_repeated_keys,
    "dedup_by_key_unique": dedup_unique_keys,
    "dedup_by_key_replay": dedup_few_keys,
    "dedup_by_key_blocks": dedup_key_blocks,
    **{f"silver_{name}": partial(silver, name=name) for name in TABLES},
    "month_trunc": month_trunc,
    "round_half_up": round_half_up,
    "coalesce_zero": coalesce_zero,
    "left_join_accounts": left_join_accounts,
    "left_join_chain": left_joined_chain,
    "count_nonnull": count_nonnull,
    "count_distinct": count_distinct,
    "sum_decimal": sum_decimal,
    "avg_decimal": avg_decimal,
    "avg_int": avg_int,
    "max_numeric": max_numeric,
    "max_string": max_string,
    "mart_financial_health": partial(_mart, mart="financial_health"),
    "mart_transactions": mart_transactions,
    "mart_loans": partial(_mart, mart="loans"),
    "mart_loans_exact": partial(_mart, mart="loans_exact"),
    "mart_fraud": partial(_mart, mart="fraud"),
    "row_counts": _on_bronze(quality.row_counts),
    "row_counts_sorted": _on_bronze(quality.row_counts_sorted),
    "audit_not_null": audit_not_null,
    "broken_rules": broken_rules,
    "audit_unique": _on_bronze(quality.audit_unique),
    "audit_fk": _on_bronze(quality.audit_fk),
    "audit_check": _on_bronze(quality.audit_check),
    "audit_length": _on_bronze(quality.audit_length),
    "audit_orphans": _on_bronze(quality.audit_orphans),
    "apply_defaults": apply_defaults,
    "risk_band": with_risk_band,
    "mask_card": mask_card,
    "instalment_split": instalment_split,
    "repayment_schedule": repayment_schedule,
    "cap_amount": cap_amount,
    "audit_product_rules": audit_product_rules,
    "dirt_profile": dirt_profile,
    "canonical_case": canonical_case,
    "canonical_case_table": canonical_case_table,
    "canonical_case_learned": canonical_case_learned,
    "learned_spellings": learned_spellings,
    "alert_rate": alert_rate,
    "page_overview": page_overview,
    "page_transactions": page_transactions,
    "page_loans": page_loans,
    "page_fraud": page_fraud,
}
