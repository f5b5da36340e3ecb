"""The eight bank tables, declared as data.

Everything generic in the library (landing, cleaning, auditing) is driven by
these specs, so a new source table is a new entry here and no new code.
UUID, VARCHAR and TEXT are Spark strings; a timestamp without a zone is
TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

CORE_BANKING = "core_banking"
CREDIT_LOANS = "credit_loans"

#: Markers for defaults that are the time of the load, given by the caller.
RUN_DATE = "<run date>"
RUN_TIMESTAMP = "<run timestamp>"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class ValueRange:
    column: str
    low: int
    high: int


@dataclass(frozen=True)
class TableSpec:
    name: str
    domain: str
    types: Mapping[str, DataType]
    primary_key: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    #: References into the other domain, which no source database can enforce.
    soft_keys: tuple[ForeignKey, ...] = ()
    ranges: tuple[ValueRange, ...] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType(
            [StructField(name, kind, name not in self.required) for name, kind in self.types.items()]
        )

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def required(self) -> tuple[str, ...]:
        """Primary key first, then the other NOT NULL columns."""
        return (self.primary_key, *self.not_null)

    @property
    def unique_keys(self) -> tuple[str, ...]:
        return (self.primary_key, *self.unique)


INT, LONG, TEXT = IntegerType(), LongType(), StringType()
DATE, MOMENT = DateType(), TimestampNTZType()


def decimal(digits: int) -> DecimalType:
    """Money and rates: two of the digits are after the point."""
    return DecimalType(digits, 2)


# Column names, types, keys, limits and defaults of the source
# database. They must equal the source for right results.
_SPECS = (
    TableSpec(
        name="customers",
        domain=CORE_BANKING,
        types=dict(
            customer_id=INT,
            customer_uuid=TEXT,
            first_name=TEXT,
            last_name=TEXT,
            email=TEXT,
            phone_number=TEXT,
            date_of_birth=DATE,
            city=TEXT,
            postcode=TEXT,
            country=TEXT,
            employment_status=TEXT,
            annual_income=decimal(12),
            customer_segment=TEXT,
            created_at=MOMENT,
        ),
        primary_key="customer_id",
        unique=("customer_uuid",),
        not_null=("customer_uuid", "first_name", "last_name"),
        lengths={
            "first_name": 50,
            "last_name": 50,
            "email": 100,
            "phone_number": 30,
            "city": 50,
            "postcode": 15,
            "country": 50,
            "employment_status": 30,
            "customer_segment": 30,
        },
        defaults={"country": "United Kingdom", "created_at": RUN_TIMESTAMP},
    ),
    TableSpec(
        name="accounts",
        domain=CORE_BANKING,
        types=dict(
            account_id=INT,
            account_uuid=TEXT,
            customer_uuid=TEXT,
            account_type=TEXT,
            interest_rate_apr=decimal(5),
            monthly_maintenance_fee=decimal(6),
            current_balance=decimal(15),
            currency=TEXT,
            status=TEXT,
            opened_date=DATE,
        ),
        primary_key="account_id",
        unique=("account_uuid",),
        not_null=("account_uuid", "customer_uuid", "account_type"),
        foreign_keys=(ForeignKey("customer_uuid", "customers", "customer_uuid"),),
        lengths={"account_type": 30, "currency": 3, "status": 20},
        defaults={"currency": "GBP", "status": "Active", "opened_date": RUN_DATE},
    ),
    TableSpec(
        name="transactions",
        domain=CORE_BANKING,
        types=dict(
            transaction_id=LONG,
            account_id=INT,
            transaction_type=TEXT,
            amount=decimal(12),
            running_balance=decimal(15),
            merchant_name=TEXT,
            spending_sector=TEXT,
            channel=TEXT,
            transaction_city=TEXT,
            transaction_timestamp=MOMENT,
            status=TEXT,
        ),
        primary_key="transaction_id",
        not_null=("account_id", "transaction_type", "transaction_timestamp"),
        foreign_keys=(ForeignKey("account_id", "accounts", "account_id"),),
        lengths={
            "transaction_type": 30,
            "merchant_name": 100,
            "spending_sector": 50,
            "channel": 30,
            "transaction_city": 50,
            "status": 20,
        },
        defaults={"status": "Completed"},
    ),
    TableSpec(
        name="fraud_alerts",
        domain=CORE_BANKING,
        types=dict(
            alert_id=INT,
            transaction_id=LONG,
            customer_uuid=TEXT,
            alert_type=TEXT,
            risk_score=INT,
            status=TEXT,
            resolution_notes=TEXT,
            flagged_at=MOMENT,
        ),
        primary_key="alert_id",
        not_null=("transaction_id", "customer_uuid", "alert_type"),
        foreign_keys=(
            ForeignKey("transaction_id", "transactions", "transaction_id"),
            ForeignKey("customer_uuid", "customers", "customer_uuid"),
        ),
        ranges=(ValueRange("risk_score", 0, 100),),
        lengths={"alert_type": 50, "status": 30},
        defaults={"status": "Under Review", "flagged_at": RUN_TIMESTAMP},
    ),
    TableSpec(
        name="credit_scores",
        domain=CREDIT_LOANS,
        types=dict(
            score_id=INT,
            customer_uuid=TEXT,
            bureau_score=INT,
            risk_rating=TEXT,
            delinquency_history_count=INT,
            debt_to_income_ratio=decimal(5),
            last_updated=DATE,
        ),
        primary_key="score_id",
        unique=("customer_uuid",),
        not_null=("customer_uuid",),
        soft_keys=(ForeignKey("customer_uuid", "customers", "customer_uuid"),),
        ranges=(ValueRange("bureau_score", 300, 850),),
        lengths={"risk_rating": 20},
        defaults={"delinquency_history_count": "0", "last_updated": RUN_DATE},
    ),
    TableSpec(
        name="credit_cards",
        domain=CREDIT_LOANS,
        types=dict(
            card_id=INT,
            card_number_masked=TEXT,
            customer_uuid=TEXT,
            credit_limit=decimal(12),
            current_balance=decimal(12),
            apr=decimal(5),
            card_status=TEXT,
        ),
        primary_key="card_id",
        not_null=("card_number_masked", "customer_uuid"),
        soft_keys=(ForeignKey("customer_uuid", "customers", "customer_uuid"),),
        lengths={"card_number_masked": 20, "card_status": 20},
        defaults={"card_status": "Active"},
    ),
    TableSpec(
        name="loan_applications",
        domain=CREDIT_LOANS,
        types=dict(
            loan_id=INT,
            customer_uuid=TEXT,
            loan_type=TEXT,
            principal_amount=decimal(15),
            interest_rate=decimal(5),
            term_months=INT,
            start_date=DATE,
            loan_status=TEXT,
        ),
        primary_key="loan_id",
        not_null=("customer_uuid", "loan_type", "term_months"),
        soft_keys=(ForeignKey("customer_uuid", "customers", "customer_uuid"),),
        lengths={"loan_type": 40, "loan_status": 20},
        defaults={"start_date": RUN_DATE, "loan_status": "Active"},
    ),
    TableSpec(
        name="loan_repayments",
        domain=CREDIT_LOANS,
        types=dict(
            repayment_id=LONG,
            loan_id=INT,
            payment_date=MOMENT,
            amount_paid=decimal(12),
            principal_component=decimal(12),
            interest_component=decimal(12),
            late_fee_applied=decimal(8),
        ),
        primary_key="repayment_id",
        not_null=("loan_id", "payment_date"),
        foreign_keys=(ForeignKey("loan_id", "loan_applications", "loan_id"),),
        defaults={"late_fee_applied": "0.00"},
    ),
)

TABLES: Mapping[str, TableSpec] = MappingProxyType({spec.name: spec for spec in _SPECS})
