"""Banking rules as column expressions. All JVM-side, all null-preserving."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rating bands (a score above the bound earns the label), the
# card mask and the transaction cap. They must equal the source's rules.
RISK_BANDS = ((740, "Excellent"), (670, "Good"), (580, "Fair"))
LOWEST_BAND = "Poor"
CARD_MASK = "****-****-****-"
AMOUNT_CAP = Decimal("15000.00")

MONEY = "decimal(12,2)"


def risk_band(score: Column) -> Column:
    """Rating label of a bureau score (R1); null score, null band."""
    band = F.when(score.isNull(), F.lit(None).cast("string"))
    for above, label in RISK_BANDS:
        band = band.when(score > above, label)
    return band.otherwise(LOWEST_BAND)


def masked_card(number: Column) -> Column:
    """Card number reduced to its last four digits (R2)."""
    return F.concat(F.lit(CARD_MASK), F.right(number, F.lit(4)))


def capped(amount: Column, cap: Decimal = AMOUNT_CAP) -> Column:
    """Amount limited to ``cap`` (R5). ``least`` skips nulls, hence the guard."""
    limit = F.lit(cap).cast(MONEY)
    return F.when(amount.isNotNull(), F.least(amount.cast(MONEY), limit))


def instalment(principal: Column, term: Column) -> Column:
    """Even instalment: principal over the number of months, to the penny."""
    return F.round(principal / term.cast("decimal(10,0)"), 2).cast(MONEY)


def interest_part(amount: Column, annual_rate: Column) -> Column:
    """One month's interest on an instalment at a yearly rate in percent."""
    return F.round(amount * annual_rate / F.lit(1200).cast("decimal(4,0)"), 2).cast(MONEY)


def month_of(moment: Column) -> Column:
    """First instant of the month, as a timestamp."""
    return F.date_trunc("month", moment)


def money_or_zero(total: Column) -> Column:
    """A total that is zero, not null, for a group with nothing to add."""
    return F.round(F.coalesce(total, F.lit(0)), 2)
