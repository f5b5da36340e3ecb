"""Bronze to Silver cleaning.

A table is cleaned in this order: names, trim, mask, blank to null, dedup. The
order is part of the meaning: masking comes before blank-to-null, so a blank
personal value becomes the digest of the empty string, not null.

Each function builds one ``select``: all column work is a single projection
in one codegen stage, however many columns there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField

from lakemarts.functions.text import blank_to_null as blank_expr
from lakemarts.functions.text import masked, quoted, trimmed

# A column is personal when its name contains one of these.
PII_TERMS = (
    "email",
    "first_name",
    "last_name",
    "customer_name",
    "full_name",
    "phone_number",
    "ssn",
)

BLANK_PII_CHOICES = ("hash", "null")


def clean_names(df: DataFrame) -> DataFrame:
    """Column names stripped of white space and lower-cased."""
    names = [name.strip().lower() for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        sources = [old for old, new in zip(df.columns, names) if new in clashes]
        raise ValueError(f"columns {sources} collide after cleaning: {clashes}")
    return df.toDF(*names)


def string_columns(df: DataFrame) -> list[str]:
    """Names of all string columns."""
    return [f.name for f in df.schema.fields if _is_string(f)]


def pii_columns(df: DataFrame, terms: Iterable[str] = PII_TERMS) -> list[str]:
    """Names that contain one of ``terms`` (P4), checked to be maskable."""
    terms = tuple(terms)
    found = [f for f in df.schema.fields if any(term in f.name for term in terms)]
    unfit = [
        f"{f.name} ({f.dataType.simpleString()})"
        for f in found
        if not isinstance(f.dataType, (StringType, BinaryType))
    ]
    if unfit:
        raise ValueError(
            f"only text can be masked, but these columns are named like personal data: {unfit}"
        )
    return [f.name for f in found]


def trim_strings(df: DataFrame) -> DataFrame:
    """Every string column trimmed of spaces."""
    return _project(df, string_columns(df), trimmed)


def mask_pii(
    df: DataFrame, terms: Iterable[str] = PII_TERMS, salt: str | None = None
) -> DataFrame:
    """Personal columns replaced by their SHA-256 digest (P5)."""
    return _project(df, pii_columns(df, terms), lambda value: masked(value, salt))


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings replaced by null in every string column."""
    return _project(df, string_columns(df), blank_expr)


def clean_columns(
    df: DataFrame,
    *,
    pii_terms: Iterable[str] = PII_TERMS,
    blank_pii: str = "hash",
    salt: str | None = None,
) -> DataFrame:
    """Names, trim, mask and blank-to-null (P1-P6) as one projection.

    ``blank_pii="null"`` turns a blank personal value into null in place of the
    digest of the empty string.
    """
    if blank_pii not in BLANK_PII_CHOICES:
        raise ValueError(f"blank_pii must be one of {BLANK_PII_CHOICES}, not {blank_pii!r}")
    renamed = clean_names(df)
    personal = set(pii_columns(renamed, pii_terms))

    def cleaned(field: StructField) -> Column:
        value = quoted(field.name)
        is_text = _is_string(field)
        if is_text:
            value = trimmed(value)
        if field.name in personal:
            if is_text and blank_pii == "null":
                value = blank_expr(value)
            value = masked(value, salt)
        elif is_text:
            value = blank_expr(value)
        return value.alias(field.name)

    return renamed.select(*[cleaned(field) for field in renamed.schema.fields])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Equal rows reduced to one (P7); nulls, NaNs and signed zeros are equal.

    Rows are hashed on all columns and copies are dropped map-side before the
    shuffle, so one row repeated any number of times is no hot spot.
    """
    return df.dropDuplicates()


def clean_table(df: DataFrame, **options) -> DataFrame:
    """The whole cleaning step."""
    return dedup_rows(clean_columns(df, **options))


def _is_string(field: StructField) -> bool:
    return isinstance(field.dataType, StringType)


def _project(df: DataFrame, chosen: Sequence[str], change) -> DataFrame:
    chosen = set(chosen)
    return df.select(
        *[
            change(quoted(name)).alias(name) if name in chosen else quoted(name)
            for name in df.columns
        ]
    )
