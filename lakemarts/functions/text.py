"""String column expressions used by the Silver cleaning step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column called exactly ``name``, also when it holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(value: Column) -> Column:
    """Leading and trailing spaces removed (F1). Only spaces: a tab survives."""
    return F.trim(value)


def masked(value: Column, salt: str | None = None) -> Column:
    """SHA-256 hex digest (F2); null stays null.

    ``salt`` is put in front of the value. Without one the digest equals the
    plain SHA-256, which short values such as first names do not withstand a
    dictionary against; with one, only tables masked with the same salt join.
    """
    return F.sha2(value if salt is None else F.concat(F.lit(salt), value), 256)


def blank_to_null(value: Column) -> Column:
    """The empty string becomes null."""
    return F.nullif(value, F.lit(""))


def case_key(value: Column) -> Column:
    """The key under which spellings of one value meet: trimmed and lower case."""
    return F.lower(F.trim(value))
