"""Audits of the source database's rules as Spark jobs (Q1-Q8).

The lake enforces no keys, references, ranges or lengths, so they are counted.
All audits are driven by the table specs. Row rules of one table are counted in
a single scan, or without one while the table is written; key rules read only the key
columns and aggregate them before the shuffle, so that a key held by a third of all rows
is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lakemarts.functions.text import quoted
from lakemarts.schemas import (
    RUN_DATE,
    RUN_TIMESTAMP,
    TABLES,
    ForeignKey,
    TableSpec,
)

Tables = Mapping[str, DataFrame]


def union_all(frames: Sequence[DataFrame], schema: str = "") -> DataFrame:
    """UNION ALL by column name (O1); of no frames, an empty one of ``schema``."""
    if not frames:
        return SparkSession.active().createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


# --- row counts ---------------------------------------------------------------


def row_counts(tables: Tables) -> DataFrame:
    """``table_name, record_count``, one row per table (Q1, A3, O1)."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, df in tables.items()
        ],
        "table_name string, record_count bigint",
    )


def row_counts_sorted(tables: Tables) -> DataFrame:
    """Row counts, largest table first (O2)."""
    return row_counts(tables).orderBy(F.desc("record_count"), "table_name")


# --- rules on single rows -----------------------------------------------------


def not_null_rules(spec: TableSpec) -> dict[str, Column]:
    return {name: quoted(name).isNull() for name in spec.required}


def range_rules(spec: TableSpec) -> dict[str, Column]:
    """A null passes, as it does in an SQL CHECK."""
    return {r.column: ~quoted(r.column).between(r.low, r.high) for r in spec.ranges}


def length_rules(spec: TableSpec) -> dict[str, Column]:
    return {name: F.length(quoted(name)) > limit for name, limit in spec.lengths.items()}


#: Rules that look at one row at a time, by kind.
ROW_RULES = {"not null": not_null_rules, "range": range_rules, "length": length_rules}


def audit_not_null(tables: Tables) -> DataFrame:
    """NOT NULL (Q2): ``table_name, column_name, violations``."""
    return audit_rows(tables, "not null").drop("rule")


def audit_check(tables: Tables) -> DataFrame:
    """CHECK ranges (Q5): ``table_name, column_name, violations``."""
    return audit_rows(tables, "range").drop("rule")


def audit_length(tables: Tables) -> DataFrame:
    """VARCHAR lengths (Q6). Meant for Bronze: a digest outgrows a name column."""
    return audit_rows(tables, "length").drop("rule")


def audit_rows(tables: Tables, *kinds: str) -> DataFrame:
    """Row rules of several kinds: ``rule, table_name, column_name, violations``.

    Each table is scanned once, for all of its rules.
    """
    counts = []
    for name, df in tables.items():
        rules = _rules_of(name, kinds)
        if rules:
            counts.append(_violation_counts(name, df, rules))
    return union_all(counts, METRICS_SCHEMA)


class RowMetrics:
    """Row rules and the row count of a table, counted while its rows are written.

    ``rows`` has to be what is written, with nothing shuffled in between: then each row is
    counted in the task that writes it, and a task that ran twice counts once.
    """

    def __init__(self, name: str, df: DataFrame, *kinds: str):
        self._name = name
        self._rules = _rules_of(name, kinds)
        self._observation = Observation()
        counts = [F.count_if(broken).alias("/".join(rule)) for rule, broken in self._rules.items()]
        self.rows = df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *counts)

    def found(self) -> list[tuple[str, str, str, int]]:
        """After the write: (rule, table, column, violations), and the rows as rule ``rows``."""
        counts = self._observation.get
        return [("rows", self._name, "", counts["rows"])] + [
            (kind, self._name, column, counts[f"{kind}/{column}"]) for kind, column in self._rules
        ]


METRICS_SCHEMA = "rule string, table_name string, column_name string, violations bigint"


def _rules_of(name: str, kinds: Sequence[str]) -> dict[tuple[str, str], Column]:
    return {
        (kind, column): broken
        for kind in kinds
        for column, broken in ROW_RULES[kind](TABLES[name]).items()
    }


def check_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of ``df`` outside a declared range."""
    rules = list(range_rules(spec).values())
    return df.where(reduce(Column.__or__, rules)) if rules else df.where(F.lit(False))


def _violation_counts(
    name: str, df: DataFrame, rules: Mapping[tuple[str, str], Column]
) -> DataFrame:
    """All rules of one table in one aggregate, then one row per rule."""
    labels = ["/".join(rule) for rule in rules]
    counted = df.agg(*[F.count_if(broken).alias(n) for n, broken in zip(labels, rules.values())])
    per_rule = counted.unpivot([], [quoted(label) for label in labels], "label", "violations")
    return per_rule.select(
        F.split_part("label", F.lit("/"), F.lit(1)).alias("rule"),
        F.lit(name).alias("table_name"),
        F.split_part("label", F.lit("/"), F.lit(2)).alias("column_name"),
        "violations",
    )


# --- uniqueness ---------------------------------------------------------------


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count. Nulls do not clash."""
    return (
        df.where(quoted(key).isNotNull())
        .groupBy(quoted(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("key_rows"))
        .where("key_rows > 1")
    )


def audit_unique(tables: Tables) -> DataFrame:
    """PRIMARY KEY and UNIQUE (Q3).

    ``table_name, column_name, repeated_keys, surplus_rows``. Each table is scanned once:
    its keys become rows of (column, value) and are counted together.
    """
    return union_all(
        [_repeated_keys(name, df, TABLES[name].unique_keys) for name, df in tables.items()],
        "table_name string, column_name string, repeated_keys bigint, surplus_rows bigint",
    )


def _repeated_keys(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    def cell(key: str) -> Column:
        # Whole numbers stay numbers, which shuffle shorter than their text.
        whole = isinstance(df.schema[key].dataType, IntegralType)
        return F.struct(
            F.lit(key).alias("column_name"),
            (quoted(key) if whole else F.lit(None)).cast("bigint").alias("number"),
            (F.lit(None) if whole else quoted(key)).cast("string").alias("text"),
        )

    counted = (
        df.select(F.inline(F.array(*[cell(key) for key in keys])))
        .where("number IS NOT NULL OR text IS NOT NULL")
        .groupBy("column_name", "number", "text")
        .agg(F.count(F.lit(1)).alias("key_rows"))
        .where("key_rows > 1")
    )

    def surplus(key: str) -> Column:
        return F.sum(F.when(F.col("column_name") == key, F.col("key_rows") - 1))

    totals = counted.agg(
        *[F.count_if(F.col("column_name") == key).alias(f"keys_{n}") for n, key in enumerate(keys)],
        *[F.coalesce(surplus(key), F.lit(0)).alias(f"rows_{n}") for n, key in enumerate(keys)],
    )
    found = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("column_name"),
            F.col(f"keys_{n}").alias("repeated_keys"),
            F.col(f"rows_{n}").alias("surplus_rows"),
        )
        for n, key in enumerate(keys)
    ]
    return totals.select(F.inline(F.array(*found)))


# --- references ---------------------------------------------------------------


def orphan_keys(child: DataFrame, reference: ForeignKey, parent: DataFrame) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their row count.

    Both sides are reduced to one row per key first.
    """
    used = (
        child.where(quoted(reference.column).isNotNull())
        .groupBy(quoted(reference.column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("key_rows"))
    )
    known = parent.select(quoted(reference.parent_column).alias("key_value")).distinct()
    return used.join(known, "key_value", "left_anti")


#: Kinds of references: enforced within a domain, and across domains.
REFERENCES = {"foreign key": lambda spec: spec.foreign_keys, "orphan": lambda spec: spec.soft_keys}
_REFERENCE_SCHEMA = (
    "rule string, table_name string, column_name string, parent_table string,"
    " orphan_keys bigint, orphan_rows bigint"
)


def audit_fk(tables: Tables) -> DataFrame:
    """FOREIGN KEY within a domain (Q4).

    ``table_name, column_name, parent_table, orphan_keys, orphan_rows``.
    """
    return audit_references(tables, "foreign key").drop("rule")


def audit_orphans(tables: Tables) -> DataFrame:
    """References across domains (Q8), same columns as :func:`audit_fk`."""
    return audit_references(tables, "orphan").drop("rule")


def audit_references(tables: Tables, *kinds: str) -> DataFrame:
    """References of several kinds: the columns of :func:`audit_fk` and their ``rule``.

    One pass per parent key: the keys of the parent and of all its children are tagged,
    put together and counted by key, so all references to one parent cost one shuffle of
    a row per key and task, however many tables refer to it.
    """
    children: dict[tuple[str, str], list[tuple[str, str, str]]] = {}
    for kind in kinds:
        for name in tables:
            for ref in REFERENCES[kind](TABLES[name]):
                if ref.parent not in tables:
                    raise ValueError(f"the references of {name} need the table {ref.parent}")
                parent = children.setdefault((ref.parent, ref.parent_column), [])
                parent.append((kind, name, ref.column))
    return union_all(
        [_orphans_of(tables, *parent, refs) for parent, refs in children.items()], _REFERENCE_SCHEMA
    )


def _orphans_of(
    tables: Tables, parent: str, parent_column: str, references: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Orphans of all references to one parent key."""
    kind = tables[parent].schema[parent_column].dataType

    def keys(name: str, column: str, tag: int) -> DataFrame:
        key = quoted(column)
        rows = tables[name].where(key.isNotNull())
        return rows.select(key.cast(kind).alias("key_value"), F.lit(tag).alias("tag"))

    tagged = [keys(parent, parent_column, -1)]
    tagged += [keys(name, column, tag) for tag, (_, name, column) in enumerate(references)]
    rows = [f"rows_{tag}" for tag in range(len(references))]
    per_key = (
        union_all(tagged)
        .groupBy("key_value")
        .agg(
            F.max(F.col("tag") == -1).alias("known"),
            *[F.count_if(F.col("tag") == tag).alias(name) for tag, name in enumerate(rows)],
        )
        .where("NOT known")
    )
    totals = per_key.agg(
        *[F.count_if(F.col(name) > 0).alias(f"keys_{tag}") for tag, name in enumerate(rows)],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rows],
    )
    found = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent_table"),
            F.col(f"keys_{tag}").alias("orphan_keys"),
            F.col(f"rows_{tag}").alias("orphan_rows"),
        )
        for tag, (rule, name, column) in enumerate(references)
    ]
    return totals.select(F.inline(F.array(*found)))


# --- defaults -----------------------------------------------------------------


def apply_defaults(df: DataFrame, spec: TableSpec, run_time: datetime) -> DataFrame:
    """Declared defaults for columns that are absent (Q7).

    A null in a column that is present stays null, as in an SQL insert.
    ``run_time`` stands in for the source's current date and time.
    """
    now = F.lit(run_time.isoformat(sep=" ", timespec="microseconds"))
    present = set(df.columns)
    added = []
    for name, default in spec.defaults.items():
        if name in present:
            continue
        value = now if default in (RUN_DATE, RUN_TIMESTAMP) else F.lit(default)
        if default == RUN_DATE:
            value = value.cast("timestamp_ntz")
        added.append(value.cast(spec.schema[name].dataType).alias(name))
    return df.select("*", *added)
