"""Bronze to Silver to Gold over catalog tables.

Each table is one lazy plan and one write, and starts as soon as the tables it reads are
written, a few at a time: the tail of one job fills with tasks of the next. Gold reads the
written Silver tables, not their plans, so a lost executor costs no more than the tasks it
ran. Each write has as many shuffle partitions as its own input needs.

Row counts and the rules on single rows are counted while the rows are written, and kept
with the table; a strict run and the report of a refresh read them from there.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.operators.cleaning import clean_columns, clean_names, clean_table
from lakemarts.operators.dedup import dedup_by_hash, dedup_by_key, is_integer_key
from lakemarts.operators.quality import (
    METRICS_SCHEMA,
    RowMetrics,
    apply_defaults,
    audit_length,
    audit_references,
    audit_rows,
    audit_unique,
    row_counts,
    union_all,
)
from lakemarts.plans import marts, pages
from lakemarts.schemas import TABLES, TableSpec
from lakemarts.settings import (
    GOLD_DATABASE,
    STAGE_DATABASE,
    STAGE_TABLES,
    LakeSettings,
    require_ansi,
    sized_session,
)
from lakemarts.sources.catalog import attach_table, create_database, save_table, table_facts
from lakemarts.sources.readers import conform, input_bytes, read_table


#: Rules on single rows that are counted while a layer is written: lengths where personal
#: values are not yet digests, the others where blanks have become nulls.
WRITE_RULES = {"bronze": ("length",), "silver": ("not null", "range")}


class AuditFailed(ValueError):
    """A strict run met rows that break a declared rule."""


# Which Silver tables each mart is built from, in argument order.
MART_PLANS: Mapping[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "financial_health": (
        marts.mart_financial_health,
        ("customers", "accounts", "credit_scores"),
    ),
    "transactions": (marts.mart_transactions, ("transactions",)),
    "loans": (marts.mart_loans, ("loan_applications", "loan_repayments")),
    "loans_exact": (marts.mart_loans_exact, ("loan_applications", "loan_repayments")),
    "fraud": (marts.mart_fraud, ("fraud_alerts",)),
}


# Stage tables: plan, Silver inputs, and the marts cut from each.
STAGE_PLANS: Mapping[str, tuple[Callable[..., DataFrame], tuple[str, ...], Mapping]] = {
    "loan_totals": (
        marts.loan_totals,
        ("loan_applications", "loan_repayments"),
        {"loans": marts.loans_of, "loans_exact": marts.loans_exact_of},
    ),
    "transaction_totals": (
        marts.transaction_totals,
        ("transactions",),
        {"transactions": marts.transactions_of},
    ),
    "fraud_totals": (marts.fraud_totals, ("fraud_alerts",), {"fraud": marts.fraud_of}),
}


def land_bronze(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    settings: LakeSettings,
    run_time: datetime,
) -> None:
    """Source tables written to Bronze, declared columns in their types.

    Names are cleaned before anything else, so that a default fills only a column that
    is absent. Columns beyond the declared are kept. A value that does not fit its
    type fails the job; a session in which it would become null is refused.
    """
    require_ansi(spark)
    _create_databases(spark, settings, "bronze")

    def land(name: str) -> None:
        spec = TABLES[name]
        named = clean_names(sources[name])
        rows = conform(apply_defaults(named, spec, run_time), spec)
        _save_layer(rows, "bronze", name, settings)

    _run_graph(spark, {name: (partial(land, name), ()) for name in sources}, settings)


def _save_layer(rows: DataFrame, layer: str, name: str, settings: LakeSettings) -> None:
    """A Bronze or Silver table saved, with what was counted while it was written."""
    metrics = RowMetrics(name, rows, *WRITE_RULES[layer])
    table = _layer_table(layer, name, settings)
    buckets = settings.buckets.get(name) if layer == "silver" else None
    save_table(metrics.rows, table, settings, buckets=buckets, facts=metrics.found)


def _layer_table(layer: str, name: str, settings: LakeSettings) -> str:
    if layer == "gold":
        return settings.gold_table(name)
    named = settings.bronze_table if layer == "bronze" else settings.silver_table
    return named(TABLES[name].domain, name)


def _save_gold(rows: DataFrame, table: str, settings: LakeSettings) -> None:
    metrics = RowMetrics(table, rows)
    save_table(metrics.rows, table, settings, facts=metrics.found)


def _sized_reader(
    spark: SparkSession, settings: LakeSettings, names: list[str]
) -> Callable[[str], DataFrame]:
    """Reads tables in a session whose shuffles suit the largest of them."""
    if settings.size_shuffles:
        largest = max(input_bytes(read_table(spark, name)) for name in names)
        spark = sized_session(spark, largest)
    return partial(read_table, spark)


def bronze_table(spark: SparkSession, settings: LakeSettings, name: str) -> DataFrame:
    return read_table(spark, settings.bronze_table(TABLES[name].domain, name))


def bronze_tables(spark: SparkSession, settings: LakeSettings) -> dict[str, DataFrame]:
    return {name: bronze_table(spark, settings, name) for name in TABLES}


def silver_tables(spark: SparkSession, settings: LakeSettings) -> dict[str, DataFrame]:
    return {
        name: read_table(spark, settings.silver_table(spec.domain, name))
        for name, spec in TABLES.items()
    }


def gold_tables(spark: SparkSession, settings: LakeSettings) -> dict[str, DataFrame]:
    return {mart: read_table(spark, settings.gold_table(mart)) for mart in MART_PLANS}


def attach_lake(spark: SparkSession, settings: LakeSettings) -> list[str]:
    """Tables of all layers found under ``location``, made known to this session."""
    for layer in ("bronze", "silver"):
        _create_databases(spark, settings, layer)
    for database in (GOLD_DATABASE, STAGE_DATABASE):
        create_database(spark, settings.database(database), settings)
    names = [settings.gold_table(mart) for mart in MART_PLANS]
    names += [settings.stage_table(stage) for stage in STAGE_TABLES]
    for name, spec in TABLES.items():
        names.append(settings.bronze_table(spec.domain, name))
        names.append(settings.silver_table(spec.domain, name))
    return [name for name in names if attach_table(spark, name, settings)]


def build_silver(spark: SparkSession, settings: LakeSettings) -> None:
    """Every Bronze table cleaned and saved."""
    _create_databases(spark, settings, "silver")
    _run_graph(spark, _silver_jobs(spark, settings), settings)


def _silver_jobs(spark: SparkSession, settings: LakeSettings) -> dict:
    def refine(name: str) -> None:
        bronze = settings.bronze_table(TABLES[name].domain, name)
        read = _sized_reader(spark, settings, [bronze])
        _save_layer(silver_rows(read(bronze), TABLES[name], settings), "silver", name, settings)

    return {f"silver {name}": (partial(refine, name), ()) for name in TABLES}


def silver_rows(bronze: DataFrame, spec: TableSpec, settings: LakeSettings) -> DataFrame:
    """The Silver rows of one table; same rows with either kind of dedup."""
    options = {"blank_pii": settings.blank_pii, "salt": settings.salt}
    by_name = {name.strip().lower(): name for name in bronze.columns}
    key = by_name.get(spec.primary_key)
    if not settings.dedup_by_key:
        return clean_table(bronze, **options)
    if key is not None and is_integer_key(bronze, key):
        return dedup_by_key(bronze, key, partial(clean_columns, **options))
    return dedup_by_hash(clean_columns(bronze, **options))


def build_gold(spark: SparkSession, settings: LakeSettings) -> None:
    """The marts, computed from the written Silver tables and saved.

    A strict run audits Silver and Bronze first and raises :class:`AuditFailed`.
    """
    require_ansi(spark)
    if settings.strict:
        require_clean_lake(spark, settings)
    _create_gold(spark, settings)
    jobs = {name: (job, ()) for name, (job, _) in _gold_jobs(spark, settings).items()}
    _run_graph(spark, jobs, settings)


def _create_gold(spark: SparkSession, settings: LakeSettings) -> None:
    for database in (GOLD_DATABASE, STAGE_DATABASE):
        create_database(spark, settings.database(database), settings)


def _gold_jobs(spark: SparkSession, settings: LakeSettings) -> dict:
    """Each mart or stage table, and the Silver tables it needs."""

    def inputs(names: tuple[str, ...]) -> list[DataFrame]:
        tables = [_layer_table("silver", name, settings) for name in names]
        return [*map(_sized_reader(spark, settings, tables), tables)]

    def build_stage(name: str) -> None:
        # Marts and pages are cut from one small written table.
        plan, needed, cuts = STAGE_PLANS[name]
        save_table(plan(*inputs(needed)), settings.stage_table(name), settings)
        totals = read_table(spark, settings.stage_table(name))
        for mart, cut in cuts.items():
            _save_gold(cut(totals), settings.gold_table(mart), settings)

    def build_mart(name: str) -> None:
        plan, needed = MART_PLANS[name]
        _save_gold(plan(*inputs(needed)), settings.gold_table(name), settings)

    def needs(names: tuple[str, ...]) -> tuple[str, ...]:
        return tuple(f"silver {name}" for name in names)

    jobs = {"financial_health": (partial(build_mart, "financial_health"), needs(MART_PLANS["financial_health"][1]))}
    return jobs | {
        name: (partial(build_stage, name), needs(needed)) for name, (_, needed, _) in STAGE_PLANS.items()
    }


def gold_pages(spark: SparkSession, settings: LakeSettings) -> dict[str, DataFrame]:
    """The dashboard pages over the written Gold tables."""
    gold = gold_tables(spark, settings)

    def stage(name: str) -> DataFrame:
        return read_table(spark, settings.stage_table(name))

    return {
        "overview": pages.page_overview(gold["financial_health"]),
        "transactions": pages.page_transactions(stage("transaction_totals")),
        "loans": pages.page_loans(gold["loans_exact"]),
        "fraud": pages.page_fraud(stage("fraud_totals")),
    }


def refresh_lakehouse(spark: SparkSession, settings: LakeSettings) -> DataFrame:
    """Silver and Gold rebuilt from Bronze; returns the row count of each table.

    ``layer, table_name, record_count``. A mart starts when the Silver tables it reads are
    written; a strict run audits between the layers.
    """
    require_ansi(spark)
    if settings.strict:
        build_silver(spark, settings)
        build_gold(spark, settings)
    else:
        _create_databases(spark, settings, "silver")
        _create_gold(spark, settings)
        _run_graph(spark, _silver_jobs(spark, settings) | _gold_jobs(spark, settings), settings)
    return lake_counts(spark, settings)


def lake_counts(spark: SparkSession, settings: LakeSettings) -> DataFrame:
    """``layer, table_name, record_count`` of every table (Q1), as counted in its write.

    A table that keeps no counts is read.
    """
    known, others = [], []
    for layer, names in {"bronze": TABLES, "silver": TABLES, "gold": MART_PLANS}.items():
        for name in names:
            table = _layer_table(layer, name, settings)
            facts = table_facts(spark, table, settings)
            if facts:
                known += [(layer, name, n) for rule, _, _, n in facts if rule == "rows"]
            else:
                counted = row_counts({name: read_table(spark, table)})
                others.append(counted.select(F.lit(layer).alias("layer"), "*"))
    kept = spark.createDataFrame(known, "layer string, table_name string, record_count bigint")
    return union_all([kept, *others])


def broken_rules(
    tables: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Declared rules with violations: ``rule, table_name, column_name, violations``.

    Lengths are counted on ``bronze``, where a personal value is not yet a digest.
    """
    found = [audit_rows(tables, "not null", "range")]
    if bronze is not None:
        found.append(audit_length(bronze).withColumn("rule", F.lit("length")))
    return _broken([*found, *_key_rules(tables)])


def lake_broken_rules(spark: SparkSession, settings: LakeSettings) -> DataFrame:
    """:func:`broken_rules` of the written lake.

    Rules on single rows come from the counts kept with the tables, so that only keys and
    references are read; a table that keeps no counts is read for its rules too.
    """
    known, found = [], []
    for layer, tables in (("bronze", bronze_tables), ("silver", silver_tables)):
        for name, rows in tables(spark, settings).items():
            facts = table_facts(spark, _layer_table(layer, name, settings), settings)
            if facts:
                known += [tuple(fact) for fact in facts if fact[0] in WRITE_RULES[layer]]
            else:
                found.append(audit_rows({name: rows}, *WRITE_RULES[layer]))
    found.append(spark.createDataFrame(known, METRICS_SCHEMA))
    if settings.size_shuffles:
        names = [_layer_table("silver", name, settings) for name in TABLES]
        read = _sized_reader(spark, settings, names)
        silver = {name: read(table) for name, table in zip(TABLES, names)}
    else:
        silver = silver_tables(spark, settings)
    return _broken([*found, *_key_rules(silver)])


def bronze_broken_rules(
    spark: SparkSession, bronze: Mapping[str, DataFrame], settings: LakeSettings
) -> DataFrame:
    """:func:`broken_rules` of the Silver rows of ``bronze``, each table cleaned once.

    Rules on single rows are counted while the key columns are written, and rules on keys
    read only these. ``settings`` name a lake of its own, whose Silver tables then hold the
    key columns alone.
    """
    _create_databases(spark, settings, "silver")

    def keep(name: str) -> None:
        rows = silver_rows(bronze[name], TABLES[name], settings)
        metrics = RowMetrics(name, rows, *WRITE_RULES["silver"])
        keys = metrics.rows.select(*_key_columns(name))
        save_table(keys, _layer_table("silver", name, settings), settings, facts=metrics.found)

    _run_graph(spark, {name: (partial(keep, name), ()) for name in TABLES}, settings)
    known = []
    for name in TABLES:
        facts = table_facts(spark, _layer_table("silver", name, settings), settings)
        known += [tuple(fact) for fact in facts if fact[0] in WRITE_RULES["silver"]]
    lengths = audit_length(bronze).withColumn("rule", F.lit("length"))
    counted = spark.createDataFrame(known, METRICS_SCHEMA)
    return _broken([lengths, counted, *_key_rules(silver_tables(spark, settings))])


def _key_columns(name: str) -> list[str]:
    """Columns of a table that are unique, refer to another table or are referred to."""
    spec = TABLES[name]
    references = [*spec.foreign_keys, *spec.soft_keys]
    referred = [
        ref.parent_column
        for other in TABLES.values()
        for ref in (*other.foreign_keys, *other.soft_keys)
        if ref.parent == name
    ]
    return list(dict.fromkeys([*spec.unique_keys, *[ref.column for ref in references], *referred]))


def _key_rules(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    unique = audit_unique(tables).withColumn("rule", F.lit("unique"))
    references = audit_references(tables, "foreign key", "orphan")
    return [
        unique.withColumnRenamed("surplus_rows", "violations").drop("repeated_keys"),
        references.withColumnRenamed("orphan_rows", "violations").drop("orphan_keys", "parent_table"),
    ]


def _broken(found: list[DataFrame]) -> DataFrame:
    return (
        union_all(found)
        .where("violations > 0")
        .select("rule", "table_name", "column_name", "violations")
    )


def require_clean(
    tables: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame] | None = None
) -> None:
    _raise_broken(broken_rules(tables, bronze))


def require_clean_lake(spark: SparkSession, settings: LakeSettings) -> None:
    _raise_broken(lake_broken_rules(spark, settings))


def _raise_broken(rules: DataFrame) -> None:
    # One row per declared rule at most, so this result is small.
    broken = rules.orderBy("rule", "table_name", "column_name").collect()
    if broken:
        lines = [f"{b.rule}: {b.table_name}.{b.column_name} ({b.violations} rows)" for b in broken]
        raise AuditFailed("declared rules are broken: " + "; ".join(lines))


def _create_databases(spark: SparkSession, settings: LakeSettings, layer: str) -> None:
    for domain in dict.fromkeys(spec.domain for spec in TABLES.values()):
        create_database(spark, settings.database(domain, layer), settings)


def _run_graph(
    spark: SparkSession,
    jobs: Mapping[str, tuple[Callable[[], None], tuple[str, ...]]],
    settings: LakeSettings,
) -> None:
    """Jobs by name, each with the names of those it needs, a few at a time."""
    in_session = inheritable_thread_target(spark)
    waiting, done = dict(jobs), set()
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=settings.parallel_tables) as pool:
        while waiting or running:
            for name in [name for name, (_, needs) in waiting.items() if done.issuperset(needs)]:
                running[pool.submit(in_session(waiting.pop(name)[0]))] = name
            if not running:
                raise ValueError(f"these jobs need what no job makes: {sorted(waiting)}")
            for finished in wait(running, return_when=FIRST_COMPLETED).done:
                done.add(running.pop(finished))
                finished.result()
