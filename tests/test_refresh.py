"""Refreshes that fail, counts kept with the tables, buckets, and lakes side by side."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemarts.operators import quality
from lakemarts.operators.cleaning import clean_table
from lakemarts.operators.quality import RowMetrics
from lakemarts.plans import marts, medallion
from lakemarts.registry.queries import QUERIES
from lakemarts.schemas import TABLES
from lakemarts.settings import LakeSettings, sized_session
from lakemarts.sources.bank_views import bank_tables
from lakemarts.sources.catalog import _Folder, attach_table, create_database, save_table, table_facts, table_path
from lakemarts.sources.readers import read_table
from tests.test_marts import table
from tests.test_plans import NO_BROADCAST, conf, plan_of

DATA_DIR = "/root/testdata/sf0.001"
RUN_TIME = datetime(2026, 1, 1)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    settings = LakeSettings(
        database_prefix="fresh_",
        location=str(tmp_path_factory.mktemp("fresh")),
        buckets={
            "customers": ("customer_uuid", 4),
            "accounts": ("customer_uuid", 4),
            "credit_scores": ("customer_uuid", 4),
            "loan_applications": ("loan_id", 4),
            "loan_repayments": ("loan_id", 4),
        },
    )
    medallion.land_bronze(spark, bank_tables(spark, DATA_DIR), settings, RUN_TIME)
    medallion.refresh_lakehouse(spark, settings)
    return settings


@pytest.fixture
def scratch(spark, tmp_path):
    settings = LakeSettings(database_prefix=f"s{abs(hash(tmp_path))}_", location=str(tmp_path))
    create_database(spark, settings.database("scratch"), settings)
    return settings, settings.database("scratch") + ".t"


def forget(spark, name):
    """The table as a session without a lasting catalog finds it: not at all."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def failing(spark, n):
    """Rows of which the last fails, when others have been written."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, n, 1, 4).select(bad.cast("bigint").alias("id"))


def test_a_write_that_dies_leaves_the_old_rows(spark, scratch):
    settings, name = scratch
    save_table(spark.range(5), name, settings)
    with pytest.raises(Exception, match="lost"):
        save_table(failing(spark, 40), name, settings)
    assert rows(read_table(spark, name)) == rows(spark.range(5))
    forget(spark, name)
    assert attach_table(spark, name, settings)
    assert rows(read_table(spark, name)) == rows(spark.range(5))
    save_table(spark.range(3), name, settings)
    assert rows(read_table(spark, name)) == rows(spark.range(3))


def test_a_job_that_dies_before_its_marker_changes_nothing(spark, scratch, monkeypatch):
    settings, name = scratch
    save_table(spark.range(5), name, settings)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(_Folder, "create", dies)
        save_table(spark.range(9), name, settings)
    forget(spark, name)
    assert attach_table(spark, name, settings)
    assert read_table(spark, name).count() == 5


def test_a_job_that_dies_after_its_marker_has_refreshed(spark, scratch, monkeypatch):
    settings, name = scratch
    save_table(spark.range(5), name, settings)
    create = _Folder.create

    def dies(self, *given):
        create(self, *given)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(_Folder, "create", dies)
        save_table(spark.range(9), name, settings)
    forget(spark, name)
    assert attach_table(spark, name, settings)
    assert read_table(spark, name).count() == 9


def test_readers_of_the_version_before_still_read(spark, scratch):
    settings, name = scratch
    save_table(spark.range(5), name, settings)
    begun = read_table(spark, name)
    begun.schema
    save_table(spark.range(7), name, settings)
    assert begun.count() == 5
    for n in (8, 9, 10):
        save_table(spark.range(n), name, settings)
    folder = _Folder(spark, table_path(name, settings))
    assert len([v for v in folder.names() if v.startswith("v")]) == 2
    assert len(folder.names("_versions")) == 2


def test_another_session_sees_the_refresh(spark, scratch):
    settings, name = scratch
    other = spark.newSession()
    save_table(spark.range(5), name, settings)
    assert read_table(other, name).count() == 5
    for n in (6, 7, 8):
        save_table(spark.range(n), name, settings)
    assert read_table(other, name).count() == 8


# --- counted while writing ----------------------------------------------------


def test_rules_of_bronze_clean_each_table_once(spark, lake):
    bronze = medallion.bronze_tables(spark, lake)
    cleaned = {name: clean_table(df) for name, df in bronze.items()}
    apart = LakeSettings(database_prefix="rules_of_bronze_")
    found = medallion.bronze_broken_rules(spark, bronze, apart)
    expected = rows(medallion.broken_rules(cleaned, bronze))
    assert expected and rows(found) == expected
    # The rules on keys read what was written: no row is cleaned and compared again.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "sha2" not in plan and "trim" not in plan


def test_kept_counts_equal_the_audits(spark, lake):
    silver, bronze = medallion.silver_tables(spark, lake), medallion.bronze_tables(spark, lake)
    assert rows(medallion.lake_broken_rules(spark, lake)) == rows(medallion.broken_rules(silver, bronze))
    for layer, tables, kinds in (("silver", silver, ("not null", "range")), ("bronze", bronze, ("length",))):
        for name, df in tables.items():
            facts = table_facts(spark, medallion._layer_table(layer, name, lake), lake)
            kept = sorted(tuple(fact) for fact in facts if fact[0] != "rows")
            assert kept == sorted(map(tuple, quality.audit_rows({name: df}, *kinds).collect()))
            assert ["rows", name, "", df.count()] in facts
    counts = {(r.layer, r.table_name): r.record_count for r in medallion.lake_counts(spark, lake).collect()}
    assert counts[("silver", "accounts")] == silver["accounts"].count()
    assert counts[("gold", "fraud")] == medallion.gold_tables(spark, lake)["fraud"].count()
    assert len(counts) == 2 * len(TABLES) + len(medallion.MART_PLANS)


def test_row_rules_and_counts_cost_no_scan(spark, lake):
    """What is read is one scan of each table for its keys, and each side of a reference."""
    scans = plan_of(medallion.lake_broken_rules(spark, lake)).count("FileScan")
    with_rules = plan_of(
        medallion.broken_rules(medallion.silver_tables(spark, lake), medallion.bronze_tables(spark, lake))
    ).count("FileScan")
    # Not null and ranges of each Silver table, lengths of each Bronze table that has some.
    limited = sum(bool(spec.lengths) for spec in TABLES.values())
    assert with_rules - scans == len(TABLES) + limited
    assert "FileScan" not in plan_of(medallion.lake_counts(spark, lake))


def test_tables_without_kept_counts_are_read(spark, lake, monkeypatch):
    expected = rows(medallion.lake_broken_rules(spark, lake)), rows(medallion.lake_counts(spark, lake))
    monkeypatch.setattr(medallion, "table_facts", lambda *_: None)
    assert (rows(medallion.lake_broken_rules(spark, lake)), rows(medallion.lake_counts(spark, lake))) == expected


def test_strict_refresh_stops_on_kept_counts(spark, lake):
    with pytest.raises(medallion.AuditFailed, match="unique: transactions.transaction_id"):
        medallion.refresh_lakehouse(spark, replace(lake, strict=True))


def test_metrics_of_an_empty_table(spark, tmp_path):
    metrics = RowMetrics("fraud_alerts", table(spark, "fraud_alerts"), "range")
    metrics.rows.write.parquet(str(tmp_path / "none"))
    assert metrics.found() == [("rows", "fraud_alerts", "", 0), ("range", "fraud_alerts", "risk_score", 0)]


# --- keys ---------------------------------------------------------------------


def test_unique_keys_cost_one_scan_of_each_table(spark, lake):
    with conf(spark, **NO_BROADCAST):
        plan = plan_of(quality.audit_unique(medallion.silver_tables(spark, lake)))
    assert plan.count("FileScan") == len(TABLES)


def test_references_to_one_parent_cost_one_shuffle_by_key(spark, lake):
    tables = medallion.bronze_tables(spark, lake)
    parents = {
        (ref.parent, ref.parent_column) for spec in TABLES.values() for ref in (*spec.foreign_keys, *spec.soft_keys)
    }
    plan = plan_of(quality.audit_references(tables, "foreign key", "orphan"))
    assert plan.count("hashpartitioning(key_value") == len(parents)
    assert "Join" not in plan


# --- buckets ------------------------------------------------------------------


def test_buckets_change_no_row(spark, lake):
    for name, df in medallion.silver_tables(spark, lake).items():
        assert rows(df) == rows(QUERIES[f"silver_{name}"](spark, DATA_DIR))


def test_bucketed_marts_and_references_do_not_shuffle_by_key(spark, lake):
    silver = medallion.silver_tables(spark, lake)
    with conf(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        health = marts.mart_financial_health(silver["customers"], silver["accounts"], silver["credit_scores"])
        # Below the first join of the key there is none; what follows it has one row per customer.
        assert plan_of(health).count("Exchange") == 1
        assert "Exchange" not in plan_of(health).split("FullOuter")[1]
        loans = plan_of(marts.mart_loans(silver["loan_applications"], silver["loan_repayments"]))
        assert "Exchange hashpartitioning(loan_id" not in loans
    assert rows(health) == rows(QUERIES["mart_financial_health"](spark, DATA_DIR))


def test_buckets_are_found_again(spark, lake):
    name = lake.silver_table("credit_loans", "loan_repayments")
    before = rows(read_table(spark, name))
    forget(spark, name)
    assert attach_table(spark, name, lake)
    assert rows(read_table(spark, name)) == before
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "4" and "loan_id" in described["Bucket Columns"]


# --- jobs, sessions, scratch lakes --------------------------------------------


def test_a_job_starts_when_its_own_inputs_are_there(spark):
    order = []
    jobs = {
        "mart": (lambda: order.append("mart"), ("a",)),
        "b": (lambda: order.append("b"), ()),
        "a": (lambda: order.append("a"), ()),
        "last": (lambda: order.append("last"), ("mart", "b")),
    }
    medallion._run_graph(spark, jobs, LakeSettings(parallel_tables=1))
    assert order.index("a") < order.index("mart") and order[-1] == "last" and len(order) == 4
    with pytest.raises(ValueError, match="needs|need"):
        medallion._run_graph(spark, {"x": (print, ("nothing",))}, LakeSettings())

    def broken():
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        medallion._run_graph(spark, {"x": (broken, ()), "y": (lambda: order.append("y"), ("x",))}, LakeSettings())
    assert "y" not in order


def test_each_write_is_sized_by_its_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "12345"}):
        sized = sized_session(spark, 2 * 1024**4)
        assert sized.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert int(sized.conf.get("spark.sql.shuffle.partitions")) >= 4096
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_lakes_of_several_queries_stand_side_by_side(spark):
    names = ["bronze_load", "bronze_load_messy", "save_roundtrip", "lakehouse_refresh"]
    frames = {name: QUERIES[name](spark, DATA_DIR) for name in names}
    other = spark.newSession()
    QUERIES["save_roundtrip"](other, DATA_DIR)
    found = {name: rows(frames[name]) for name in reversed(names)}
    assert {name: rows(QUERIES[name](spark, DATA_DIR)) for name in names} == found
