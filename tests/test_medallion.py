from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakemarts import jobs
from lakemarts.plans import medallion
from lakemarts.registry.queries import QUERIES
from lakemarts.schemas import TABLES
from lakemarts.settings import CLUSTER_CONF, LakeSettings, shuffle_partitions
from lakemarts.sources import readers
from lakemarts.sources.bank_views import bank_tables
from lakemarts.sources.catalog import create_database, save_table, shared_folder
from tests.test_marts import table

DATA_DIR = "/root/testdata/sf0.001"
RUN_TIME = datetime(2026, 1, 1)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    settings = LakeSettings(
        database_prefix="whole_", location=str(tmp_path_factory.mktemp("lake"))
    )
    medallion.land_bronze(spark, bank_tables(spark, DATA_DIR), settings, RUN_TIME)
    medallion.refresh_lakehouse(spark, settings)
    return settings


def test_table_names():
    plain, placed = LakeSettings(), LakeSettings(catalog="main", database_prefix="dev_")
    assert plain.silver_table("core_banking", "accounts") == "core_banking_silver.silver_accounts"
    assert plain.gold_table("fraud") == "gold.gold_fact_fraud_risk"
    assert (
        placed.bronze_table("credit_loans", "credit_cards")
        == "main.dev_credit_loans_bronze.credit_cards"
    )


def test_bronze_keeps_rows_and_types(spark, lake):
    sources = bank_tables(spark, DATA_DIR)
    for name, landed in medallion.bronze_tables(spark, lake).items():
        declared = [(f.name, f.dataType) for f in TABLES[name].schema.fields]
        assert [(f.name, f.dataType) for f in landed.schema.fields] == declared
        assert rows(landed) == rows(sources[name])


@pytest.mark.parametrize("name", TABLES)
def test_silver_equals_the_plain_cleaning_step(spark, lake, name):
    written = medallion.silver_tables(spark, lake)[name]
    assert rows(written) == rows(QUERIES[f"silver_{name}"](spark, DATA_DIR))


@pytest.mark.parametrize("mart", medallion.MART_PLANS)
def test_gold_equals_the_mart_query(spark, lake, mart):
    written = medallion.gold_tables(spark, lake)[mart]
    expected = QUERIES[f"mart_{mart}"](spark, DATA_DIR)
    if mart == "transactions":
        month = "CAST(transaction_month AS TIMESTAMP_NTZ) AS transaction_month"
        written = written.selectExpr(month, *written.columns[1:])
    assert rows(written) == rows(expected)


def test_refresh_can_be_repeated(spark, lake):
    counts = rows(medallion.refresh_lakehouse(spark, lake))
    assert len(counts) == 2 * len(TABLES) + len(medallion.MART_PLANS)
    assert counts == rows(medallion.refresh_lakehouse(spark, lake))


def test_full_dedup_gives_the_same_silver(spark, lake):
    bronze = medallion.bronze_tables(spark, lake)
    full = replace(lake, dedup_by_key=False)
    for name, spec in TABLES.items():
        assert rows(medallion.silver_rows(bronze[name], spec, full)) == rows(
            medallion.silver_rows(bronze[name], spec, lake)
        )


def test_silver_without_an_integer_key_compares_whole_rows(spark):
    rows_in = spark.createDataFrame([("1", "a "), ("1", "a"), ("2", "a")], "card_id string, x string")
    spec = TABLES["credit_cards"]
    assert medallion.silver_rows(rows_in, spec, LakeSettings()).count() == 2
    assert medallion.silver_rows(rows_in.drop("card_id"), spec, LakeSettings()).count() == 1


def test_silver_key_is_found_under_its_raw_name(spark):
    rows_in = spark.createDataFrame([(1, "a "), (1, "a"), (2, "a")], "` CARD_ID` int, x string")
    silver = medallion.silver_rows(rows_in, TABLES["credit_cards"], LakeSettings())
    assert silver.columns == ["card_id", "x"] and silver.count() == 2


def test_strict_run_stops_on_broken_rules(spark, lake):
    with pytest.raises(medallion.AuditFailed, match="unique: transactions.transaction_id"):
        medallion.build_gold(spark, replace(lake, strict=True))


def test_strict_run_passes_on_clean_tables(spark):
    who = dict(customer_uuid="a", customer_id=1, first_name="x", last_name="y")
    held = dict(account_id=1, account_uuid="u", customer_uuid="a", account_type="Current Account")
    clean = {name: table(spark, name) for name in TABLES}
    clean["customers"] = table(spark, "customers", who)
    clean["accounts"] = table(spark, "accounts", held)
    medallion.require_clean(clean)


def test_saving_over_a_table_being_read_is_refused(spark, lake):
    name = lake.silver_table("credit_loans", "credit_cards")
    with pytest.raises(AnalysisException, match="(?i)overwrite"):
        save_table(spark.read.table(name), name, lake)


def test_overwrite_replaces_the_schema(spark, tmp_path):
    settings = LakeSettings(database_prefix="schema_", location=str(tmp_path))
    database = settings.database("scratch")
    create_database(spark, database, settings)
    create_database(spark, database, settings)
    save_table(spark.range(3), f"{database}.t", settings)
    save_table(spark.range(2).selectExpr("'x' AS word"), f"{database}.t", settings)
    assert spark.read.table(f"{database}.t").dtypes == [("word", "string")]


def test_shared_folder_follows_the_session(spark):
    first, second = shared_folder(spark, "w"), shared_folder(spark, "w")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(10) == 200
    assert shuffle_partitions(10 * 1024**3) == 200
    assert shuffle_partitions(1024**4) == 4096
    assert shuffle_partitions(4 * 1024**4) == 4096
    assert shuffle_partitions(100 * 1024**4) == 51_200


def test_landing_keeps_what_it_does_not_know(spark, tmp_path):
    settings = LakeSettings(database_prefix="messy_", location=str(tmp_path))
    accounts = table(
        spark, "accounts", dict(account_id=1, account_uuid="u", account_type="x", status="Frozen")
    )
    extra = accounts.withColumn("note", F.lit("  kept "))
    messy = extra.withColumnsRenamed({"status": " status", "currency": "CURRENCY"})
    medallion.land_bronze(spark, {"accounts": messy}, settings, RUN_TIME)
    landed = medallion.bronze_table(spark, settings, "accounts")
    assert landed.columns == [*TABLES["accounts"].columns, "note"]
    assert landed.first().status == "Frozen"
    silver = medallion.silver_rows(landed, TABLES["accounts"], settings)
    assert silver.first().note == "kept"
    with pytest.raises(ValueError, match="collide"):
        clash = extra.toDF(*extra.columns[:-1], " STATUS ")
        medallion.land_bronze(spark, {"accounts": clash}, settings, RUN_TIME)


def test_landing_refuses_a_session_that_hides_bad_values(spark):
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.ansi.enabled", "false")
    with pytest.raises(ValueError, match="ansi"):
        medallion.land_bronze(quiet, {}, LakeSettings(), RUN_TIME)
    with pytest.raises(ValueError, match="ansi"):
        medallion.build_gold(quiet, LakeSettings())
    assert CLUSTER_CONF["spark.sql.ansi.enabled"] == "true"


def test_csv_may_lack_columns_and_hold_more(spark, tmp_path):
    (tmp_path / "accounts.csv").write_text(
        'account_id, ACCOUNT_UUID,customer_uuid,account_type,remark\n1,u,c,"a\nb",r\n'
    )
    spec = TABLES["accounts"]
    read = readers.read_csv(spark, str(tmp_path / "accounts.csv"), spec, multi_line=True)
    assert [t for _, t in read.dtypes] == ["int", "string", "string", "string", "string"]
    assert tuple(read.first()) == (1, "u", "c", "a\nb", "r")


def test_a_half_written_table_is_an_error(spark, tmp_path):
    settings = LakeSettings(database_prefix="half_", location=str(tmp_path))
    (tmp_path / "half_credit_loans_bronze" / "credit_cards").mkdir(parents=True)
    with pytest.raises(AnalysisException):
        medallion.attach_lake(spark, settings)


def test_pages_come_from_written_gold(spark, lake):
    for name, page in medallion.gold_pages(spark, lake).items():
        expected = QUERIES[f"page_{name}"](spark, DATA_DIR)
        if name == "transactions":
            expected = expected.drop("transaction_month")
            page = page.drop("transaction_month")
        assert rows(page) == rows(expected)


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    named = {"spark.sql.warehouse.dir": "/shared/warehouse/"}
    session = SimpleNamespace(conf=named)
    assert shared_folder(session, "w").startswith("/shared/warehouse/w-")


def test_queries_leave_one_lake_behind(spark):
    for _ in range(2):
        assert QUERIES["save_roundtrip"](spark, DATA_DIR).count() > 0
    assert len(spark.catalog.listDatabases("lakemarts_save_roundtrip_*")) == 1


# --- readers ------------------------------------------------------------------


def test_csv_in_declared_types(spark, tmp_path):
    loan = dict(loan_id=1, customer_uuid="a", loan_type="x", term_months=12)
    loan["principal_amount"] = Decimal("10.50")
    written = table(spark, "loan_applications", loan)
    written.write.csv(str(tmp_path / "loans"), header=True)
    read = readers.read_csv(spark, str(tmp_path / "loans"), TABLES["loan_applications"])
    assert read.dtypes == written.dtypes and rows(read) == rows(written)


def test_csv_with_a_bad_value_fails(spark, tmp_path):
    (tmp_path / "scores.csv").write_text(
        ",".join(TABLES["credit_scores"].columns) + "\n1,a,many,Good,0,1.00,2024-01-01\n"
    )
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        readers.read_csv(spark, str(tmp_path / "scores.csv"), TABLES["credit_scores"]).collect()


def test_conform_orders_and_casts(spark):
    loose = spark.createDataFrame([("12.5", "7", 1)], "apr string, x string, card_id bigint")
    spec = TABLES["credit_cards"]
    with pytest.raises(ValueError, match="credit_limit"):
        readers.conform(loose, spec)
    cards = table(spark, "credit_cards", dict(card_id=1, apr=Decimal("1.00")))
    wide = cards.selectExpr("'extra' AS extra", *reversed(cards.columns))
    assert readers.conform(wide, spec).dtypes == [*cards.dtypes, ("extra", "string")]


def test_jdbc_read_is_cut_by_the_key():
    options = readers.jdbc_options(TABLES["transactions"], "jdbc:postgresql://db/core", 1, 99, 8)
    assert options["partitionColumn"] == "transaction_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "1",
        "99",
        "8",
    )
    with pytest.raises(ValueError):
        readers.jdbc_options(TABLES["transactions"], "jdbc:x", 9, 1, 8)


def test_jdbc_bounds_come_from_the_key():
    query = readers.jdbc_bounds_query(TABLES["loan_repayments"])
    assert query == "SELECT min(repayment_id) AS low, max(repayment_id) AS high FROM loan_repayments"


def test_sample_is_in_key_order(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in readers.sample_rows(df, 3, "id").collect()] == [0, 1, 2]


# --- command line -------------------------------------------------------------


def test_steps_from_the_command_line(spark, tmp_path):
    for name, df in bank_tables(spark, DATA_DIR).items():
        df.write.parquet(str(tmp_path / "source" / name))
    common = ["--database-prefix", "cli_", "--location", str(tmp_path / "lake")]
    source = ["--source", str(tmp_path / "source")]
    assert jobs.run(spark, jobs.parse(["land", "silver", "gold", *source, *common])) == {}
    reports = jobs.run(spark, jobs.parse(["refresh", "audit", *common]))
    assert reports["refresh"].where("layer = 'gold'").count() == len(medallion.MART_PLANS)
    assert "unique" in {row.rule for row in reports["audit"].collect()}
    pages = jobs.run(spark, jobs.parse(["pages", *common]))
    assert set(pages) == {f"page {name}" for name in ("overview", "transactions", "loans", "fraud")}
    assert all(page.count() for page in pages.values())
    with pytest.raises(SystemExit):
        jobs.run(spark, jobs.parse(["land", *common]))


def test_secrets_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("BANK_SALT", "s3cret")
    assert jobs.settings_of(jobs.parse(["silver", "--salt-env", "BANK_SALT"])).salt == "s3cret"
    with pytest.raises(SystemExit, match="NO_SUCH"):
        jobs.settings_of(jobs.parse(["silver", "--salt-env", "NO_SUCH"]))


def test_shuffles_are_sized_by_the_input(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    jobs.size_shuffles(spark, bank_tables(spark, DATA_DIR))
    assert spark.conf.get(name) == before


def test_tables_of_an_earlier_session_are_found(spark, tmp_path):
    settings = LakeSettings(database_prefix="again_", location=str(tmp_path))
    cards = table(spark, "credit_cards", dict(card_id=1, card_number_masked=" x "))
    cards.write.parquet(str(tmp_path / "again_credit_loans_bronze" / "credit_cards"))
    name = settings.bronze_table("credit_loans", "credit_cards")
    assert medallion.attach_lake(spark, settings) == [name]
    assert medallion.attach_lake(spark, settings) == [name]
    assert rows(spark.read.table(name)) == rows(cards)
    save_table(cards.limit(0), name, settings)
    assert spark.read.table(name).count() == 0
