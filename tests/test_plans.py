"""The plans, not only the rows: joins, shuffles, pruning, hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakemarts.operators import quality
from lakemarts.operators.joins import left_join, left_join_chain
from lakemarts.plans import marts
from lakemarts.registry.queries import QUERIES
from lakemarts.schemas import TABLES, ForeignKey
from lakemarts.settings import CLUSTER_CONF

DATA_DIR = "/root/testdata/sf0.001"

# These start jobs of their own before they return a frame over written tables.
WRITING = {"bronze_load", "save_roundtrip", "lakehouse_refresh"}


@contextmanager
def conf(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan_has_no_slow_path(spark, name):
    with conf(spark, **NO_BROADCAST):
        plan = plan_of(QUERIES[name](spark, DATA_DIR))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "Window"):
        assert operator not in plan
    # Nothing is broadcast once Spark's size limit for it is off.
    assert "BroadcastExchange" not in plan or name.startswith("dedup_by_key")


@pytest.mark.parametrize("mart", ["mart_financial_health", "mart_loans", "mart_loans_exact"])
def test_joins_come_after_aggregation(spark, mart):
    with conf(spark, **NO_BROADCAST):
        plan = plan_of(QUERIES[mart](spark, DATA_DIR))
    top_down = re.findall(r"(SortMergeJoin|partial_sum|partial_count)", plan)
    first_join = top_down.index("SortMergeJoin")
    assert any(step.startswith("partial") for step in top_down[first_join:])


def test_mart_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "alerts")
    QUERIES["silver_fraud_alerts"](spark, DATA_DIR).write.parquet(path)
    plan = plan_of(marts.mart_fraud(spark.read.parquet(path)))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert read == "alert_id:int,alert_type:string,risk_score:int,status:string"


def test_fraud_mart_is_one_shuffle(spark):
    alerts = spark.range(10).selectExpr(
        "id AS alert_id", "'a' AS alert_type", "'s' AS status", "1 AS risk_score"
    )
    assert plan_of(marts.mart_fraud(alerts)).count("Exchange") == 1


# --- a key that holds a third of all rows -------------------------------------

ROWS = 60_000


def hot_accounts(spark):
    return spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500))
        .alias("customer_uuid"),
        F.col("id").cast("int").alias("account_id"),
        F.lit("1.25").cast("decimal(15,2)").alias("current_balance"),
    )


def people(spark):
    names = F.concat(F.lit("c"), F.col("id"))
    keyed = spark.range(501).select(
        F.when(F.col("id") == 500, "hot").otherwise(names).alias("customer_uuid"), "id"
    )
    return keyed.selectExpr(
        "customer_uuid",
        *[f"'x' AS {c}" for c in marts.HEALTH_GRAIN[1:-1]],
        "CAST(id AS DECIMAL(12,2)) AS annual_income",
    )


def shuffled_rows(df):
    """Rows written by each exchange of a finished adaptive plan."""
    df.collect()
    counts = []

    def walk(node):
        name = node.nodeName()
        if name == "Exchange":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name.startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return counts


def test_hot_customer_is_aggregated_before_the_join(spark):
    scores = spark.createDataFrame(
        [("hot", 700, "Good", None, 1)],
        "customer_uuid string, bureau_score int, risk_rating string,"
        "debt_to_income_ratio decimal(5,2), delinquency_history_count int",
    )
    with conf(spark, **NO_BROADCAST):
        mart = marts.mart_financial_health(people(spark), hot_accounts(spark), scores)
        counts = shuffled_rows(mart)
    hot = mart.where("customer_uuid = 'hot'").first()
    assert hot.total_accounts_owned == ROWS // 3
    assert hot.total_deposit_balance == ROWS // 3 * 125 / 100
    # One exchange spreads the accounts by (customer, account) for the exact
    # distinct count; every other one carries a few rows per key and task.
    assert sorted(counts)[-2] < ROWS / 5


def test_hot_reference_is_counted_once_per_task(spark):
    children = hot_accounts(spark)
    reference = ForeignKey("customer_uuid", "customers", "customer_uuid")
    with conf(spark, **NO_BROADCAST):
        orphans = quality.orphan_keys(
            children, reference, people(spark).where("customer_uuid <> 'hot'")
        )
        counts = shuffled_rows(orphans)
    assert [tuple(r) for r in orphans.collect()] == [("hot", ROWS // 3)]
    assert max(counts) < ROWS / 5


def test_hot_copies_collapse_before_the_dedup_shuffle(spark):
    same = spark.range(ROWS).selectExpr("'x' AS a", "CAST(id % 3 AS INT) AS b")
    counts = shuffled_rows(same.dropDuplicates())
    assert max(counts) <= 3 * 8


# What counts as skewed in production, scaled down to test data.
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def joins_of(df):
    """Joins of the final plan: whether each was split."""
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    return ["skew=true" in join for join in re.findall(r"SortMergeJoin\S*", final)]


def test_hot_partners_in_a_chain_are_split(spark):
    left = people(spark).select("customer_uuid", "annual_income")
    right = hot_accounts(spark).repartition(8, "account_id")
    scores = left.select("customer_uuid", F.lit(700).alias("bureau_score"))
    force = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    assert CLUSTER_CONF[force] == "true"
    with conf(spark, **SMALL_SKEW, **{force: "true"}):
        chain = left_join_chain(left, [right, scores], "customer_uuid")
        assert joins_of(chain).count(True) == 2
        assert chain.count() == ROWS


def test_a_chain_of_left_joins_grows_in_proportion(spark):
    left = people(spark).select("customer_uuid", "annual_income")
    sizes = []
    for n in range(1, 5):
        rights = [left.withColumnRenamed("annual_income", f"x{i}") for i in range(n)]
        plan = left_join_chain(left, rights, "customer_uuid")._jdf.queryExecution().optimizedPlan()
        sizes.append(plan.toString().count("Range ("))
    steps = {b - a for a, b in zip(sizes, sizes[1:])}
    assert len(steps) == 1 and steps.pop() <= 3


def test_hot_customer_among_the_customers_is_split(spark):
    """A third of all customer rows have no key, and differ in the rest."""
    rows = spark.range(ROWS).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), "id")).alias("customer_uuid"),
        F.concat(F.lit("city"), "id").alias("city"),
        *[F.lit("x").alias(c) for c in marts.HEALTH_GRAIN[2:-1]],
        F.lit(1).cast("decimal(12,2)").alias("annual_income"),
    )
    scores = rows.selectExpr(
        "customer_uuid", "700 AS bureau_score", "'Good' AS risk_rating",
        "CAST(1 AS DECIMAL(5,2)) AS debt_to_income_ratio", "1 AS delinquency_history_count",
    )
    with conf(spark, **SMALL_SKEW):
        mart = marts.mart_financial_health(rows, hot_accounts(spark), scores)
        assert True in joins_of(mart)
        assert mart.count() == ROWS


def test_hot_partner_of_a_left_join_is_split(spark):
    left = people(spark).select("customer_uuid", "annual_income")
    right = hot_accounts(spark).repartition(8, "account_id")
    with conf(spark, **SMALL_SKEW):
        plain = left.join(right, "customer_uuid", "left")
        plain.collect()
        ours = left_join(left, right, "customer_uuid")
        ours.collect()
        assert "skew=true" not in plan_of(plain)
        assert "skew=true" in plan_of(ours)
    assert ours.count() == plain.count() == ROWS


def test_every_declared_key_is_a_declared_column():
    for spec in TABLES.values():
        named = [*spec.required, *spec.unique_keys, *spec.lengths, *spec.defaults]
        named += [r.column for r in (*spec.ranges, *spec.foreign_keys, *spec.soft_keys)]
        assert set(named) <= set(spec.columns)
