"""Where the lake lives and how it is written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Database and table names that reports are bound to.
SILVER_PREFIX = "silver_"
GOLD_DATABASE = "gold"
GOLD_TABLES = {
    "financial_health": "gold_fact_financial_health",
    "transactions": "gold_fact_transactions_analytics",
    "loans": "gold_fact_loans_and_credit",
    "loans_exact": "gold_fact_loans_and_credit_exact",
    "fraud": "gold_fact_fraud_risk",
}
#: Small tables that marts and pages are cut from; no report reads them.
STAGE_DATABASE = "gold_stage"
STAGE_TABLES = {
    "loan_totals": "stage_loan_totals",
    "transaction_totals": "stage_transaction_totals",
    "fraud_totals": "stage_fraud_totals",
}

#: Session settings for a cluster run. Adaptive execution merges small shuffle
#: partitions and splits skewed ones, but cannot split an evenly large one, so
#: the initial count has to suit the data: see :func:`shuffle_partitions`.
CLUSTER_CONF = {
    # A value that does not fit fails the job; without this it becomes null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key also where a later join on the same key then shuffles again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

#: Sizes of a shuffle partition, and how many of them before they grow.
LEAST_PARTITION_BYTES = 256 * 1024**2
MOST_PARTITION_BYTES = 2 * 1024**3
MANY_PARTITIONS = 4096


def shuffle_partitions(shuffled_bytes: int, least: int = 200) -> int:
    """Initial shuffle partitions for a shuffle of this size.

    Each holds 256 MB up to 1 TB in all. Beyond that partitions grow to 2 GB before
    their number does, since blocks and their bookkeeping grow with its square.
    """
    size = shuffled_bytes // MANY_PARTITIONS
    size = min(max(size, LEAST_PARTITION_BYTES), MOST_PARTITION_BYTES)
    return max(least, -(-shuffled_bytes // size))


def require_ansi(spark: SparkSession) -> None:
    """Raises unless values that do not fit their type fail the job."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError(
            "spark.sql.ansi.enabled is off: values that do not fit would become null unnoticed"
        )


@dataclass(frozen=True)
class LakeSettings:
    """Catalog, table format and cleaning options of one lake.

    ``catalog`` is put before every database name; leave it out for Spark's own
    session catalog, which takes single-part database names. ``database_prefix``
    keeps several lakes apart in one catalog. ``table_format`` is any installed
    writer, such as ``parquet`` or ``delta``. ``location`` is the folder for the
    databases; without one the warehouse folder of the session is used.
    """

    catalog: str | None = None
    database_prefix: str = ""
    table_format: str = "parquet"
    location: str | None = None
    write_options: Mapping[str, str] = field(default_factory=dict)
    blank_pii: str = "hash"
    salt: str | None = None
    dedup_by_key: bool = True
    strict: bool = False
    parallel_tables: int = 4
    #: Silver tables in buckets: (column, number) by table. A column with a hot key, which
    #: would fill one bucket, does not suit.
    buckets: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    #: Whether each write gets as many shuffle partitions as its input needs.
    size_shuffles: bool = True

    def database(self, domain: str, layer: str | None = None) -> str:
        name = self.database_prefix + (f"{domain}_{layer}" if layer else domain)
        return f"{self.catalog}.{name}" if self.catalog else name

    def bronze_table(self, domain: str, table: str) -> str:
        return f"{self.database(domain, 'bronze')}.{table}"

    def silver_table(self, domain: str, table: str) -> str:
        return f"{self.database(domain, 'silver')}.{SILVER_PREFIX}{table}"

    def gold_table(self, mart: str) -> str:
        return f"{self.database(GOLD_DATABASE)}.{GOLD_TABLES[mart]}"

    def stage_table(self, stage: str) -> str:
        return f"{self.database(STAGE_DATABASE)}.{STAGE_TABLES[stage]}"


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session like this one, with shuffle partitions for tables of this size in files.

    At least as many as this session has; columns unpack to about three times their files.
    Tables and views of the catalog are shared, settings are not.
    """
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sized.conf.set(key, value)
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(3 * input_bytes, at_least)))
    return sized


def cluster_session(app: str, shuffled_bytes: int | None = None) -> SparkSession:
    """A session with :data:`CLUSTER_CONF`; master and resources come from submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffled_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes))
        )
    return builder.getOrCreate()
