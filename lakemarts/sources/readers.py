"""Batch readers for the source tables, with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemarts.functions.text import quoted
from lakemarts.schemas import TableSpec

#: Rows per round trip of a JDBC cursor.
FETCH_SIZE = 10_000


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table (S1), as it is now: another session may have refreshed it."""
    spark.catalog.refreshTable(name)
    return spark.read.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files under ``path``, with the types they were written with."""
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, multi_line: bool = False
) -> DataFrame:
    """CSV files with one header, declared columns in their declared types.

    Columns may be absent, padded or in another case; others than the declared are
    text. A bad value fails the read. ``multi_line`` allows line breaks in quoted text,
    and then a file cannot be split between tasks.
    """
    declared = {field.name: field.dataType for field in spec.schema.fields}
    header = spark.read.csv(path, header=True, multiLine=multi_line).columns
    schema = StructType(
        [StructField(name, declared.get(name.strip().lower(), StringType())) for name in header]
    )
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        enforceSchema=False,
        mode="FAILFAST",
        multiLine=multi_line,
    )


def jdbc_options(
    spec: TableSpec, url: str, low: int, high: int, partitions: int
) -> dict[str, str]:
    """Options of a parallel JDBC read of one table.

    The serial primary key is cut into ``partitions`` ranges, each one query of
    its own. ``low`` and ``high`` only place the cuts; rows outside are
    read too. Serial keys are dense, so the ranges are even.
    """
    if partitions < 1 or high < low:
        raise ValueError("a JDBC read needs partitions >= 1 and low <= high")
    return {
        "url": url,
        "dbtable": spec.name,
        "partitionColumn": spec.primary_key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(FETCH_SIZE),
        "preferTimestampNTZ": "true",
    }


def jdbc_bounds_query(spec: TableSpec) -> str:
    """The smallest and largest key, found by the source database."""
    key = spec.primary_key
    return f"SELECT min({key}) AS low, max({key}) AS high FROM {spec.name}"


def read_jdbc(
    spark: SparkSession, spec: TableSpec, url: str, partitions: int, **credentials: str
) -> DataFrame:
    """A source database table, read in parallel. Needs the driver's jar."""
    source = spark.read.format("jdbc").options(**credentials)
    bounds = source.options(url=url, query=jdbc_bounds_query(spec)).load().first()
    low, high = (0, 0) if bounds.low is None else (bounds.low, bounds.high)
    options = jdbc_options(spec, url, low, high, partitions)
    return spark.read.format("jdbc").options(**options, **credentials).load()


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns in declared order and type, then all others as they are.

    A missing column fails here, by name; a value that does not fit its type
    fails the job under ANSI mode, see :func:`lakemarts.settings.require_ansi`.
    """
    missing = [name for name in spec.columns if name not in df.columns]
    if missing:
        raise ValueError(f"table {spec.name} lacks the columns {missing}")
    return df.select(
        *[quoted(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields],
        *[quoted(name) for name in df.columns if name not in spec.columns],
    )


def input_bytes(df: DataFrame) -> int:
    """Size of the largest source of ``df``, by its files; 0 where it is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return max([0, *[int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]])


def sample_rows(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*[F.col(name) for name in order_by]).limit(n)
