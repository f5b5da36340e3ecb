"""Dirt profile and case repair of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.functions.text import case_key, quoted
from lakemarts.operators.cleaning import string_columns


def dirt_profile(df: DataFrame) -> DataFrame:
    """How dirty each string column is.

    ``column_name, total_rows, null_rows, blank_rows, padded_rows, values_seen,
    values_merged, variant_rows``: ``values_seen`` counts trimmed spellings,
    ``values_merged`` what is left of them when case is ignored too, and
    ``variant_rows`` the rows of values that occur in several spellings.

    Trimmed values are counted before anything else, with partial aggregation,
    and every later step works on those counts. This avoids the row expansion
    that several distinct counts in one aggregate would cost. A table without
    string columns has an empty report.
    """
    columns = string_columns(df)
    if not columns:
        counts = "total_rows null_rows blank_rows padded_rows values_seen values_merged variant_rows"
        schema = ", ".join(["column_name string", *[f"{name} bigint" for name in counts.split()]])
        return df.sparkSession.createDataFrame([], schema)
    cells = df.unpivot([], [quoted(name) for name in columns], "column_name", "value")
    values = cells.groupBy("column_name", F.trim("value").alias("spelling")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.trim("value") != F.col("value")).alias("padded"),
    )
    merged = values.groupBy("column_name", F.lower("spelling").alias("merged")).agg(
        F.sum("n").alias("n"),
        F.sum("padded").alias("padded"),
        F.count(F.lit(1)).alias("variants"),
    )
    present = F.col("merged").isNotNull() & (F.col("merged") != "")

    def total(rows: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(rows)).otherwise(0))

    return merged.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        total("n", F.col("merged").isNull()).alias("null_rows"),
        total("n", F.col("merged") == "").alias("blank_rows"),
        total("padded", present).alias("padded_rows"),
        total("variants", present).alias("values_seen"),
        F.count_if(present).alias("values_merged"),
        total("n", present & (F.col("variants") > 1)).alias("variant_rows"),
    )


def canonical_case(df: DataFrame, column: str, spellings: Sequence[str]) -> DataFrame:
    """Variants of the listed values brought to the listed spelling.

    For a list known to the caller; it becomes a map literal in the projection,
    without a join. Other values are kept as they are.
    """
    by_key = {spelling.strip(" ").lower(): spelling for spelling in spellings}
    if not by_key:
        return df
    entries = [F.lit(text) for pair in by_key.items() for text in pair]
    value = quoted(column)
    listed = F.create_map(*entries)[case_key(value)]
    return df.withColumn(column, F.coalesce(listed, value))


def canonical_case_from(
    df: DataFrame, column: str, dictionary: DataFrame, spelling: str
) -> DataFrame:
    """As :func:`canonical_case`, with the spellings in a table of any size.

    The dictionary is reduced to one spelling per key (the smallest), so the
    join keeps the row count. Spark chooses the join by size: the dictionary
    is broadcast when small; else rows with a hot value are split.
    """
    # Names that no column of the caller has.
    unused = max([len(name) for name in df.columns], default=0) * "_"
    key, listed = f"{unused}_key", f"{unused}_listed"
    known = (
        dictionary.groupBy(case_key(quoted(spelling)).alias(key))
        .agg(F.min(quoted(spelling)).alias(listed))
        .where(F.col(key).isNotNull())
    )
    value = quoted(column)
    return (
        df.join(known, case_key(value) == F.col(key), "left")
        .withColumn(column, F.coalesce(F.col(listed), value))
        .drop(key, listed)
    )


def learned_spellings(df: DataFrame, column: str) -> DataFrame:
    """One spelling for each value of a column: ``spelling, value_rows, spellings``.

    Trimmed spellings that differ in case only are one value. The spelling that most rows
    have stands for it, of equally frequent ones the smallest; ``value_rows`` and
    ``spellings`` count the rows and spellings of the value. Nulls and blanks have none.
    Rows are counted before they are shuffled, so a value that fills a third of them is a
    row per task.
    """
    value = F.trim(quoted(column))
    counted = (
        df.select(value.alias("spelling"))
        .where("spelling IS NOT NULL AND spelling <> ''")
        .groupBy("spelling")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The least of (-rows, spelling) is the most frequent spelling, of those the smallest.
    best = F.min(F.struct((-F.col("n")).alias("fewer"), F.col("spelling"))).alias("best")
    return (
        counted.groupBy(case_key(F.col("spelling")).alias("key"))
        .agg(best, F.sum("n").alias("value_rows"), F.count(F.lit(1)).alias("spellings"))
        .select(F.col("best.spelling").alias("spelling"), "value_rows", "spellings")
    )


def canonical_case_learned(df: DataFrame, column: str) -> DataFrame:
    """As :func:`canonical_case`, with the spellings learned from the column itself.

    Every value gets its most frequent spelling, see :func:`learned_spellings`; no list is
    needed. Nulls and blanks stay as they are.
    """
    return canonical_case_from(df, column, learned_spellings(df, column), "spelling")
