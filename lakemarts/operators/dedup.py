"""De-duplication that avoids the full-width shuffle where it can.

``dropDuplicates`` over all columns sends every column of every row through a
shuffle, which is the dearest Silver step on the transactions. Two rows that
are equal are also equal in the key. So a row whose key occurs once is
distinct already, and only rows of repeated keys have to be compared. Counting
the keys shuffles one narrow column, partially aggregated. Where keys repeat too often,
or there is none, a 64-bit hash of all columns takes the place of the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lakemarts.functions.text import quoted
from lakemarts.operators.cleaning import dedup_rows

#: Repeated keys (or blocks of them) are broadcast up to this many; eight bytes
#: and a hash entry each, so below about 100 MB on an executor.
BROADCAST_KEYS = 1_000_000

#: With a larger part of the rows to compare, a second scan does not pay off.
WORTH_SPLITTING = 0.1

#: A block is a run of 2**16 neighbouring keys. A replayed batch of a serial key
#: repeats runs of keys, so a few blocks stand for very many of them.
BLOCK_BITS = 16


def is_integer_key(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, IntegralType)


def dedup_by_key(
    df: DataFrame,
    key: str,
    clean: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    broadcast_keys: int = BROADCAST_KEYS,
    worth_splitting: float = WORTH_SPLITTING,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``dedup_rows(clean(df))``, found by way of an integer ``key`` column.

    ``clean`` has to work row by row and leave the key as it is, and ``df`` has to give
    the same rows each time it is read, as written tables do. One Spark job counts the
    keys; its figures then pick the cheapest plan. All plans give the same rows, and
    the last three parameters only steer the choice:

    * no key repeated: nothing to drop, no wide shuffle at all;
    * few repeated, or many in few blocks: only the rows of those keys or
      blocks are shuffled and compared;
    * else the rows are hashed, see :func:`dedup_by_hash`.
    """
    if not is_integer_key(df, key):
        raise ValueError(f"dedup_by_key needs an integer key, {key!r} is not one")
    keys = df.groupBy(quoted(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1
    blocks = keys.groupBy(F.shiftright("k", block_bits).alias("k")).agg(
        F.sum("n").alias("n"),
        F.count_if(repeated).alias("keys"),
        F.sum(F.when(repeated, F.col("n")).otherwise(0)).alias("rows"),
    )
    suspect = F.col("keys") > 0
    found = blocks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("key_rows"),
        F.count_if(suspect).alias("blocks"),
        F.coalesce(F.sum(F.when(suspect, F.col("n"))), F.lit(0)).alias("block_rows"),
    ).first()
    most_rows = worth_splitting * found.all_rows
    if found.keys == 0:
        return clean(df)
    if found.keys <= broadcast_keys and found.key_rows <= most_rows:
        return _compare_only(df, quoted(key), keys.where(repeated), clean)
    if found.keys > broadcast_keys >= found.blocks and found.block_rows <= most_rows:
        return _compare_only(df, F.shiftright(quoted(key), block_bits), blocks.where(suspect), clean)
    return dedup_by_hash(clean(df), broadcast_keys, worth_splitting)


def dedup_by_hash(
    df: DataFrame, broadcast_keys: int = BROADCAST_KEYS, worth_splitting: float = WORTH_SPLITTING
) -> DataFrame:
    """``dedup_rows(df)``, where rows whose hash of all columns occurs once stay as they are.

    Equal rows have equal hashes, nulls, NaNs and signed zeros included; other rows of one
    hash are compared in full. ``df`` has to give the same rows each time it is read. With
    too many rows of repeated hashes all rows are shuffled and compared.
    """
    hashed = F.xxhash64(*[quoted(name) for name in df.columns])
    hashes = df.groupBy(hashed.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1
    found = hashes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
        F.count_if(repeated).alias("keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("key_rows"),
    ).first()
    if found.keys == 0:
        return df
    if found.keys <= broadcast_keys and found.key_rows <= worth_splitting * found.all_rows:
        return _compare_only(df, hashed, hashes.where(repeated), lambda rows: rows)
    return dedup_rows(df)


def _compare_only(
    df: DataFrame, block: Column, blocks: DataFrame, clean: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    # The caller has counted these and found them to be few.
    few = F.broadcast(blocks.select(F.col("k").alias("__repeated")))
    suspect = block.eqNullSafe(F.col("__repeated"))
    single = df.join(few, suspect, "left_anti")
    several = df.join(few, suspect, "left_semi")
    return clean(single).unionByName(dedup_rows(clean(several)))
