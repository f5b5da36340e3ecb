"""LEFT equi joins by shared column names.

Spark can split a hot key only on the row-keeping side of an outer join, so one
customer owning a third of all accounts would end up in a single task when the
accounts stand on the right. Here the right side is completed first: left keys it
lacks, the null key among them, get one row of nulls. What follows is an inner join
in which nulls match, and adaptive execution can split either side of it. Where the
right side holds one row per key, as in the marts, a plain LEFT join does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.functions.text import quoted


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """LEFT join on ``key``, 1:N (J1). ``key`` comes first and appears once.

    Null keys match nothing and their left rows are kept.
    """
    return left_join_chain(left, [right], key)


def left_join_chain(left: DataFrame, rights: Sequence[DataFrame], key: str) -> DataFrame:
    """LEFT joins with several tables on the same key.

    A LEFT join keeps the set of left keys, so these are found once, the left side is read
    twice, and the plan grows in proportion to the number of tables. All but the last join
    hand their partitioning on to the next. Spark gives that up to split a hot key only under
    ``spark.sql.adaptive.forceOptimizeSkewedJoin``, which the cluster settings turn on.
    """
    ordered = [quoted(key), *[quoted(name) for name in left.columns if name != key]]
    joined, keys = left.select(ordered), left.select(quoted(key)).distinct()
    # A name that no column has.
    names = [name for df in (left, *rights) for name in df.columns]
    match = max(map(len, names)) * "_" + "_key"
    for right in rights:
        completed = _completed(right, keys, key, match)
        joined = joined.join(completed, joined[key].eqNullSafe(completed[match])).drop(match)
    return joined


def _completed(right: DataFrame, keys: DataFrame, key: str, match: str) -> DataFrame:
    """``right`` with its key named ``match``, and a row of nulls for every key it lacks."""
    fields = [field for field in right.schema.fields if field.name != key]
    known = right.where(quoted(key).isNotNull()).select(
        quoted(key).alias(match), *[quoted(field.name) for field in fields]
    )
    lacking = keys.join(right.select(quoted(key)), key, "left_anti").select(
        quoted(key).alias(match),
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in fields],
    )
    return known.union(lacking)
