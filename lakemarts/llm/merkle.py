"""Merkle manifest of a dataset, with proofs regenerated from few stored levels.

Rows are leaves. Within a group they stand in the order of their ids, and every three
consecutive nodes have one parent, up to the group's root; the roots of the groups are
the leaves of one more tree. Only every ``STRIDE`` levels are stored: a stored row is an
aligned block of up to 3 ** STRIDE consecutive nodes. A proof is made from the top down:
each block computes its inner nodes again, gives the siblings of each of its nodes, and
drops the inner nodes.

A node is the SHA-256 of its children's digests as lowercase hex, joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.frames import discard, written

FANOUT = 3
#: Levels from one stored level to the next, so a block has up to 81 nodes.
STRIDE = 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SIDES = "array<struct<left: string, right: string>>"


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(columns: list[Column]) -> Column:
    return hashed(F.concat(*[field(column) for column in columns]))


def group_key(group: Column) -> Column:
    """A string that is never null and sorts as the group does, null first."""
    text = group.cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))


def positioned(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``position`` from 0 within ``key``, and ``levels`` above the key's leaves.

    Rows are range-partitioned, so one key may take many partitions: each counts its rows
    of a key, and the counts of the partitions before are added.
    """
    numbered = written(
        rows.repartitionByRange("key", *order)
        .sortWithinPartitions("key", *order)
        .withColumn("row", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("row", 33))
    # At most one row for each key and partition.
    parts = numbered.groupBy("key", "part").agg(F.min("row").alias("first"), F.count("*").alias("here"))
    ordered = Window.partitionBy("key").orderBy("part")
    before = F.sum("here").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "key",
        "part",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        height(F.sum("here").over(Window.partitionBy("key"))).alias("levels"),
    )
    return (
        numbered.join(parts, ["key", "part"])
        .withColumn("position", F.col("row") + F.col("shift"))
        .drop("row", "part", "shift")
    )


def height(n: Column) -> Column:
    """Levels above ``n`` leaves: none for one."""
    # 3 ** 39 leaves are more than 61 bits can count.
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(38)), lambda k: F.pow(F.lit(3.0), k) < n))


def _parents(nodes: Column) -> Column:
    """Digests of the next level of an aligned run of digests."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int")),
        lambda i: hashed(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "")),
    )


def _inner_levels(nodes: Column, levels: Column) -> Column:
    """The block's ``levels`` levels from ``nodes`` on, without the last: array of arrays."""
    return F.aggregate(
        F.when(levels > 1, F.sequence(F.lit(2), levels)).otherwise(F.array().cast("array<int>")),
        F.array(nodes),
        lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))),
    )


def _sides(inner: Column, index: Column) -> Column:
    """Siblings to the left and right of node ``index``, level by level, as joined digests."""
    def side(nodes: Column, level: Column) -> Column:
        at = F.floor(index / F.pow(F.lit(FANOUT), level)).cast("int")
        first = at - at % FANOUT
        return F.struct(
            F.array_join(F.slice(nodes, first + 1, at - first), "").alias("left"),
            F.array_join(F.slice(nodes, at + 2, FANOUT - 1 - (at - first)), "").alias("right"),
        )

    return F.transform(inner, side)


def folded(start: Column, sides: Column) -> Column:
    """The root that follows from a digest and its siblings, level by level."""
    return F.aggregate(
        sides, start, lambda node, side: hashed(F.concat(side["left"], node, side["right"]))
    )


def siblings(sides: Column) -> Column:
    """All sibling digests, level by level, left to right, joined."""
    return F.array_join(F.transform(sides, lambda side: F.concat(side["left"], side["right"])), "")


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Aligned blocks of the nodes ``key, position, levels, digest``; at most 81 nodes each."""
    size = FANOUT**STRIDE
    return (
        nodes.groupBy("key", F.floor(F.col("position") / size).alias("block"))
        .agg(
            F.first("levels").alias("levels"),
            F.sort_array(F.collect_list(F.struct("position", "digest", *payload))).alias("nodes"),
        )
    )


def _with_inner(blocks: DataFrame) -> DataFrame:
    """Blocks with ``here``, the levels they span, and their ``inner`` levels."""
    digests = F.transform("nodes", lambda node: node["digest"])
    here = F.least("levels", F.lit(STRIDE))
    return blocks.withColumn("here", here).withColumn("inner", _inner_levels(digests, F.col("here")))


def _tops(blocks: DataFrame) -> DataFrame:
    """The node above each block, as node of the next stored level."""
    last = F.element_at("inner", -1)
    # A group of one leaf has no level above: the leaf is the root.
    top = F.when(F.col("here") > 0, F.element_at(_parents(last), 1)).otherwise(F.element_at(last, 1))
    return _with_inner(blocks).select(
        "key",
        F.col("block").alias("position"),
        (F.col("levels") - F.col("here")).alias("levels"),
        top.alias("digest"),
    )


def stored_tree(leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Written blocks of every ``STRIDE``-th level, from the leaves up.

    ``leaves`` has ``key, position, levels, digest`` and the columns of ``payload``, which
    only the lowest blocks keep. A key is in the tables up to the one whose block ends its
    tree: the block with at most ``STRIDE`` levels left.
    """
    stored = [written(_blocks(leaves, payload))]
    while True:
        going_on = stored[-1].filter(F.col("levels") > STRIDE)
        if going_on.isEmpty():
            return stored
        stored.append(written(_blocks(_tops(going_on), [])))


def roots(stored: list[DataFrame]) -> DataFrame:
    """``key, root`` of each key, from the block that ends its tree."""
    ends = [_tops(blocks.filter(F.col("levels") <= STRIDE)) for blocks in stored]
    return reduce(DataFrame.union, ends).select("key", F.col("digest").alias("root"))


def proofs(stored: list[DataFrame], above: DataFrame) -> DataFrame:
    """``key, position, digest``, the payload, ``subroot``, and ``sides`` up to the root.

    ``above`` has ``key``, ``subroot`` and ``sides``: each key's root, and what follows it.
    """
    size = FANOUT**STRIDE
    path = None
    for level in range(len(stored) - 1, -1, -1):
        blocks = _with_inner(stored[level])
        ending = blocks.filter(F.col("levels") <= STRIDE).join(above, "key")
        parts = ending
        if path is not None:
            inner = blocks.filter(F.col("levels") > STRIDE).join(
                path.select("key", F.col("position").alias("block"), "subroot", "sides"), ["key", "block"]
            )
            parts = parts.unionByName(inner)
        path = (
            parts.withColumn("node", F.explode("nodes"))
            .select(
                "key",
                "node.*",
                "subroot",
                F.concat(
                    F.when(
                        F.col("here") > 0,
                        _sides(F.col("inner"), (F.col("node.position") % size).cast("int")),
                    ).otherwise(F.array().cast(_SIDES)),
                    "sides",
                ).alias("sides"),
            )
        )
    return path


def manifest(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "source",
    leaf_cols: tuple[str, ...] = LEAF_COLUMNS,
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, roots and proof.

    Returns ``doc_id, leaf, subroot, root, siblings`` (joined digests from the leaf up),
    ``changed_leaf`` (of the columns replaced by ``changed``), ``folded_root`` (from the
    changed leaf and the siblings) and ``verified`` (whether that is the root).

    Nulls are leaves' fields of their own, and a null group is a group, ordered first.
    Rows of a group stand by id, null first, rows of one id by their leaf; rows that are
    equal in all leaf columns are leaves of their own. Texts of any length are hashed
    whole. No rows give no rows. Columns of other names are ignored, and no column of
    ``docs`` can clash, since only the named ones are read.
    """
    changed = changed or {}
    columns = [docs[name] for name in leaf_cols]
    other = [changed.get(name, docs[name]) for name in leaf_cols]
    leaves = written(
        docs.select(
            group_key(docs[group_col]).alias("key"),
            docs[id_col].alias("doc_id"),
            leaf(columns).alias("digest"),
            leaf(other).alias("changed_leaf"),
            # Spreads equal rows over partitions.
            F.monotonically_increasing_id().alias("spread"),
        )
    )
    tree = stored_tree(positioned(leaves, ["doc_id", "digest", "spread"]), ["doc_id", "changed_leaf"])
    discard(leaves)
    subroots = written(roots(tree))
    # They are the leaves of one tree more, under one empty key.
    leaves = subroots.select(
        F.lit("").alias("key"), F.col("key").alias("group"), F.col("root").alias("digest")
    )
    top = stored_tree(positioned(leaves, ["group"]), ["group"])
    root = next((row["root"] for row in roots(top).collect()), None)  # one row, none of no rows
    end = docs.sparkSession.createDataFrame([("", "", [])], f"key string, subroot string, sides {_SIDES}")
    above = written(
        proofs(top, end).select(F.col("group").alias("key"), F.col("digest").alias("subroot"), "sides")
    )
    return (
        proofs(tree, above)
        .select(
            "doc_id",
            F.col("digest").alias("leaf"),
            "subroot",
            F.lit(root).cast("string").alias("root"),
            siblings(F.col("sides")).alias("siblings"),
            "changed_leaf",
            folded(F.col("changed_leaf"), F.col("sides")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def tampered(id_column: Column, text: Column) -> Column:
    """The text without line feeds where 2 divides the CRC-32 of the id as decimal text."""
    even = F.crc32(id_column.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
