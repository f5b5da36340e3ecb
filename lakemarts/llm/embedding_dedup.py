"""Embedding near-duplicates with binary codes from randomised rotations.

A unit vector is rotated at random and kept as its signs, a binary code, with one
correction factor: the inner product of the vector and its code. Divided by it, the
inner product of code and another vector is an unbiased estimate of the true one, with
a confidence bound. Pairs whose bound stays below the limit are dropped, all others
are computed again from the vectors in double precision.

Candidates come from the codes of further rotations. Vectors with one label that agree
in all bits of a band meet; bits per band grow with the logarithm of the label's size,
and so many bands are used that a pair at the limit misses all of them with a
probability of 1e-6. Each pair counts in the first band where it meets.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import list_array, mix
from lakemarts.llm.components import connected_components
from lakemarts.llm.frames import written

SIMILARITY = 0.93
MISSED = 1e-6
#: Standard deviations of the confidence bound of an estimate.
CONFIDENCE = 6.0
#: Vectors of one bucket that meet in one task; larger buckets are cut into blocks.
BLOCK = 512


def rotation(dimensions: int, number: int) -> np.ndarray:
    """The same random rotation on every machine."""
    random = np.random.default_rng((dimensions, number))
    q, r = np.linalg.qr(random.standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def band_shape(largest: int, similarity: float = SIMILARITY, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a band and number of bands for labels of up to ``largest`` vectors."""
    bits = min(30, max(6, ceil(log2(max(largest, 2))) + 2))
    agree = (1 - acos(similarity) / pi) ** bits
    return bits, ceil(log(missed) / log(1 - agree))


def _unit(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors in double precision, by number of dimensions."""
    sizes = column.value_lengths().to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    found = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        vectors = values[starts[rows][:, None] + np.arange(size)]
        # Scaled first, so that squares of very large or small values stay finite.
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        found.append((rows, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)))
    return found


def _band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The bits of each band as a number."""
    size = unit.shape[1]
    signs = np.hstack(
        [unit @ rotation(size, 1 + number).T >= 0 for number in range(-(-bits * bands // size))]
    )[:, : bits * bands]
    return signs.reshape(len(unit), bands, bits) @ (1 << np.arange(bits, dtype=np.uint32))


def _buckets(batches, bits: int, bands: int):
    for batch in batches:
        labels = batch.column("label_hash").to_numpy().view(np.uint64)
        for rows, unit in _unit(batch.column("vector")):
            keys = _band_keys(unit, bits, bands).astype(np.uint64)
            salt = mix(labels[rows] + np.uint64(unit.shape[1]))[:, None] + np.arange(bands, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid").take(pa.array(rows)),
                    list_array(
                        pa.array(mix(keys ^ mix(salt)).view(np.int64).ravel()), np.full(len(rows), bands)
                    ),
                ],
                ["uid", "buckets"],
            )


def _links_of_group(group: dict[str, np.ndarray], similarity: float):
    """Pairs (row, row) of a sorted run of groups that are linked, by their distance."""
    unit, keys, band = group["unit"], group["keys"], group["band"]
    size = unit.shape[1]
    turned = unit @ rotation(size, 0).T
    code = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(size)
    factor = np.einsum("ij,ij->i", code, turned)
    error = CONFIDENCE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(size - 1, 1))
    number, n = group["number"], len(unit)
    for apart in range(1, n):
        left = np.flatnonzero(number[apart:] == number[: n - apart])
        if not len(left):
            break
        right = left + apart
        meets = (group["block"][left] != group["block"][right]) | group["alone"][left]
        meets &= (group["size"][left] == group["size"][right]) & (group["label"][left] == group["label"][right])
        left, right = left[meets], right[meets]
        # A pair that met in an earlier band has been seen there.
        for first in range(0, keys.shape[1], 8):
            part = slice(first, first + 8)
            earlier = np.arange(keys.shape[1])[part] < band[left][:, None]
            seen = ((keys[left, part] == keys[right, part]) & earlier).any(axis=1)
            left, right = left[~seen], right[~seen]
        estimate = np.einsum("ij,ij->i", code[left], turned[right]) / factor[left]
        open_ = estimate + error[left] >= similarity
        left, right = left[open_], right[open_]
        near = np.einsum("ij,ij->i", unit[left], unit[right]) >= similarity
        yield left[near], right[near]


def _spanning(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the pairs to connect what they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def _linked(batches, bits: int, bands: int, similarity: float):
    """Of sorted groups: how many rows each vector links with, and edges that connect them."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        column = lambda name: table.column(name).to_numpy()
        uid, copies = column("uid"), column("copies")
        keys = [column(name) for name in ("bucket", "i", "j")]
        change = np.ones(len(uid), bool)
        change[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
        number, out = np.cumsum(change), []
        for rows, unit in _unit(table.column("vector").combine_chunks()):
            group = {
                "unit": unit,
                "keys": _band_keys(unit, bits, bands),
                "band": column("band")[rows],
                "number": number[rows],
                "block": column("block")[rows],
                "alone": (keys[1] == keys[2])[rows],
                "size": np.full(len(rows), unit.shape[1]),
                # Buckets are hashes: two labels may share one.
                "label": column("label_hash")[rows],
            }
            pairs = list(_links_of_group(group, similarity))
            if not pairs:
                continue
            left, right = (rows[np.concatenate(side)] for side in zip(*pairs))
            weight = np.bincount(left, copies[right], len(uid)) + np.bincount(right, copies[left], len(uid))
            some = np.flatnonzero(weight)
            edges = _spanning(uid[left], uid[right])
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([uid[some], [a for a, _ in edges]]).astype(np.int64)),
                        pa.array([None] * len(some) + [b for _, b in edges], pa.int64()),
                        pa.array(np.concatenate([weight[some], np.zeros(len(edges))]).astype(np.int64)),
                    ],
                    ["uid", "other", "links"],
                )
            )
        return out

    def key_at(batch, row):
        return tuple(batch.column(name)[row].as_py() for name in ("bucket", "i", "j"))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        last = key_at(batch, batch.num_rows - 1)
        keys = [table.column(name).to_numpy() for name in ("bucket", "i", "j")]
        same = np.all([key == value for key, value in zip(keys, last)], axis=0)
        cut = int(np.argmax(same))
        yield from work(table.slice(0, cut))
        held = table.slice(cut).to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    missed: float = MISSED,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Two rows link when their labels are equal and not null, their vectors have as many
    components, and the cosine is at least ``similarity``. Vectors that are null, empty
    or zero, or hold null or non-finite components, link with nothing; their component
    is their own id. Rows with the same vector and label are compared once and count as
    often as they occur, also where they repeat a vec_id. ``kept`` is null for a null id.
    """
    rows = vectors.select(
        vectors[id_col].alias("vec_id"),
        vectors[label_col].alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    some = F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False)))
    valid = F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))
    rows = rows.withColumn("uid", F.when(valid, F.xxhash64("label", "vector")))
    classes = written(
        rows.filter("uid is not null")
        .groupBy("label", "vector", "uid")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("label_hash", F.xxhash64("label"))
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = band_shape(largest, similarity, missed)
    met = written(
        classes.select("uid", "label_hash", "vector").mapInArrow(
            lambda batches: _buckets(batches, bits, bands), "uid bigint, buckets array<bigint>"
        )
    ).select("uid", F.posexplode("buckets").alias("band", "bucket"))
    full = written(met.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    dealt = (
        met.join(full, "bucket")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(uid), blocks) as int)"))
    )
    # A bucket of several blocks meets in all pairs of them, each in its own group.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = dealt.withColumn("other", other).select(
        "bucket", "band", "uid", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    linked = written(
        groups.join(classes.select("uid", "label_hash", "vector", "copies"), "uid")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "uid")
        .mapInArrow(
            lambda batches: _linked(batches, bits, bands, similarity),
            "uid bigint, other bigint, links bigint",
        )
    )
    counts = linked.groupBy("uid").agg(F.sum("links").alias("others"))
    parts = connected_components(linked.filter("other is not null"), "uid", "other").withColumnRenamed("node", "uid")
    named = classes.select("uid", "first", "copies").join(parts, "uid", "left")
    named = written(named.withColumn("component", F.coalesce("component", "uid")))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = (
        named.join(least, "component")
        .join(counts, "uid", "left")
        .select("uid", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    result = rows.select("vec_id", "uid").join(written(per_class), "uid", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
