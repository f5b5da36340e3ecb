"""Helpers for the plans: written intermediate results and null-safe joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_
from weakref import WeakKeyDictionary

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it.

    A local session that names none gets one in its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder


#: Folder of each written table that may still be discarded.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Lists that get the folder of every table written, see :func:`folders_written`.
_RECORDS: list[list[str]] = []


def written(frame: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """The rows, computed once and kept as Parquet in the shared folder.

    Losing an executor then loses nothing, what follows does not compute them again, and
    a reader takes only the columns it needs. ``replaces`` is an earlier written table
    that is not needed any more: its files go. What is left lies in the shared folder
    under the application's id, and may be deleted when the application has ended.
    """
    spark = frame.sparkSession
    folder = f"{shared_folder(spark)}/lakemarts-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    frame.write.parquet(folder)
    rows = spark.read.schema(frame.schema).parquet(folder)
    _FOLDERS[rows] = folder
    for record in _RECORDS:
        record.append(folder)
    if replaces is not None:
        discard(replaces)
    return rows


def discard(*tables: DataFrame) -> None:
    """Delete the files of written tables; nothing may read them afterwards."""
    for rows in tables:
        folder = _FOLDERS.pop(rows, None)
        if folder is not None:
            delete_folder(rows.sparkSession, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def folders_written() -> Iterator[list[str]]:
    """A list of the folders of all tables written meanwhile, for who deletes them later."""
    _RECORDS.append(record := [])
    try:
        yield record
    finally:
        _RECORDS.remove(record)


def left_join_null_safe(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """LEFT join where null keys match; the keys are returned once, from the left."""
    renamed = right.withColumnsRenamed({name: f"__{name}" for name in names})
    condition = reduce(and_, [left[name].eqNullSafe(renamed[f"__{name}"]) for name in names])
    return left.join(renamed, condition, "left").drop(*[f"__{name}" for name in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``doc_id``, ``text_hash`` and ``text`` (null text: empty).

    Both keys together tell rows apart that repeat a doc_id with another text;
    rows equal in both have equal results.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


#: Bits of a membership filter: 8 MB. One that is sized by its values has at least some
#: twelve bits for each, up to 32 MB. A full one lets more rows through, which the join
#: behind it then rejects.
FILTER_BITS = 26
MOST_FILTER_BITS = 28
BITS_PER_VALUE = 12


def membership_filter(
    values: DataFrame, name: str, bits: int = FILTER_BITS, sized: bool = False
) -> Broadcast:
    """Bloom filter of a column of 64-bit hashes, for :func:`might_hold`."""
    if sized:
        bits = min(max((values.count() * BITS_PER_VALUE).bit_length(), bits), MOST_FILTER_BITS)
    mask = (1 << bits) - 1
    slots = F.array(
        F.col(name).bitwiseAND(mask), F.shiftright(name, 32).bitwiseAND(mask)
    )
    # At most one row for each 64 bits of the filter reaches the driver.
    cells = (
        values.select(F.explode(slots).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    known = np.zeros(1 << (bits - 6), np.int64)
    known[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return values.sparkSession.sparkContext.broadcast(known)


def might_hold(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False where a hash is surely not among the filter's values."""
    mask = np.uint64(len(known) * 64 - 1)
    hashes = hashes.view(np.uint64)
    one = (hashes & mask).astype(np.int64)
    two = ((hashes >> np.uint64(32)) & mask).astype(np.int64)
    return ((known[one >> 6] >> (one & 63)) & (known[two >> 6] >> (two & 63)) & 1) == 1
