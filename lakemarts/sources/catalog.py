"""Databases and tables that survive a failed refresh.

A refresh of a table of plain files never touches what is there. It writes a folder of its
own, commits it with a small marker file, and only then lets the catalog point there. A job
that dies before the marker leaves the old rows current, and one that dies after it the new
ones: whichever folder the newest marker names. The folder before the current one is kept,
for readers that have started on it; older ones go. A transactional format does all this
by itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lakemarts.settings import LakeSettings

#: Formats whose tables keep their own versions.
TRANSACTIONAL = ("delta", "iceberg", "hudi")
#: Folder of the markers inside a table's folder.
MARKERS = "_versions"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the checkpoint folder that the cluster names.

    Where the session names none, the warehouse folder is used, which all executors
    share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def create_database(spark: SparkSession, name: str, settings: LakeSettings) -> None:
    """The database, unless it is there already (S3)."""
    place = f" LOCATION '{settings.location}/{name}'" if settings.location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def table_path(name: str, settings: LakeSettings) -> str:
    database, table = name.rsplit(".", 1)
    return f"{settings.location}/{database}/{table}"


def _table_folder(spark: SparkSession, name: str, settings: LakeSettings) -> str:
    if settings.location:
        return table_path(name, settings)
    database, table = name.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


class _Folder:
    """A table's folder in whatever file system it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = spark._jvm.org.apache.commons.io.IOUtils

    def names(self, below: str = "") -> list[str]:
        place = self._new(f"{self.path}/{below}" if below else self.path)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._new(f"{self.path}/{name}"))
        try:
            return bytes(self._utils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A file that appears whole or not at all."""
        draft = self._new(f"{self.path}/{name}.draft")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(draft, self._new(f"{self.path}/{name}")):
            raise OSError(f"{self.path}/{name} could not be committed")

    def delete(self, name: str) -> None:
        self._fs.delete(self._new(f"{self.path}/{name}"), True)


def _versions(folder: _Folder) -> list[str]:
    """Committed versions, oldest first."""
    return [name for name in folder.names(MARKERS) if not name.endswith(".draft")]


def _versioned(settings: LakeSettings) -> bool:
    return settings.table_format not in TRANSACTIONAL


def attach_table(spark: SparkSession, name: str, settings: LakeSettings) -> bool:
    """Makes a table that an earlier session wrote under ``location`` known again.

    For sessions without a lasting catalog: the newest committed version, with its buckets.
    Returns whether the table is there.
    """
    if spark.catalog.tableExists(name):
        return True
    path = table_path(name, settings)
    folder = _Folder(spark, path)
    committed = _versions(folder) if _versioned(settings) else []
    buckets = json.loads(folder.read(f"{MARKERS}/{committed[-1]}"))["buckets"] if committed else None
    if committed:
        path = f"{path}/{committed[-1]}"
    try:
        schema = spark.read.format(settings.table_format).load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    if buckets:
        column, number = buckets
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING {settings.table_format}"
            f" CLUSTERED BY (`{column}`) INTO {number} BUCKETS LOCATION '{path}'"
        )
    else:
        spark.catalog.createTable(name, path=path, source=settings.table_format, schema=schema)
    return True


def save_table(
    df: DataFrame,
    name: str,
    settings: LakeSettings,
    buckets: tuple[str, int] | None = None,
    facts: Callable[[], Any] = lambda: None,
) -> None:
    """Full refresh of a table, schema included.

    With a ``location`` the table lies there, whatever catalog is in use; without, in the
    folder of its database. Tables of plain files are written beside the rows they replace,
    see above, in ``buckets`` of a column if given; ``facts`` is called after the write, and
    what it returns is kept with the version, see :func:`table_facts`. A table cannot be
    refreshed from its own rows.
    """
    if not _versioned(settings):
        writer = df.write.format(settings.table_format).mode("overwrite")
        # They keep the old schema unless told otherwise.
        writer = writer.option("overwriteSchema", "true")
        if settings.location:
            writer = writer.option("path", table_path(name, settings))
        writer.options(**settings.write_options).saveAsTable(name)
        return
    spark = df.sparkSession
    if name in _tables_read(df):
        raise AnalysisException(f"cannot overwrite the table {name} that is also being read from")
    folder = _Folder(spark, _table_folder(spark, name, settings))
    number = int(max(_versions(folder), default="v0").split("-")[0][1:]) + 1
    version = f"v{number:09d}-{uuid.uuid4().hex[:8]}"
    draft = f"{name}__{version.replace('-', '_')}"
    if buckets:
        # A task for each bucket, which then is one file.
        df = df.repartition(buckets[1], buckets[0])
    writer = df.write.format(settings.table_format).option("path", f"{folder.path}/{version}")
    if buckets:
        writer = writer.bucketBy(buckets[1], buckets[0])
    writer.options(**settings.write_options).saveAsTable(draft)
    folder.create(f"{MARKERS}/{version}", json.dumps({"buckets": buckets, "facts": facts()}))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
    _forget(folder, version)


def _forget(folder: _Folder, current: str) -> None:
    """Delete all versions but the current and the one before it, and failed writes."""
    kept = {current, *[name for name in _versions(folder) if name < current][-1:]}
    for name in _versions(folder):
        if name < current and name not in kept:
            folder.delete(f"{MARKERS}/{name}")
    for name in folder.names():
        # A greater name belongs to a write that is still going on.
        if name.startswith("v") and name < current and name not in kept:
            folder.delete(name)


def table_facts(spark: SparkSession, name: str, settings: LakeSettings) -> Any:
    """What was kept with the current version of a table; None if nothing was."""
    if not _versioned(settings):
        return None
    folder = _Folder(spark, _table_folder(spark, name, settings))
    committed = _versions(folder)
    return json.loads(folder.read(f"{MARKERS}/{committed[-1]}"))["facts"] if committed else None


def _tables_read(df: DataFrame) -> set[str]:
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() == "LogicalRelation" and leaf.catalogTable().isDefined():
            found.add(leaf.catalogTable().get().identifier().unquotedString().removeprefix("spark_catalog."))
    return found
