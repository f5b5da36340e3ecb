"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept and acts on its own decisions; all but the
last return the columns of ``documents``. A stage's result has to be written before the
next stage is called: that deletes the tables that the stage before has left.

Null and empty texts have no language and go in the first stage, with all others that are
in none of the languages declared. Rows that repeat a doc_id are documents of their own,
of those with an equal text one stays; null ids are kept, and are the least. Texts may have
any length. No documents give no sequences. Columns other than those of ``documents`` pass
through; none may be named ``__id``, ``__hash`` or ``__cuts``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.llm.decontaminate import decontaminated
from lakemarts.llm.frames import delete_folder, folders_written, shared_folder, table
from lakemarts.llm.language_id import in_known_languages
from lakemarts.llm.line_dedup import without_repeated_lines
from lakemarts.llm.near_dedup import without_near_duplicates
from lakemarts.llm.packing import pack


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that the stage called last has written, by application.
_LEFT: dict[str, list[str]] = {}


def _tidy(stage: Stage) -> Stage:
    """The stage, which first deletes what the stage before has left."""

    @wraps(stage)
    def tidy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for folder in _LEFT.pop(application, []):
            delete_folder(spark, folder)
        with folders_written() as folders:
            result = stage(spark, docs, sf_dir)
        _LEFT[application] = folders
        return result

    return tidy


@_tidy
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in none of the known languages."""
    return in_known_languages(docs)


@_tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete repeated runs of lines; a document with nothing left goes."""
    cleaned = without_repeated_lines(docs, drop_emptied=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return without_near_duplicates(docs)


@_tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


@_tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise what is left and pack it into sequences."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the text model nor byte-pair ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again.

    The tables lie in a new folder under the shared one; each goes when the next one is
    written, and the last may be deleted when it has been used.
    """
    folder = f"{shared_folder(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            delete_folder(spark, f"{folder}/{number - 1}_{STAGES[number - 1][0]}")
    return docs
