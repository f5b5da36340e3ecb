"""Line deduplication by winnowing over line hashes.

A run is ``run`` consecutive non-blank lines. The least line hash of every run is a
fingerprint, so equal runs share one at the same place. Only runs around fingerprints
that occur more than once are compared with each other, by two independent hashes of
their whole content, 128 bits together. A run
that occurred before, in the order of doc_id and line, is deleted; overlapping and
adjacent runs extend each other, so a longer repeated passage goes as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import (
    gram_hashes,
    list_array,
    minimizers,
    mix,
    row_slices,
    run_hashes,
    text_bytes,
)
from lakemarts.llm.frames import (
    keyed_texts,
    left_join_null_safe,
    membership_filter,
    might_hold,
    written,
)

RUN = 3
_LINE = np.uint8(0x0A)
_BLANK = np.zeros(256, bool)
_BLANK[[0x09, 0x0A, 0x0D, 0x20]] = True


def _lines(column: pa.Array):
    """Slices of rows: first row, rows, two hashes of each line and each row's offset among them."""
    raw, offsets = text_bytes(column)
    for first, last in row_slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        data = raw[offsets[first] : offsets[last]]
        breaks = np.flatnonzero(data == _LINE)
        full = own[1:] > own[:-1]
        starts = np.union1d(own[:-1][full], breaks + 1)
        starts = starts[starts < len(data)]
        # A line ends at the next break or with its row.
        closing = np.append(breaks, len(data))
        ends = np.minimum(
            closing[np.searchsorted(breaks, starts)], own[np.searchsorted(own, starts, "right")]
        )
        visible = np.zeros(len(data) + 1, np.int64)
        np.cumsum(~_BLANK[data], out=visible[1:])
        shown = visible[ends] > visible[starts]
        starts, ends = starts[shown], ends[shown]
        both = run_hashes(data, starts, ends), run_hashes(data, starts, ends, other=True)
        yield first, last - first, *both, np.searchsorted(starts, own)


def _runs(hashes: np.ndarray, offsets: np.ndarray, run: int):
    """First line, length, hash and fingerprint choice of every run of the rows."""
    counts = np.diff(offsets)
    left = np.repeat(offsets[1:], counts) - np.arange(len(hashes))
    chosen = minimizers(hashes, left, run)
    whole = np.flatnonzero(left >= run)
    short = np.flatnonzero((counts > 0) & (counts < run))
    return chosen, left, whole, short


def _fingerprints(batches, run: int):
    for batch in batches:
        for _, rows, hashes, _, offsets in _lines(batch.column("text")):
            chosen, _, _, short = _runs(hashes, offsets, run)
            alone = _short_hashes(hashes, offsets, short)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([hashes[chosen], alone]).view(np.int64))], ["seed"]
            )


def _short_hashes(hashes: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A row of fewer lines than a run is one run, equal to whole rows only."""
    counts = np.diff(offsets)[rows]
    total = np.zeros(len(rows), np.uint64)
    for line in range(int(counts.max(initial=0))):
        has = counts > line
        total[has] = mix(total[has] + hashes[offsets[rows[has]] + line] + np.uint64(line + 1))
    return mix(total ^ np.uint64(0x5851F42D4C957F2D))


def _candidates(batches, known: np.ndarray, run: int):
    """Per row: its lines, and the runs that hold a repeated fingerprint."""
    for batch in batches:
        for first, rows, hashes, others, offsets in _lines(batch.column("text")):
            chosen, left, whole, short = _runs(hashes, offsets, run)
            seeds = np.flatnonzero(chosen)
            seeds = seeds[might_hold(known, hashes[seeds])]
            near = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(near, np.maximum(seeds - run + 1, 0), 1)
            np.add.at(near, seeds + 1, -1)
            whole = whole[np.cumsum(near)[whole] > 0]
            alone = _short_hashes(hashes, offsets, short)
            kept = might_hold(known, alone)
            short, alone = short[kept], alone[kept]
            row_of = np.repeat(np.arange(rows), np.diff(offsets))
            row = np.concatenate([row_of[whole], short])
            start = np.concatenate([whole - offsets[row_of[whole]], np.zeros(len(short), np.int64)])
            size = np.concatenate([np.full(len(whole), run), np.diff(offsets)[short]])
            content = np.concatenate([gram_hashes(hashes, run)[whole], alone])
            check = np.concatenate([gram_hashes(others, run)[whole], _short_hashes(others, offsets, short)])
            order = np.lexsort((start, row))
            runs = pa.StructArray.from_arrays(
                [
                    pa.array(start[order], pa.int32()),
                    pa.array(size[order], pa.int32()),
                    pa.array(content[order].view(np.int64)),
                    pa.array(check[order].view(np.int64)),
                ],
                ["start", "size", "content", "check"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, rows),
                    batch.column("text_hash").slice(first, rows),
                    pa.array(np.diff(offsets), pa.int64()),
                    list_array(runs, np.bincount(row, minlength=rows)),
                ],
                ["doc_id", "text_hash", "n_lines", "runs"],
            )


def _without(batches, text_col: str, drop_emptied: bool):
    """Delete the non-blank lines with the given numbers from each text."""
    for batch in batches:
        place = batch.schema.get_field_index(text_col)
        texts, full = [], []
        for text, cuts in zip(batch.column(text_col).to_pylist(), batch.column("__cuts").to_pylist()):
            if cuts:
                gone = {n for cut in cuts for n in range(cut["start"], cut["end"])}
                kept, number = [], -1
                for line in text.split("\n"):
                    shown = bool(line.strip(" \t\r"))
                    number += shown
                    if not (shown and number in gone):
                        kept.append(line)
                text = "\n".join(kept)
            texts.append(text)
            full.append(not (drop_emptied and cuts) or bool(text.strip()))
        columns = [column for column in batch.columns]
        columns[place] = pa.array(texts, pa.string())
        keep = [i for i, name in enumerate(batch.schema.names) if name != "__cuts"]
        left = pa.RecordBatch.from_arrays(
            [columns[i] for i in keep], [batch.schema.names[i] for i in keep]
        )
        yield left.filter(pa.array(full, pa.bool_()))


def repeated_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run: int = RUN
) -> DataFrame:
    """Per row: ``doc_id, text_hash, n_lines, n_removed`` and the lines to cut.

    ``cuts`` lists (start, end) among the row's non-blank lines, counted from 0; they may
    overlap. Of several occurrences of a run the first stays whole, by doc_id (null
    first), text hash and line. Lines are told apart by all their characters. A text
    of fewer non-blank lines than ``run`` is one run and equals whole texts only. Null
    and empty texts have no lines. Rows that repeat both doc_id and text are one
    document here and share their result. Texts may have any length; other columns
    are ignored.
    """
    texts = keyed_texts(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    seeds = texts.select("text").mapInArrow(lambda batches: _fingerprints(batches, run), "seed bigint")
    repeated = written(seeds.groupBy("seed").count().filter("count > 1").select("seed"))
    known = membership_filter(repeated, "seed")
    found = written(
        texts.mapInArrow(
            lambda batches: _candidates(batches, known.value, run),
            f"doc_id {id_type}, text_hash bigint, n_lines bigint, "
            "runs array<struct<start: int, size: int, content: bigint, check: bigint>>",
        )
    )
    key = ["doc_id", "text_hash"]
    runs = found.select(*key, F.inline("runs"))
    # Written before the join, so that a run in very many texts can be split there.
    firsts = written(
        runs.groupBy("content", "check")
        .agg(F.min(F.struct(*key, "start")).alias("first"), F.max(F.struct(*key, "start")).alias("last"))
        .filter("first < last")
        .select(
            "content",
            "check",
            F.col("first.doc_id").alias("doc_id0"),
            F.col("first.text_hash").alias("text_hash0"),
            F.col("first.start").alias("start0"),
        )
    )
    same_text = F.col("doc_id").eqNullSafe(F.col("doc_id0")) & (F.col("text_hash") == F.col("text_hash0"))
    end = F.col("start") + F.col("size")
    cuts = (
        runs.join(firsts, ["content", "check"])
        .withColumn("cut", F.when(same_text, F.greatest("start", F.col("start0") + F.col("size"))).otherwise(F.col("start")))
        .filter(~(same_text & (F.col("start") == F.col("start0"))) & (F.col("cut") < end))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set(F.struct(F.col("cut").alias("start"), end.alias("end")))).alias("cuts"))
    )
    removed = F.size(
        F.array_distinct(F.flatten(F.transform("cuts", lambda c: F.sequence(c["start"], c["end"] - 1))))
    )
    return left_join_null_safe(found.drop("runs"), cuts, *key).withColumn(
        "n_removed", F.coalesce(removed, F.lit(0)).cast("bigint")
    )


def without_repeated_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN,
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with repeated runs deleted from the text; all columns kept.

    All rows stay, unless ``drop_emptied`` asks to drop those that had text and have
    none left. See :func:`repeated_runs`. Null texts stay null. No column of ``docs`` may be
    named ``__id``, ``__hash`` or ``__cuts``.
    """
    cuts = (
        repeated_runs(docs, id_col=id_col, text_col=text_col, run=run)
        .filter("n_removed > 0")
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("cuts").alias("__cuts"))
        .distinct()
    )
    text_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    joined = docs.join(
        cuts, docs[id_col].eqNullSafe(cuts["__id"]) & (text_hash == cuts["__hash"]), "left"
    ).drop("__id", "__hash")
    return joined.mapInArrow(lambda batches: _without(batches, text_col, drop_emptied), docs.schema)
