"""Benchmark decontamination by winnowing.

Of every six consecutive 5-word grams the one of least hash is a fingerprint, so
two texts that share ten consecutive words share a fingerprint inside them. Only
fingerprints that a benchmark item also has are looked at again: the ten-word
windows around each are compared with the items' windows as text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.arrays import Words, gram_hashes, list_array, minimizers, words_of
from lakemarts.llm.frames import (
    FILTER_BITS,
    keyed_texts,
    left_join_null_safe,
    membership_filter,
    might_hold,
    written,
)

#: Words of a window, and of the grams that are hashed.
WINDOW = 10
GRAM = 5
_WINDOWS = "array<struct<start: int, length: int, seed: bigint, words: string>>"


def _seeds(words: Words, lengths: tuple[int, ...], window: int, gram: int):
    """(window length, word indexes, hashes) of the fingerprints of each window length."""
    hashes, left = words.hashes(), words.words_left()
    grams = gram_hashes(hashes, gram)
    chosen = np.flatnonzero(minimizers(grams, left - gram + 1, window - gram + 1))
    yield window, chosen, grams[chosen]
    for length in lengths:
        whole = np.flatnonzero(left >= length)
        yield length, whole, gram_hashes(hashes, length)[whole] ^ np.uint64(length)


def _item_rows(batches, window: int, gram: int):
    """Per item: its windows as text and its fingerprints."""
    for batch in batches:
        for words in words_of(batch.column("text")):
            counts = words.counts
            shorts = tuple(sorted({int(n) for n in counts if 0 < n < window}))
            seeds: list[list[int]] = [[] for _ in counts]
            row_of = words.row_of_word()
            for length, at, values in _seeds(words, shorts, window, gram):
                for index, value in zip(row_of[at].tolist(), values.view(np.int64).tolist()):
                    if length == window or counts[index] == length:
                        seeds[index].append(value)
            texts = []
            for row, n in enumerate(counts.tolist()):
                size, first = min(n, window), int(words.word_offsets[row])
                texts.append([words.text(first + i, size) for i in range(n - size + 1)] if n else [])
            rows = slice(words.first_row, words.first_row + words.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id")[rows],
                    pa.array(np.minimum(counts, window), pa.int32()),
                    pa.array(texts, pa.list_(pa.string())),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                ["item_id", "length", "windows", "seeds"],
            )


def _document_rows(batches, known: np.ndarray, shorts, window: int, gram: int):
    """Per document: its word count and the windows around known fingerprints."""
    for batch in batches:
        for words in words_of(batch.column("text")):
            left, row_of = words.words_left(), words.row_of_word()
            found = []
            for length, at, hashes in _seeds(words, shorts, window, gram):
                hit = might_hold(known, hashes)
                at, hashes = at[hit], hashes[hit]
                before = length - gram if length == window else 0
                for back in range(before + 1):
                    first = at - back
                    fits = first >= words.word_offsets[row_of[at]]
                    fits[fits] &= left[first[fits]] >= length
                    found.append((first[fits], np.full(fits.sum(), length), hashes[fits]))
            first, length, seed = (np.concatenate(part) for part in zip(*found))
            order = np.argsort(first, kind="stable")
            first, length, seed = first[order], length[order], seed[order]
            row = row_of[first]
            windows = pa.StructArray.from_arrays(
                [
                    pa.array(first - words.word_offsets[row], pa.int32()),
                    pa.array(length, pa.int32()),
                    pa.array(seed.view(np.int64)),
                    pa.array(
                        [words.text(a, n) for a, n in zip(first.tolist(), length.tolist())],
                        pa.string(),
                    ),
                ],
                ["start", "length", "seed", "words"],
            )
            rows = slice(words.first_row, words.first_row + words.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[rows],
                    batch.column("text_hash")[rows],
                    pa.array(words.counts, pa.int64()),
                    list_array(windows, np.bincount(row, minlength=words.rows)),
                ],
                ["doc_id", "text_hash", "n_words", "windows"],
            )


def benchmark_windows(
    benchmark: DataFrame,
    *,
    item_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per item: ``item_id`` (text), ``length``, its ``windows`` and its ``seeds``."""
    items = benchmark.select(
        benchmark[item_col].cast("string").alias("item_id"),
        F.coalesce(benchmark[text_col].cast("string"), F.lit("")).alias("text"),
    )
    return items.mapInArrow(
        lambda batches: _item_rows(batches, window, gram),
        "item_id string, length int, windows array<string>, seeds array<bigint>",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Which words of each document stand in a benchmark item.

    A hit is any occurrence of ``window`` consecutive words of an item, or of all
    words of an item with fewer. Returns one row per row of ``docs``: ``doc_id``,
    ``text_hash``, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (sorted as text),
    ``items_sha256`` (digest of the ids, comma-joined), ``contaminated``.

    Null and empty texts have no words and no hits. An item without words matches
    nothing; one without an id marks words but is not listed. Rows that repeat a
    doc_id each get their own result. Texts may have any length. Other columns are ignored.
    """
    items = written(
        benchmark_windows(
            benchmark, item_col=item_col, text_col=item_text_col, window=window, gram=gram
        )
    )
    seeds = items.select(F.explode("seeds").alias("seed")).distinct()
    shorts = tuple(
        sorted(
            row.length
            for row in items.filter(F.col("length").between(1, window - 1))
            .select("length")
            .distinct()
            .collect()
        )
    )
    known = membership_filter(seeds, "seed", filter_bits)

    def scan(batches):
        return _document_rows(batches, known.value, shorts, window, gram)

    found = written(
        keyed_texts(docs, id_col, text_col).mapInArrow(
            scan,
            f"doc_id {docs.schema[id_col].dataType.simpleString()}, text_hash bigint, "
            f"n_words bigint, windows {_WINDOWS}",
        )
    )
    key = ["doc_id", "text_hash"]
    around = found.select(*key, F.inline("windows"))
    matched = around.join(seeds, "seed", "left_semi").select(*key, "start", "length", "words")
    # Windows with the same items are one class. Documents carry classes, and the items are
    # listed once for each set of classes that some document has: a window that very many
    # items and documents share is not multiplied by both.
    windows = written(
        items.select("item_id", F.explode("windows").alias("words"))
        .groupBy("words")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .withColumn("class", F.sha2(F.to_json("items"), 256))
    )
    classes = windows.select("class", "items").dropDuplicates(["class"])
    hits = written(
        matched.distinct().join(windows.select("words", "class"), "words").select(*key, "start", "length", "class")
    )
    before = (
        Window.partitionBy(*key)
        .orderBy("start", "length")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("length")
    covered = (
        hits.select(*key, "start", "length")
        .distinct()
        .withColumn("reached", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy(*key)
        .agg(
            F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).alias("n_hit")
        )
    )
    per_document = written(
        hits.groupBy(*key)
        .agg(F.sort_array(F.collect_set("class")).alias("classes"))
        .withColumn("set", F.sha2(F.array_join("classes", ","), 256))
    )
    sets = written(
        per_document.select("set", "classes")
        .dropDuplicates(["set"])
        .select("set", F.explode("classes").alias("class"))
        .join(classes, "class")
        .select("set", F.explode("items").alias("item_id"))
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .withColumn("items_sha256", F.sha2(F.array_join("item_ids", ","), 256))
        .withColumn("n_items", F.size("item_ids"))
    )
    # What is not asked for, such as the list itself, does not cross this join.
    listed = per_document.select(*key, "set").join(sets, "set", "left").drop("set")
    result = left_join_null_safe(found.select(*key, "n_words"), covered, *key)
    result = left_join_null_safe(result, listed, *key)
    none = F.array().cast("array<string>")
    return result.select(
        *key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; columns unchanged."""
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    hit = contamination(docs, benchmark, **names).filter("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    )
    text_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(
        hit.distinct(), docs[id_col].eqNullSafe(hit["__id"]) & (text_hash == hit["__hash"]), "left_anti"
    )
