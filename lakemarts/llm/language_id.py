"""Language identification by Bayesian evidence fusion.

Three kinds of evidence are added up for each language: how likely its three-byte grams
make the text, how often texts in it declare this markup language, and how often this
host publishes it. The last two come from counts over all rows, grouped; a host with few
rows is drawn to its domain, a domain to its address suffix, and a suffix to all rows, so
the suffix counts once, in the prior of the host.

The languages are those that rows declare, by count, unless they are given.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import LOWER, row_slices, text_bytes
from lakemarts.llm.frames import written

#: A language is known if so many rows declare it; at most so many are, the most declared.
LEAST_DECLARED = 10
MOST_LANGUAGES = 256
#: Labelled rows that the text model is fitted on, per language and in expectation.
TRAINING_ROWS = 4000
GRAM_BITS = 16
#: Grams of one text are far from independent: this much of their evidence counts,
#: and no text counts for more than so many nats per language.
TEXT_WEIGHT = 0.2
MOST_TEXT_EVIDENCE = 60.0
#: Rows that the parent's distribution counts for.
PRIOR_ROWS = 20.0
LEAST_PROBABILITY = 0.5
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _grams(column: pa.Array):
    """Slices of rows: first row, rows, row and code of every three-byte gram.

    Runs of anything but letters count as one space, so digits, markup and noise
    neither help nor harm. A gram of a space alone or across rows does not count.
    """
    raw, offsets = text_bytes(column)
    for first, last in row_slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        data = LOWER[raw[offsets[first] : offsets[last]]]
        letter = _LETTER[data]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        row = np.repeat(np.arange(last - first), np.diff(own))[keep]
        text = np.where(letter, data, 0x20)[keep].astype(np.uint32)
        code = (text[:-2] << np.uint32(16)) | (text[1:-1] << np.uint32(8)) | text[2:]
        code = (code * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
        inside = (row[2:] == row[:-2]) & (text[1:-1] != 0x20)
        yield first, last - first, row[:-2][inside], code[inside]


def _gram_counts(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = np.array(batch.column("label").to_pylist(), object)
        for first, rows, row, code in _grams(batch.column("text")):
            for label in set(labels[first : first + rows]):
                own = labels[first : first + rows] == label
                counts = np.bincount(code[own[row]], minlength=1 << GRAM_BITS)
                totals[label] = totals.get(label, 0) + counts
    for label, counts in totals.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([label] * len(seen), pa.string()),
                pa.array(seen, pa.int32()),
                pa.array(counts[seen], pa.int64()),
            ],
            ["label", "gram", "n"],
        )


def declared_languages(labels: DataFrame, least: int = LEAST_DECLARED) -> list[str]:
    """The values of ``label`` that at least so many rows have, sorted."""
    often = labels.filter("label != ''").groupBy("label").count().filter(F.col("count") >= least)
    most = often.orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES)
    return sorted(row["label"] for row in most.collect())


def train_text_model(
    texts: DataFrame, languages: Sequence[str], training_rows: int = TRAINING_ROWS
) -> np.ndarray:
    """Log-probability of each gram: a row for each language and a flat one for all others.

    ``texts`` has ``text`` and ``label``; rows with other labels are left out. At most
    about ``training_rows`` whole texts of each language are used, chosen by hash.
    """
    labelled = texts.filter(F.col("label").isin(*languages))
    totals = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, min(1.0, training_rows / n)).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    # At most one row for each language and gram code reaches the driver.
    counted = (
        chosen.mapInArrow(_gram_counts, "label string, gram int, n bigint")
        .groupBy("label", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    size = 1 << GRAM_BITS
    model = np.zeros((len(languages) + 1, size))
    for index, label in enumerate(languages):
        own = counted[counted["label"] == label]
        model[index, own["gram"].to_numpy()] = own["n"].to_numpy()
    model[:-1] += 0.01
    model[-1] = 1.0
    return np.log(model / model.sum(axis=1, keepdims=True)).astype(np.float32)


def _scored(batches, model: np.ndarray):
    kept = None
    for batch in batches:
        kept = kept or [i for i, name in enumerate(batch.schema.names) if name != "text"]
        scores = np.zeros((batch.num_rows, len(model)))
        seen = np.zeros(batch.num_rows, np.int64)
        for first, rows, row, code in _grams(batch.column("text")):
            seen[first : first + rows] = np.bincount(row, minlength=rows)
            for index, table in enumerate(model):
                scores[first : first + rows, index] = np.bincount(row, table[code], minlength=rows)
        scores *= TEXT_WEIGHT
        scores -= scores.max(axis=1, keepdims=True)
        np.maximum(scores, -MOST_TEXT_EVIDENCE, out=scores)
        evidence = pa.ListArray.from_arrays(
            pa.array(np.arange(0, scores.size + 1, len(model)), pa.int32()), pa.array(scores.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], pa.array(seen), evidence],
            [*[batch.schema.names[i] for i in kept], "n_grams", "text_evidence"],
        )


def _primary(tag: Column) -> Column:
    """Primary subtag of a language tag in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(tag, F.lit("")), r"^\s*([A-Za-z]{2,8})", 1))


def _smoothed(key: str, parent: str | None, classes: int) -> Column:
    """Distribution over classes of each ``key``, drawn to that of its parent."""
    votes = [f"n{i}" for i in range(classes)]
    total = sum((F.col(name) for name in votes), F.lit(0))
    if parent is None:
        base = [F.lit(1.0 / classes)] * classes
    else:
        base = [F.col(f"{parent}_p")[i] for i in range(classes)]
    return F.array(
        *[(F.col(name) + PRIOR_ROWS * p) / (total + PRIOR_ROWS) for name, p in zip(votes, base)]
    ).alias(f"{key}_p")


def fuse_languages(rows: DataFrame, model: np.ndarray, languages: Sequence[str]) -> DataFrame:
    """``language``, ``probability`` and ``accepted`` of every row.

    ``rows`` has ``text``, ``declared`` (a language tag or null), ``host`` (or null) and any
    other columns, which are returned. A row is accepted when its most probable class is
    one of ``languages`` with a probability of at least 0.5; a text without letters has
    no language of its own and is not accepted. Null text counts as empty. A missing
    tag or host is no evidence.
    """
    spark = rows.sparkSession
    names = [*languages, UNKNOWN]
    size = len(names)
    others = [name for name in rows.columns if name not in ("text", "declared", "host")]
    host = F.lower(F.coalesce("host", F.lit("")))
    parts = F.split("host", r"\.")
    prepared = (
        rows.select(
            *others,
            F.coalesce("text", F.lit("")).alias("text"),
            _primary(F.col("declared")).alias("declared"),
            host.alias("host"),
        )
        .withColumn("suffix", F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(""))
        .withColumn("domain", F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."))
    )
    shared = spark.sparkContext.broadcast(model)
    extra = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in prepared.schema if field.name != "text"
    )
    scored = written(
        prepared.mapInArrow(
            lambda batches: _scored(batches, shared.value),
            f"{extra}, n_grams bigint, text_evidence array<double>",
        )
    )
    vote = F.when(F.col("n_grams") > 0, F.array_position("text_evidence", F.lit(0.0)) - 1)
    voted = scored.select("declared", "suffix", "domain", "host", vote.alias("vote")).filter("vote is not null")
    tallies = [F.count_if(F.col("vote") == i).alias(f"n{i}") for i in range(size)]

    everything = voted.agg(*tallies).select(_smoothed("all", None, size))
    # Rows without a host say nothing about hosts.
    hosted = voted.filter("host != ''")
    suffixes = (
        hosted.groupBy("suffix").agg(*tallies).crossJoin(F.broadcast(everything))  # one row
        .select("suffix", _smoothed("suffix", "all", size), "all_p")
    )
    domains = (
        hosted.groupBy("suffix", "domain").agg(*tallies).join(suffixes, "suffix")
        .select("domain", _smoothed("domain", "suffix", size))
    )
    hosts = written(
        hosted.groupBy("domain", "host").agg(*tallies).join(domains, "domain")
        .select("host", _smoothed("host", "domain", size))
    )
    # P(tag | language) from the same votes.
    totals = voted.groupBy("vote").count().collect()  # one row for each class
    per_class = {row["vote"]: row["count"] for row in totals}
    tagged = voted.filter(F.col("declared").isin(*languages)).groupBy("declared", "vote").count()
    together = {(row["declared"], row["vote"]): row["count"] for row in tagged.collect()}
    tag_evidence = F.array(*[F.lit(0.0)] * size)
    for tag in languages:
        chance = [
            (together.get((tag, i), 0) + 1.0) / (per_class.get(i, 0) + size) for i in range(size)
        ]
        tag_evidence = F.when(
            F.col("declared") == tag, F.array(*[F.lit(float(np.log(p))) for p in chance])
        ).otherwise(tag_evidence)
    none = F.array(*[F.lit(0.0)] * size)
    joined = (
        scored.join(hosts, "host", "left")
        .withColumn("tag_evidence", tag_evidence)
        .withColumn(
            "log_prior",
            F.coalesce(F.transform("host_p", lambda p: F.log(p)), none),
        )
    )
    evidence = ["text_evidence", "tag_evidence", "log_prior"]
    score = F.array(*[sum((F.col(name)[i] for name in evidence), F.lit(0.0)) for i in range(size)])
    top = F.array_max("score")
    best = F.array_position("score", top).cast("int")
    posterior = 1.0 / F.aggregate("score", F.lit(0.0), lambda total, one: total + F.exp(one - top))
    known = F.col("n_grams") > 0
    return (
        joined.withColumn("score", score)
        .withColumn("language", F.when(known, F.element_at(F.array(*map(F.lit, names)), best)).otherwise(UNKNOWN))
        .withColumn("probability", F.when(known, posterior).otherwise(0.0))
        .withColumn(
            "accepted", (F.col("language") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY)
        )
        .select(*others, "language", "probability", "accepted")
    )


def documents_with_language(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
    languages: Sequence[str] | None = None,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """``doc_id, text_hash, language, probability, accepted`` of every row of ``docs``.

    The declared language both labels the text model's training rows and is evidence;
    a wrong tag is outvoted by the text. Without ``languages`` those that at least
    ``LEAST_DECLARED`` rows declare are known. Null ids and repeated rows are kept; null
    texts count as empty; texts may have any length. Other columns are ignored.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
        docs[declared_col].cast("string").alias("declared"),
        docs[host_col].cast("string").alias("host"),
    )
    labelled = rows.select("text", _primary(F.col("declared")).alias("label"))
    if languages is None:
        languages = declared_languages(labelled)
    return fuse_languages(rows, train_text_model(labelled, languages, training_rows), languages)


def pages_with_language(
    pages: DataFrame,
    docs: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    label_text_col: str = "text",
    label_col: str = "lang",
    languages: Sequence[str] | None = None,
) -> DataFrame:
    """``page_id, language, probability, accepted`` of every page.

    The text model is fitted on ``docs``; the pages give the declared language
    (``<html lang>``), the address suffix and the host.
    """
    html = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    rows = pages.select(
        pages[id_col].alias("page_id"),
        visible.alias("text"),
        F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)""", 1).alias("declared"),
        F.regexp_extract(F.coalesce(pages[url_col], F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1).alias("host"),
    )
    labelled = docs.select(
        F.coalesce(docs[label_text_col].cast("string"), F.lit("")).alias("text"),
        _primary(docs[label_col].cast("string")).alias("label"),
    )
    if languages is None:
        languages = declared_languages(labelled)
    return fuse_languages(rows, train_text_model(labelled, languages), languages)


def in_known_languages(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose language is not accepted; columns unchanged.

    See :func:`documents_with_language`. No column of ``docs`` may be named ``__id`` or
    ``__hash``.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    out = (
        documents_with_language(docs, **options)
        .filter("not accepted")
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct()
    )
    text_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(
        out, docs[id_col].eqNullSafe(out["__id"]) & (text_hash == out["__hash"]), "left_anti"
    )
