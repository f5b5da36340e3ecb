"""Source divergence audit: how far the sources of a language differ in their terms.

A term is a run of letters and of characters beyond ASCII, with A-Z lowered. The terms that
stand in enough documents of their language are found by iceberg refinement of byte
prefixes: a level counts the documents of every prefix of a certain length, and only terms
whose prefix stands in enough documents are looked at on the next level, with a longer
prefix. A term that ends on a level is counted whole there, by source, so that each level
leaves finished counts and the prefixes still to be extended; the last one leaves none.

Per (language, source) group a term has the share ``p = 1 + floor(SCALE * (count + 1) /
(N + V))`` of the kept terms, with N their occurrences and V their number, and two shares
differ by ``floor((p - q)^2 / q)``. All of it is integer arithmetic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.arrays import added_rows, mix, run_hashes, words_of
from lakemarts.llm.frames import membership_filter, might_hold, written

#: A kept term stands in so many documents of its language.
LEAST_DOCUMENTS = 3
#: Bytes of the first level's prefixes, and how much longer those of each further level are.
FIRST_PREFIX = 6
GROWTH = 4
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Counts by source that are compared in one task, at least, and pairs of sources there.
BLOCK_COUNTS = 1 << 16
BLOCK_PAIRS = 1 << 22

# Fixed value: the bytes of a term.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_COUNTS = "lang string, source string, term string, prefix bigint, documents bigint, occurrences bigint"


def _prefix_hashes(terms: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term's first ``length`` bytes (all of a shorter one), and its bytes."""
    _, ends, data = terms.buffers()
    offsets = np.frombuffer(ends, np.int64)[terms.offset : terms.offset + len(terms) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    return run_hashes(raw, offsets[:-1], offsets[:-1] + np.minimum(sizes, length)), sizes


def _counted(batches, length: int, earlier: int, known: np.ndarray | None):
    """Counts of one level, combined over each slice of texts.

    Terms of up to ``length`` bytes whose prefix of the ``earlier`` level may be ``known``
    make rows by language and source; prefixes of longer ones make rows without these.
    """
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        sources = batch.column("source").dictionary_encode()
        lang_of_row = langs.indices.to_numpy().astype(np.int64)
        source_of_row = sources.indices.to_numpy().astype(np.int64)
        lang_hashes = run_hashes(*_offsets(langs.dictionary))
        salts, salts_before = mix(lang_hashes + np.uint64(length)), mix(lang_hashes + np.uint64(earlier))
        for words in words_of(batch.column("text"), TERM_BYTES):
            if not len(words.starts):
                continue
            number, terms = words.numbered()
            many = len(terms)
            # One entry for each document and term, and how often it stands there.
            pairs, times = np.unique(words.row_of_word() * many + number, return_counts=True)
            row, term = words.first_row + pairs // many, pairs % many
            hashes, sizes = _prefix_hashes(terms, length)
            lang = lang_of_row[row]
            if known is not None:
                before, _ = _prefix_hashes(terms, earlier)
                going = (sizes > earlier)[term]
                keys = mix(before[term[going]] ^ salts_before[lang[going]])
                going[going] = might_hold(known, keys.view(np.int64))
                row, term, lang, times = row[going], term[going], lang[going], times[going]
            whole = (sizes <= length)[term]
            yield _term_rows(
                langs.dictionary, sources.dictionary, terms,
                lang[whole], source_of_row[row[whole]], term[whole], times[whole],
            )
            # Prefixes once for each document.
            keys = mix(hashes[term[~whole]] ^ salts[lang[~whole]])
            _, own = np.unique(keys, return_inverse=True)
            n_keys = int(own.max()) + 1 if len(own) else 1
            _, first = np.unique(row[~whole] * n_keys + own, return_index=True)
            prefix, documents = np.unique(keys[first], return_counts=True)
            nothing = pa.nulls(len(prefix), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    nothing, nothing, nothing,
                    pa.array(prefix.view(np.int64)),
                    pa.array(documents, pa.int64()),
                    pa.array(np.zeros(len(prefix), np.int64)),
                ],
                ["lang", "source", "term", "prefix", "documents", "occurrences"],
            )


def _offsets(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of some strings, with the start and end of each."""
    encoded = [value.encode() for value in values.to_pylist()]
    ends = np.cumsum([len(value) for value in encoded]) if encoded else np.zeros(0, np.int64)
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    return raw, np.append(0, ends[:-1]).astype(np.int64)[: len(ends)], ends.astype(np.int64)


def _term_rows(langs, sources, terms, lang, source, term, times) -> pa.RecordBatch:
    """Documents and occurrences by language, source and term."""
    group = lang * len(sources) + source
    keys, at, documents = np.unique(group * max(len(terms), 1) + term, return_inverse=True, return_counts=True)
    occurrences = np.zeros(len(keys), np.int64)
    np.add.at(occurrences, at, times)
    group, term = keys // max(len(terms), 1), keys % max(len(terms), 1)
    return pa.RecordBatch.from_arrays(
        [
            langs.take(pa.array(group // max(len(sources), 1))),
            sources.take(pa.array(group % max(len(sources), 1))),
            terms.take(pa.array(term)).cast(pa.string()),
            pa.nulls(len(keys), pa.int64()),
            pa.array(documents, pa.int64()),
            pa.array(occurrences),
        ],
        ["lang", "source", "term", "prefix", "documents", "occurrences"],
    )


def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(docs[name].cast("string"), F.lit(""))

    return docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))


def term_counts(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    first_prefix: int = FIRST_PREFIX,
) -> DataFrame:
    """``lang, source, term, occurrences`` and ``in_lang`` (occurrences in the language).

    Only terms in at least ``least_documents`` rows of their language, and only sources that
    have them. Written; the number of passes over the texts grows with the logarithm of the
    longest prefix that so many documents share.
    """
    texts = _texts(docs, text_col, lang_col, source_col)
    length, earlier, known, levels = first_prefix, 0, None, []
    while True:

        def scan(batches, length=length, earlier=earlier, known=known):
            counted = _counted(batches, length, earlier, None if known is None else known.value)
            return added_rows(
                counted, ["lang", "source", "term", "prefix"], ["documents", "occurrences"]
            )

        level = written(
            texts.mapInArrow(scan, _COUNTS)
            .groupBy("lang", "source", "term", "prefix")
            .agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences"))
            # A prefix below the threshold goes here; a term may have other sources.
            .filter(F.col("term").isNotNull() | (F.col("documents") >= least_documents))
        )
        levels.append(level.filter("term is not null").drop("prefix"))
        left = level.filter("term is null").select("prefix")
        if left.isEmpty():
            break
        # What a full filter lets through, the next count rejects.
        known = membership_filter(left, "prefix", sized=True)
        length, earlier = length * GROWTH, length
    found = levels[0]
    for more in levels[1:]:
        found = found.union(more)
    in_lang = (
        found.groupBy("lang", "term")
        .agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("in_lang"))
        .filter(F.col("documents") >= least_documents)
        .select("lang", "term", "in_lang")
    )
    return written(found.drop("documents").join(in_lang, ["lang", "term"]))


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact for any 64-bit counts."""
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", scaled, total.cast("decimal(19,0)"))


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same of arrays, by long division in steps that stay within 64 bits."""
    rest, result = counts + 1, np.zeros(np.broadcast(counts, totals).shape, np.int64)
    result, rest = result + rest // totals, rest % totals
    for _ in range(3):
        rest = rest * 1000
        result, rest = result * 1000 + rest // totals, rest % totals
    return result + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _block_sums(table: pa.Table) -> pa.Table:
    """Sums of the differences over one block of terms, from some sources to all others.

    Rows without a term name the sources of the language with their totals.
    """
    term, source = table["term"].combine_chunks(), table["source"].combine_chunks()
    totals_at = np.asarray(term.is_null())
    names = source.filter(pa.array(totals_at))
    order = np.argsort(np.array(names.to_pylist(), object), kind="stable")
    names = names.take(pa.array(order))
    total = table["total"].to_numpy()[totals_at][order]
    held = ~totals_at
    at_source = pc.index_in(source.filter(pa.array(held)), names).to_numpy()
    terms = term.filter(pa.array(held)).dictionary_encode()
    at_term, n_terms = terms.indices.to_numpy(), len(terms.dictionary)
    counts = table["occurrences"].to_numpy()[held]
    by_source = np.argsort(at_source, kind="stable")
    at_source, at_term, counts = at_source[by_source], at_term[by_source], counts[by_source]
    own = shares(counts, total[at_source])
    none = shares(np.zeros(len(names), np.int64), total)
    bounds = np.searchsorted(at_source, np.arange(len(names) + 1))
    present = bounds[1:] > bounds[:-1]
    at_once = max(BLOCK_PAIRS // len(names), 1)
    base = table["part"][0].as_py() * at_once
    values = np.zeros((max(min(at_once, len(names) - base), 0), len(names)), np.int64)
    for place in range(len(values)):
        one = base + place
        a, b = bounds[one], bounds[one + 1]
        p = np.full(n_terms, none[one])
        p[at_term[a:b]] = own[a:b]
        # As if no other source had any of the terms, then mended where one has.
        kinds, times = np.unique(p, return_counts=True)
        gap = kinds[:, None] - none[None, :]
        values[place] = (gap * gap // none[None, :] * times[:, None]).sum(axis=0)
        here = p[at_term]
        real, assumed = here - own, here - none[at_source]
        change = real * real // own - assumed * assumed // none[at_source]
        if len(change):
            values[place, present] += np.add.reduceat(change, bounds[:-1][present])
    a, b = np.nonzero(base + np.arange(len(values))[:, None] != np.arange(len(names)))
    return pa.table(
        {
            "lang": pa.repeat(table["lang"][0], len(a)),
            "source": names.take(pa.array(base + a)),
            "item": names.take(pa.array(b)),
            "value": pa.array(values[a, b]),
        }
    )


def source_divergence(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    first_prefix: int = FIRST_PREFIX,
    top_terms: int = TOP_TERMS,
    block_counts: int = BLOCK_COUNTS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from its language.

    ``pair``: every other source of the language, with the sum of the differences of this
    source's shares to that one's over all kept terms. ``term``: up to ``top_terms`` kept
    terms that the source has more of than its language, with their difference. Ranks are by
    value, ties by the bytes of the item. Every (language, source) in ``docs`` is a group.

    Null text, language and source count as empty. Each row is a document of its own, also
    where ids or texts repeat. Terms may have any length. No rows give no rows; a language
    without kept terms has pairs of value 0. Other columns are ignored. The pairs of one
    language grow with the square of its sources, as asked; terms come in blocks, so
    neither a large language nor a hot source meets in one task.
    """
    counts = term_counts(
        docs, text_col=text_col, lang_col=lang_col, source_col=source_col,
        least_documents=least_documents, first_prefix=first_prefix,
    )
    groups = _texts(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
    # A row for each source that has the term, so partial counts come before the shuffle.
    kept = counts.groupBy("lang").agg(F.count("*").alias("rows")).join(
        counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("terms")), "lang"
    )
    occurring = counts.groupBy("lang", "source").agg(F.sum("occurrences").alias("n"))
    totals = written(
        groups.join(occurring, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang",
            "source",
            (F.coalesce("n", F.lit(0)) + F.coalesce("terms", F.lit(0))).alias("total"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("terms", F.lit(0)).alias("terms"),
        )
    )
    pairs = _pairs(counts, totals, block_counts)
    terms = _terms(counts, totals, top_terms)
    return pairs.union(terms)


def _pairs(counts: DataFrame, totals: DataFrame, block_counts: int) -> DataFrame:
    # Blocks hold a few counts for each pair of sources, so that their sums are no more rows
    # than the counts; with many sources each part of a block has some of them.
    pairs = F.col("sources") * F.col("sources")
    size = F.greatest(F.lit(block_counts), F.least(pairs, F.lit(64 * block_counts)))
    at_once = F.greatest(F.floor(F.lit(BLOCK_PAIRS) / F.col("sources")), F.lit(1))
    per_lang = (
        totals.filter("rows > 0")
        .groupBy("lang")
        .agg(F.max("rows").alias("rows"), F.count("*").alias("sources"))
        .select(
            "lang",
            F.ceil(F.col("rows") / size).cast("int").alias("blocks"),
            F.ceil(F.col("sources") / at_once).cast("int").alias("parts"),
        )
    )
    each_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    in_blocks = counts.join(per_lang, "lang").select(
        "lang",
        F.expr("cast(pmod(xxhash64(term), blocks) as int)").alias("block"),
        each_part,
        "source",
        "term",
        "occurrences",
        F.lit(0).cast("bigint").alias("total"),
    )
    sources = (
        totals.join(per_lang, "lang")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select(
            "lang",
            "block",
            each_part,
            "source",
            F.lit(None).cast("string").alias("term"),
            F.lit(0).cast("bigint").alias("occurrences"),
            "total",
        )
    )
    found = (
        in_blocks.union(sources)
        .groupBy("lang", "block", "part")
        .applyInArrow(_block_sums, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    one = totals.select("lang", "source")
    other = totals.select("lang", F.col("source").alias("item"))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        one.join(other, "lang")
        .filter("source <> item")
        .join(found, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
        .withColumn("rank", F.row_number().over(ranks))
    )


def _terms(counts: DataFrame, totals: DataFrame, top_terms: int) -> DataFrame:
    whole = totals.groupBy("lang").agg((F.sum("n") + F.max("terms")).alias("lang_total"))
    p, q = share(F.col("occurrences"), F.col("total")), share(F.col("in_lang"), F.col("lang_total"))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        counts.join(totals.join(whole, "lang").select("lang", "source", "total", "lang_total"), ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", difference(F.col("p"), F.col("q")).alias("value"))
        # Spark keeps each task's best rows of a group before it shuffles them.
        .withColumn("rank", F.row_number().over(ranks))
        .filter(F.col("rank") <= top_terms)
    )
