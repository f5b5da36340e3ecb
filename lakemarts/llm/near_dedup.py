"""MinHash near-duplicate detection with DartMinHash signatures.

A document is the multiset of its five-word shingles. Every unit of weight of a
shingle is a region into which darts fall as a Poisson process along a rank axis,
the same darts in every document. Each dart belongs to one of the signature's
coordinates, and a coordinate keeps its earliest dart. So two documents agree in a
coordinate with a probability of their weighted Jaccard similarity. Long documents
read few darts of each region, and a signature costs about as much as any other.

Documents that agree in all coordinates of a band are candidates; their similarity
is then computed from all their shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import Words, gram_hashes, list_array, mix, words_of
from lakemarts.llm.components import connected_components
from lakemarts.llm.frames import discard, membership_filter, might_hold, written

SHINGLE = 5
SIMILARITY = 0.8
#: 42 bands of 6: two documents with a similarity of 0.8 share no band with a
#: probability of 3e-6, at 0.9 of 5e-15.
BANDS = 42
ROWS = 6
#: Bands whose buckets are compared with their hubs first; the others then only need
#: to join what is still apart.
FIRST_BANDS = 6
#: Further hubs tried in a bucket before the rest of its pairs is looked at in blocks.
HUB_ROUNDS = 0
#: Members of a block, and pairs that are verified together.
BLOCK = 1024
CELL_PAIRS = 4096
#: In blocks, texts whose signatures agree less are passed over: with a similarity at the
#: limit that is so many standard deviations away, a chance of 1e-9.
DEVIATIONS = 6.0


def _shingles(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle; fewer words than a shingle are one."""
    left, counts = words.words_left(), words.counts
    hashes, row_of = words.hashes(), words.row_of_word()
    whole = left >= shingle
    rows, grams = [row_of[whole]], [gram_hashes(hashes, shingle)[whole]]
    for n in range(1, shingle):
        alone = np.flatnonzero(counts == n)
        if len(alone):
            rows.append(alone)
            grams.append(gram_hashes(hashes, n)[words.word_offsets[alone]])
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    return row[order], gram[order]


def _units(row: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Hash of each unit of weight: the shingle and how often it came before."""
    n = len(gram)
    fresh = np.ones(n, bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return mix(gram + (np.arange(n) - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def dart_signatures(row: np.ndarray, unit: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Signature of ``size`` 64-bit coordinates of each row; rows without units get 0.

    Ranks up to ``(ln size + 4) size / units`` fill nearly all coordinates; rows with
    an empty one read on up to twice that, and so on.
    """
    signature = np.zeros((rows, size), np.uint64)
    weight = np.bincount(row, minlength=rows)
    todo = weight > 0
    reach = np.zeros(rows)
    reach[todo] = size * (np.log(size) + 4) / weight[todo]
    while todo.any():
        keep = todo[row]
        own_row, state = row[keep], unit[keep]
        rank = np.zeros(len(state))
        best = np.full(rows * size, np.inf)
        chosen = np.zeros(rows * size, np.uint64)
        while len(state):
            # The next dart of each region: an exponential gap, a coordinate, a name.
            state = mix(state + np.uint64(0xD1B54A32D192ED03))
            uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            rank = rank - np.log(uniform)
            near = rank <= reach[own_row]
            own_row, state, rank = own_row[near], state[near], rank[near]
            name = mix(state ^ np.uint64(0xA0761D6478BD642F))
            slot = own_row * size + (name % np.uint64(size)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            earliest = rank == best[slot]
            chosen[slot[earliest]] = name[earliest]
        best = best.reshape(rows, size)
        full = todo & np.isfinite(best).all(axis=1)
        signature[full] = chosen.reshape(rows, size)[full]
        todo &= ~full
        reach *= 2
    return signature


def _band_rows(batches, shingle: int, bands: int, per_band: int):
    for batch in batches:
        for words in words_of(batch.column("text")):
            row, gram = _shingles(words, shingle)
            signature = dart_signatures(row, _units(row, gram), words.rows, bands * per_band)
            keys = np.zeros((words.rows, bands), np.uint64)
            for band in range(bands):
                key = np.full(words.rows, band + 1, np.uint64)
                for part in range(per_band):
                    key = mix(key ^ signature[:, band * per_band + part]) + np.uint64(part)
                keys[:, band] = key
            weight = np.bincount(row, minlength=words.rows)
            some = np.flatnonzero(weight)
            ids = batch.column("uid").slice(words.first_row, words.rows).take(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(weight[some], pa.int64()),
                    list_array(
                        pa.array(keys[some].view(np.int64).ravel()), np.full(len(some), bands)
                    ),
                    # A byte of each coordinate tells how far two texts agree.
                    pa.array([line.tobytes() for line in signature[some].astype(np.uint8)], pa.binary()),
                ],
                ["uid", "weight", "buckets", "sketch"],
            )


def _in_shared_buckets(batches, known: np.ndarray):
    """The buckets of each text that other texts may share, one row each."""
    for batch in batches:
        lists = batch.column("buckets")
        bands = lists.value_lengths().to_numpy()
        bucket = lists.flatten().to_numpy()
        at = np.flatnonzero(might_hold(known, bucket))
        row = np.repeat(np.arange(batch.num_rows), bands)
        band = np.arange(len(bucket)) - np.repeat(np.cumsum(bands) - bands, bands)
        taken = pa.array(row[at])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("uid").take(taken),
                batch.column("weight").take(taken),
                pa.array(band[at].astype(np.int32)),
                pa.array(bucket[at]),
            ],
            ["uid", "weight", "band", "bucket"],
        )


def _sorted_in_rows(row: np.ndarray, units: np.ndarray) -> np.ndarray:
    units = units.view(np.int64)
    return units[np.lexsort((units, row))]


def _shingle_rows(batches, known: np.ndarray, shingle: int):
    for batch in batches:
        hit = might_hold(known, batch.column("uid").to_numpy())
        batch = batch.filter(pa.array(hit))
        for words in words_of(batch.column("text")):
            row, gram = _shingles(words, shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid").slice(words.first_row, words.rows),
                    list_array(
                        pa.array(_sorted_in_rows(row, _units(row, gram))),
                        np.bincount(row, minlength=words.rows),
                    ),
                ],
                ["uid", "units"],
            )


def _similar(rows: pa.Table, similarity: float) -> pa.Table:
    """``near`` of the pairs of a cell; rows without ``b`` are the shingles of ``a``."""
    lists = rows.filter(pc.is_null(rows["b"]))
    pairs = rows.filter(pc.is_valid(rows["b"]))
    units = dict(zip(lists["a"].to_pylist(), lists["units"].combine_chunks()))
    near = []
    for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
        one, two = units[a].values.to_numpy(), units[b].values.to_numpy()
        place = np.searchsorted(two, one)
        place[place == len(two)] = 0
        common = int((two[place] == one).sum())
        near.append(common >= similarity * (len(one) + len(two) - common) - 1e-9)
    return pa.table({"a": pairs["a"], "b": pairs["b"], "near": pa.array(near, pa.bool_())})


def _verified(pairs: DataFrame, units: DataFrame, similarity: float) -> DataFrame:
    """``a``, ``b`` and whether they are ``near``, from all shingles of both.

    Pairs are dealt to the cells of a grid by both their texts, so many pairs among few
    texts need each text a few times only.
    """
    pairs = written(pairs)
    grid = max(math.isqrt(pairs.count() // CELL_PAIRS), 1)
    cell = [F.pmod(F.xxhash64("a"), F.lit(grid)).alias("i"), F.pmod(F.xxhash64("b"), F.lit(grid)).alias("j")]
    fullest = pairs.groupBy(*cell).count().agg(F.max("count")).first()[0] or 0
    # A text in very many pairs fills its cells: then all are split.
    split = F.pmod(F.xxhash64("a", "b"), F.lit(fullest // (4 * CELL_PAIRS) + 1)).alias("k")
    dealt = pairs.select(*cell, split, "a", "b")
    needed = dealt.select("i", "j", "k", F.explode(F.array("a", "b")).alias("uid")).distinct()
    lists = needed.join(units, "uid").select(
        "i", "j", "k", F.col("uid").alias("a"), F.lit(None).cast("bigint").alias("b"), "units"
    )
    found = written(
        dealt.withColumn("units", F.lit(None).cast("array<bigint>"))
        .unionByName(lists)
        .groupBy("i", "j", "k")
        .applyInArrow(lambda rows: _similar(rows, similarity), "a bigint, b bigint, near boolean")
    )
    discard(pairs)
    return found


def near_links(
    texts: DataFrame,
    *,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    hub_rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """Links that join all near-duplicate texts (``uid``, a hash of ``text``; may repeat).

    In each bucket of the first bands the least uid is compared with all others. Then,
    in all buckets, members still apart are compared with a hub of the least component,
    for a few rounds. Then blocks of members meet with a sketch of their signatures: first
    a forest of the pairs that agree most is compared, and after that all pairs that are
    still apart. So a bucket of n copies costs n comparisons, and no pair that could join
    two components is left out.
    """
    signed = written(
        texts.mapInArrow(
            lambda batches: _band_rows(batches, shingle, bands, rows),
            "uid bigint, weight bigint, buckets array<bigint>, sketch binary",
        ).dropDuplicates(["uid"])
    )
    # Only a bucket with several texts matters; most texts have none.
    shared = written(
        signed.select(F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("bucket")
    )
    several = membership_filter(shared, "bucket", sized=True)
    members = written(
        signed.select("uid", "weight", "buckets")
        .mapInArrow(
            lambda batches: _in_shared_buckets(batches, several.value),
            "uid bigint, weight bigint, band int, bucket bigint",
        )
        .join(shared, "bucket", "left_semi")
        .select("uid", "weight", "band", "bucket")
    )
    named = written(members.select("uid").distinct())
    known = membership_filter(named, "uid", sized=True)
    units = written(
        texts.mapInArrow(
            lambda batches: _shingle_rows(batches, known.value, shingle),
            "uid bigint, units array<bigint>",
        )
        .join(named, "uid", "left_semi")
        .dropDuplicates(["uid"])
    )
    first = members.filter(F.col("band") < FIRST_BANDS)
    compared = _verified(_with_hubs(first.withColumn("comp", F.col("uid")), similarity), units, similarity)
    apart = _apart(members, compared)
    least = _least_agreeing(similarity, bands * rows)

    def with_hubs(members: DataFrame) -> DataFrame:
        return _with_hubs(members, similarity)

    def forest(members: DataFrame) -> DataFrame:
        return _in_blocks(members, signed.select("uid", "sketch"), similarity, least)

    def all_pairs(members: DataFrame) -> DataFrame:
        # Halves of the hashes: what they call similar is verified like all others.
        halves = F.transform("units", lambda unit: F.shiftright(unit, 32).cast("int"))
        known = signed.select("uid", "sketch").join(units.select("uid", halves.alias("halves")), "uid")
        return _in_blocks(members, known, similarity, least)

    # The last step leaves nothing: it looks at all pairs of a bucket still apart.
    steps = [with_hubs] * hub_rounds + [forest, all_pairs]
    for step in steps:
        if apart.isEmpty():
            break
        fresh = _verified(
            step(apart).join(compared.select("a", "b"), ["a", "b"], "left_anti"), units, similarity
        )
        compared = written(compared.union(fresh), replaces=compared)
        discard(fresh)
        if step is not steps[-1]:
            apart = _apart(apart, compared)
    links = written(compared.filter("near").select("a", "b"))
    discard(signed, shared, members, named, units, compared)
    return links


def _sizes_allow(one: str, other: str, similarity: float) -> Column:
    """False where the numbers of shingles alone rule the similarity out."""
    return F.least(one, other) >= F.greatest(one, other) * (similarity - 1e-9)


def _with_hubs(members: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a < b) of each bucket's hub, of its least component, with those of others."""
    # Written before the join, which can then split a bucket that very many texts share.
    hubs = written(
        members.groupBy("bucket")
        .agg(F.min(F.struct("comp", "uid", "weight")).alias("hub"), F.max("comp").alias("last"))
        .filter("hub.comp < last")
        .select(
            "bucket",
            F.col("hub.comp").alias("least"),
            F.col("hub.uid").alias("hub"),
            F.col("hub.weight").alias("hub_weight"),
        )
    )
    return (
        members.join(hubs, "bucket")
        .filter("comp != least")
        .filter(_sizes_allow("weight", "hub_weight", similarity))
        .select(F.least("hub", "uid").alias("a"), F.greatest("hub", "uid").alias("b"))
        .distinct()
    )


def _apart(members: DataFrame, compared: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    links = compared.filter("near").select("a", "b")
    parts = written(connected_components(links, "a", "b"))
    placed = members.join(parts, members["uid"] == parts["node"], "left").select(
        "bucket", "uid", "weight", F.coalesce("component", "uid").alias("comp")
    )
    several = (
        placed.groupBy("bucket")
        .agg(F.min("comp").alias("c"), F.max("comp").alias("d"))
        .filter("c < d")
        .select("bucket")
    )
    found = written(placed.join(several, "bucket", "left_semi"))
    discard(parts)
    return found


def _least_agreeing(similarity: float, size: int) -> int:
    """Coordinates of a signature that two similar texts agree in, but for a chance of 1e-9."""
    return math.floor(size * similarity - DEVIATIONS * math.sqrt(size * similarity * (1 - similarity)))


def _in_blocks(apart: DataFrame, known: DataFrame, similarity: float, least: int) -> DataFrame:
    """Pairs of a bucket in different components whose sketches agree.

    All that are similar by ``halves``, if ``known`` has these; else a forest of those that
    agree most. Members are dealt to blocks, and each pair of blocks meets in one task.
    """
    sizes = apart.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = apart.join(sizes, "bucket").withColumn(
        "block", F.expr("cast(pmod(xxhash64(uid), blocks) as int)")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        dealt.withColumn("other", other)
        .select(
            "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "block", "uid", "weight", "comp",
        )
        .join(known, "uid")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "uid")
        .mapInArrow(lambda batches: _agreeing(batches, similarity, least), "a bigint, b bigint")
        .distinct()
    )


def _agreeing(batches, similarity: float, least: int):
    """Agreeing pairs of different components in each group of sorted rows."""
    names = ("bucket", "i", "j")

    def similar(one: np.ndarray, two: np.ndarray) -> bool:
        place = np.searchsorted(two, one)
        place[place == len(two)] = 0
        common = int((two[place] == one).sum())
        return common >= similarity * (len(one) + len(two) - common) - 1e-9

    def pairs_of(rows: dict[str, np.ndarray], sketch: np.ndarray, halves: list | None) -> list[tuple[int, int]]:
        uid, weight, comp, block = (rows[name] for name in ("uid", "weight", "comp", "block"))
        found = []
        for one in range(len(uid) - 1):
            others = np.arange(one + 1, len(uid))
            fits = comp[others] != comp[one]
            if rows["i"][0] != rows["j"][0]:
                fits &= block[others] != block[one]
            low, high = np.minimum(weight[others], weight[one]), np.maximum(weight[others], weight[one])
            others = others[fits & (low >= high * (similarity - 1e-9))]
            agree = (sketch[others] == sketch[one]).sum(axis=1)
            close = agree >= least
            found += [(-int(n), one, int(b)) for n, b in zip(agree[close], others[close])]
        if halves is None:
            found = _forest(sorted(found), comp)
        else:
            found = [pair for pair in found if similar(halves[pair[1]], halves[pair[2]])]
        return [(int(min(uid[a], uid[b])), int(max(uid[a], uid[b]))) for _, a, b in found]

    for table in _whole_groups(batches, names):
        columns = {name: table.column(name).to_numpy() for name in (*names, "block", "uid", "weight", "comp")}
        sketch = np.stack([np.frombuffer(one.as_buffer(), np.uint8) for one in table.column("sketch")])
        halves = None
        if "halves" in table.column_names:
            halves = [one.values.to_numpy() for one in table.column("halves").combine_chunks()]
        change = np.any([columns[name][1:] != columns[name][:-1] for name in names], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]
        found = []
        for a, b in zip(bounds, bounds[1:]):
            rows = {name: values[a:b] for name, values in columns.items()}
            found += pairs_of(rows, sketch[a:b], halves and halves[a:b])
        pairs = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _forest(found: list[tuple[int, int, int]], comp: np.ndarray) -> list[tuple[int, int, int]]:
    """The pairs, taken in their order, that join components not joined before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    taken = []
    for agree, a, b in found:
        one, two = root(int(comp[a])), root(int(comp[b]))
        if one != two:
            parent[one] = two
            taken.append((agree, a, b))
    return taken


def _whole_groups(batches, names: tuple[str, ...]):
    """Tables of sorted rows that split no group of equal ``names``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = [batch.column(name)[batch.num_rows - 1].as_py() for name in names]
        table = pa.Table.from_batches(held)
        same = np.all([table.column(name).to_numpy() == value for name, value in zip(names, last)], axis=0)
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, class_id, component_id, kept``.

    ``class_id`` is the least doc_id with the very same text, ``component_id`` the least
    doc_id reachable over links of at least ``similarity``, and ``kept`` tells the rows
    whose doc_id that is. Texts without words (null counts as empty) have no shingles
    and are alike only to equal texts. Rows that repeat both doc_id and text share
    their result. A row without a doc_id is always kept. Other columns are ignored.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows_in = docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(text).alias("uid"), text.alias("text")
    )
    links = near_links(
        rows_in.select("uid", "text"),
        shingle=shingle, similarity=similarity, bands=bands, rows=rows,
    )
    parts = connected_components(links, "a", "b")
    classes = written(rows_in.groupBy("uid").agg(F.min("doc_id").alias("class_id")))
    joined = written(classes.join(parts, classes["uid"] == parts["node"]).drop("node"))
    least = joined.groupBy("component").agg(F.min("class_id").alias("component_id"))
    linked = joined.join(least, "component").select("uid", "component_id")
    named = classes.join(linked, "uid", "left")
    result = rows_in.select("doc_id", "uid").join(named, "uid")
    return result.select(
        "doc_id",
        F.col("uid").alias("text_hash"),
        "class_id",
        F.coalesce("component_id", "class_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "class_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near-duplicates; columns unchanged.

    That of the least doc_id stays, and of rows that repeat a doc_id and text any one.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = written(near_duplicates(docs, **options).select("doc_id", "text_hash", "kept"))
    key = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")]
    surplus = found.filter("not kept").select(*key).distinct()
    repeated = found.filter("kept").groupBy(*key).count().filter("count > 1").drop("count")
    text_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))

    def keyed(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        condition = rows[id_col].eqNullSafe(keys["__id"]) & (text_hash == keys["__hash"])
        return rows.join(keys, condition, how)

    single = keyed(surplus.union(repeated), "left_anti", docs)
    several = keyed(repeated, "left_semi", docs).dropDuplicates([id_col, text_col])
    return single.union(several)
