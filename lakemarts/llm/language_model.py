"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Spark counts all n-grams of the training documents. An n-gram of count c gets the level
1 + floor(log(c / least) / log(BASE)) and is put into the filter once for each level up to
its own; its count is read back by probing level after level until one is missing. The
filter lies in segments by the n-grams' hashes and holds every n-gram, whatever the corpus.

The filter of a large corpus fits no single machine, so it stays where it is: texts are
dealt into blocks, the distinct n-grams of each block go to their segments, and only the
levels come back, a byte each, to be joined with the texts of the block.

The probability of a word after v is (c(v w) + mu * p(w)) / (c(v) + mu), where p is that of
the next lower order, down to the word's own share. mu is such that the mean weight of the
lower order is the share of n-grams seen once (Good and Turing's estimate of what is unseen).

The exact base score needs every token's own count: tokens with more than 1 / 2 ** HEAVY_BITS
of all are broadcast, fewer than 2 ** HEAVY_BITS; the others, none of which is frequent, are
joined to the distinct tokens of each block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import Words, added_rows, mix, run_hashes, words_of
from lakemarts.llm.frames import written

ORDER = 2
HEAVY_BITS = 20
#: Ratio of the counts of neighbouring levels.
BASE = 2
#: A probe looks for so many bits in one 64-bit word; with so many bits for each entry a
#: level is wrong for fewer than one in 100.
PROBE_BITS = 6
BITS_PER_ENTRY = 16
#: N-gram occurrences per segment of the filter while it is built, and most segments.
SEGMENT_GRAMS = 1 << 20
MOST_SEGMENT_BITS = 17
#: Bits of an n-gram's hash besides those of its segment: one in thousands meets another.
CODE_BITS = 32
#: N-grams that a task holds before it adds up equal ones.
COMBINED_GRAMS = 1 << 22
#: Bytes of the texts that are scored together.
BLOCK_BYTES = 3 << 22

# Fixed value: the bytes that separate words.
TOKEN_BYTES = np.ones(256, bool)
TOKEN_BYTES[[0x20, *range(0x09, 0x0E)]] = False
#: The closing token, and the context of a first word: no words, since they hold a separator.
END, BEGIN = " ", "\t"
_END, _BEGIN = np.uint64(0x9C5E3A7D11F0B2A4), np.uint64(0x51B7E90FD3C8642B)
_ORDER_SALT = [np.uint64(0x632BE59BD9B4E019 * (n + 1) % 2**64) for n in range(8)]


def held_out(id_column: Column) -> Column:
    """True for a seventh of all ids, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 7 == 2, F.lit(False))


@dataclass
class Tokens:
    """Words of some rows, each row closed by an end."""

    row: np.ndarray
    hashes: np.ndarray
    place: np.ndarray  # of each token in its row

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` tokens up to each; means nothing where a row has fewer.

        The token before a row's first is the begin.
        """
        total = np.zeros(len(self.hashes), np.uint64)
        for back in range(n):
            shifted = np.full(len(self.hashes), _BEGIN)
            shifted[back:] = self.hashes[: len(self.hashes) - back]
            shifted[self.place == back - 1] = _BEGIN
            total = mix(total ^ mix(shifted + _ORDER_SALT[back]))
        return mix(total ^ _ORDER_SALT[n])


def tokens_of(words: Words) -> Tokens:
    counts = words.counts
    closed = counts + 1
    row = np.repeat(np.arange(words.rows, dtype=np.int32), closed)
    place = np.arange(len(row), dtype=np.int32)
    place -= np.repeat((np.cumsum(closed) - closed).astype(np.int32), closed)
    hashes = np.full(len(row), _END)
    hashes[place < counts[row]] = words.hashes()
    return Tokens(row, hashes, place)


def _one_gram(hashes: np.ndarray) -> np.ndarray:
    """Hash of each token as an n-gram of its own."""
    return mix(mix(mix(hashes + _ORDER_SALT[0])) ^ _ORDER_SALT[1])


def _token_rows(batches):
    """Tokens and their counts, combined over each slice of texts."""
    for batch in batches:
        for words in words_of(batch.column("text"), TOKEN_BYTES):
            number, tokens = words.numbered()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([tokens.cast(pa.string()), pa.array([END])]),
                    pa.array(np.append(np.bincount(number, minlength=len(tokens)), words.rows)),
                ],
                ["token", "n"],
            )


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, n`` of all words and ends of the column ``text``; written."""
    return written(
        texts.mapInArrow(lambda batches: added_rows(_token_rows(batches), ["token"], ["n"]), "token string, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )


def _keys(grams: np.ndarray, segment_bits: int) -> np.ndarray:
    """Segment and code of each n-gram in one number; sorts by segment."""
    return grams >> np.uint64(64 - segment_bits - CODE_BITS)


def _begins(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys differ from the one before."""
    return np.append(True, keys[1:] != keys[:-1])[: len(keys)]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Each key once, sorted; numpy's own way of hashing takes several times longer."""
    keys = np.sort(keys)
    return keys[_begins(keys)]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    together = np.concatenate(keys)
    order = np.argsort(together)
    together = together[order]
    first = np.flatnonzero(_begins(together))
    times = np.concatenate(counts)[order]
    return together[first], np.add.reduceat(times, first) if len(first) else times


def _segment_cuts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments that sorted keys have, and where each begins; the end of the last one too."""
    present, first = np.unique((keys >> np.uint64(CODE_BITS)).astype(np.int32), return_index=True)
    return present, np.append(first, len(keys))


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at the given places."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    )


def _codes(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64((1 << CODE_BITS) - 1)).astype("<u4")


def _keys_of(codes: np.ndarray, segment: int) -> np.ndarray:
    return codes.astype(np.uint64) + np.uint64(segment << CODE_BITS)


def _packed(size: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each segment: its sorted codes, four bytes each, and their counts."""
    present, cuts = _segment_cuts(keys)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(present, pa.int32()),
            pa.array(np.full(len(present), size), pa.int32()),
            _binaries(_codes(keys), cuts),
            _binaries(counts.astype("<i8"), cuts),
        ],
        ["segment", "size", "codes", "counts"],
    )


_PACKED = "segment int, size int, codes binary, counts binary"


def _gram_rows(batches, order: int, segment_bits: int):
    """Packed n-grams of two and more tokens, added up over each batch of texts."""
    for batch in batches:
        found: dict[int, tuple[list, list]] = {n: ([], []) for n in range(2, order + 1)}
        for words in words_of(batch.column("text"), TOKEN_BYTES):
            tokens = tokens_of(words)
            for n, (keys, counts) in found.items():
                # A row's first token has a begin before it, but not two.
                own = _keys(tokens.grams(n)[tokens.place >= n - 2], segment_bits)
                distinct, times = np.unique(own, return_counts=True)
                keys.append(distinct)
                counts.append(times)
        for n, (keys, counts) in found.items():
            if keys:
                yield _packed(n, *_added(keys, counts))


def _token_gram_rows(batches, segment_bits: int):
    """Packed n-grams of one token, from the counts of tokens."""
    keys, counts = [], []

    def packed():
        return _packed(1, *_added(keys, counts))

    for batch in batches:
        texts, n = batch.column("token").cast(pa.large_string()), batch.column("n").to_numpy()
        _, ends, data = texts.buffers()
        offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        hashes = run_hashes(np.frombuffer(data, np.uint8), offsets[:-1], offsets[1:])
        is_end = np.diff(offsets) == 1
        is_end[is_end] = np.frombuffer(data, np.uint8)[offsets[:-1][is_end]] == ord(END)
        hashes[is_end] = _END
        # Every text has one begin for its one end.
        keys += [_keys(_one_gram(hashes), segment_bits), _keys(_one_gram(np.full(is_end.sum(), _BEGIN)), segment_bits)]
        counts += [n, n[is_end]]
        if sum(map(len, keys)) > COMBINED_GRAMS:
            yield packed()
            keys, counts = [], []
    if keys:
        yield packed()


def _level(counts: np.ndarray, least: int) -> np.ndarray:
    return 1 + np.floor(np.log(counts / least) / math.log(BASE) + 1e-9).astype(np.int64)


def _probe(keys: np.ndarray, level: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Place of a level's word among so many, and the bits that it has to have."""
    place = mix(keys + np.uint64(0x9E3779B97F4A7C15 * level % 2**64))
    bits = mix(place ^ np.uint64(0xA0761D6478BD642F))
    mask = np.zeros(len(keys), np.uint64)
    for i in range(PROBE_BITS):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * i)) & np.uint64(63))
    # The highest 32 bits, spread over the words.
    return ((place >> np.uint64(32)) * np.asarray(words, np.uint64) >> np.uint64(32)).astype(np.int64), mask


_SEGMENT_ROWS = (
    "segment int, words binary, size array<int>, level array<int>, grams array<bigint>, total array<bigint>, "
    "once array<bigint>"
)


def _segment_rows(batches, least: int):
    """Filters of whole segments, from packed n-grams sorted by segment.

    A task holds the distinct n-grams of one segment at a time.
    """
    held: dict[int, tuple[list, list]] = {}
    current, waiting = None, 0
    for batch in batches:
        for segment, size, codes, counts in zip(*[batch.column(name) for name in ("segment", "size", "codes", "counts")]):
            if segment.as_py() != current:
                if held:
                    yield _segment_row(current, held, least)
                held, current, waiting = {}, segment.as_py(), 0
            raw = np.frombuffer(codes.as_buffer(), "<u4")
            own = held.setdefault(size.as_py(), ([], []))
            own[0].append(_keys_of(raw, current))
            own[1].append(np.frombuffer(counts.as_buffer(), "<i8"))
            waiting += len(raw)
            if waiting > COMBINED_GRAMS:
                held = {n: tuple([part] for part in _added(*parts)) for n, parts in held.items()}
                waiting = 0
    if held:
        yield _segment_row(current, held, least)


def _segment_row(segment: int, held: dict[int, tuple[list, list]], least: int) -> pa.RecordBatch:
    """The filter of one segment, and by order and level its n-grams and their counts."""
    stats, entries = [], []
    for size, parts in sorted(held.items()):
        keys, counts = _added(*parts)
        keys, counts = keys[counts >= least], counts[counts >= least]
        level = _level(counts, least)
        entries.append((keys, level))
        for own in np.unique(level).tolist():
            these = counts[level == own]
            stats.append((size, own, len(these), int(these.sum()), int((these == 1).sum())))
    inserts = sum(int(level.sum()) for _, level in entries)
    words = np.zeros(inserts * BITS_PER_ENTRY // 64 + 1 if inserts else 0, np.uint64)
    for keys, level in entries:
        for step in range(1, int(level.max(initial=0)) + 1):
            place, mask = _probe(keys[level >= step], step, len(words))
            np.bitwise_or.at(words, place, mask)
    columns = [list(column) for column in zip(*stats)] if stats else [[]] * 5
    names = ("size", "level", "grams", "total", "once")
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([words.astype("<u8").tobytes()], pa.binary())]
        + [pa.array([column], pa.list_(kind)) for column, kind in zip(columns, kinds)],
        ["segment", "words", *names],
    )


def _levels(words: np.ndarray, keys: np.ndarray, most: int, start=0, size=None) -> np.ndarray:
    """Level of each key up to ``most``, by probes until one fails.

    The words of a key's segment are all of ``words``, or ``size`` of them from ``start`` on.
    """
    size = np.full(len(keys), len(words)) if size is None else size
    start = np.broadcast_to(start, len(keys))
    level = np.zeros(len(keys), np.int64)
    left = np.flatnonzero(size > 0)
    for step in range(1, most + 1):
        place, mask = _probe(keys[left], step, size[left])
        left = left[words[start[left] + place] & mask == mask]
        if not len(left):
            break
        level[left] = step
    return level


@dataclass
class Weights:
    """What is read from the levels, and the weights of lower orders."""

    means: list[np.ndarray]  # mean count of each order and level; 0 for level 0
    mu: list[float]
    tokens: int
    types: int
    rest: float  # mean count of the types that are not held

    @property
    def order(self) -> int:
        return len(self.means) - 1

    @property
    def most(self) -> int:
        """The highest level."""
        return max(len(means) for means in self.means) - 1

    def counts(self, levels: np.ndarray, n: int) -> np.ndarray:
        """Estimated counts of n-grams of order ``n``."""
        means = self.means[n]
        return means[np.minimum(levels, len(means) - 1)]

    def log_probabilities(self, tokens: Tokens, counts: list[np.ndarray], begin: float) -> np.ndarray:
        """log10 of the probability of each token after those before it in its row.

        ``counts`` has for each order the count of the n-gram that ends with the token; no
        matter which where a row has fewer tokens. ``begin`` is the count of the begin.
        """
        alone = counts[1]
        p = (np.where(alone > 0, alone, self.rest) + 1) / (self.tokens + self.types + 1)
        before = np.append(0, alone[:-1])
        before[tokens.place == 0] = begin
        for n in range(2, self.order + 1):
            found = np.where((tokens.place >= n - 2) & (before > 0), np.minimum(counts[n], before), 0)
            p = np.where(before > 0, (found + self.mu[n] * p) / (before + self.mu[n]), p)
            before = np.append(0, found[:-1])
            before[tokens.place < n - 1] = 0
        return np.log10(p)


@dataclass
class GramFilter:
    """All segments in one process, for a look into the model of a small corpus."""

    words: np.ndarray  # of all segments
    starts: np.ndarray  # first word of each segment
    sizes: np.ndarray  # words of each segment
    mu: list[float]
    most: int

    def levels(self, grams: np.ndarray) -> np.ndarray:
        keys = _keys(grams, len(self.sizes).bit_length() - 1)
        segment = (keys >> np.uint64(CODE_BITS)).astype(np.int64)
        return _levels(self.words, keys, self.most, self.starts[segment], self.sizes[segment])


def _prior_weight(contexts: list[tuple[float, float]], once: float, total: float) -> float:
    """mu for which the lower order has a mean weight of ``once / total``.

    ``contexts`` has (count, tokens that follow such a context).
    """
    target = min(max(once / total, 1e-3), 0.999) if total else 0.5
    followed = sum(weight for _, weight in contexts) or 1.0

    def weight(mu: float) -> float:
        return sum(w * mu / (c + mu) for c, w in contexts) / followed

    low, high = 1e-3, 1e9
    for _ in range(100):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if weight(middle) < target else (low, middle)
    return math.sqrt(low * high)


@dataclass
class LanguageModel:
    tokens: int
    types: int
    ends: int
    heavy: dict[str, int]
    heavy_bits: int
    counts: DataFrame  # token, n of all training tokens
    segments: DataFrame  # the filter, a row for each segment
    segment_bits: int
    weights: Weights

    @cached_property
    def filter(self) -> GramFilter:
        """The segments put together here; scoring does not need it."""
        rows = self.segments.select("segment", "words").toArrow().sort_by("segment")
        parts = [np.frombuffer(words.as_buffer(), "<u8") for words in rows["words"]]
        sizes = np.zeros(1 << self.segment_bits, np.int64)
        sizes[rows["segment"].to_numpy()] = [len(part) for part in parts]
        words = np.concatenate(parts) if parts else np.zeros(1, np.uint64)
        return GramFilter(words, np.cumsum(sizes) - sizes, sizes, self.weights.mu, self.weights.most)


def train_language_model(
    texts: DataFrame, *, order: int = ORDER, share_bits: int | None = None, heavy_bits: int = HEAVY_BITS
) -> LanguageModel:
    """A model of the column ``text`` of all rows of ``texts``; null counts as empty.

    It holds every n-gram. With ``share_bits`` it is smaller and holds those with more than
    1 / 2 ** share_bits of all tokens, fewer than 2 ** share_bits of each order.
    """
    counts = token_counts(texts)
    sums = counts.agg(
        F.sum("n").alias("tokens"),
        F.count("*").alias("types"),
        F.sum(F.when(F.col("token") == END, F.col("n"))).alias("ends"),
    ).first()
    tokens, types, ends = sums["tokens"] or 0, sums["types"], sums["ends"] or 0
    # Fewer than 2 ** heavy_bits tokens can be as frequent as that.
    frequent = counts.filter(F.col("n") > tokens >> heavy_bits).toArrow()
    heavy = dict(zip(frequent["token"].to_pylist(), frequent["n"].to_pylist()))
    least = 1 if share_bits is None else 1 + (tokens >> share_bits)
    segment_bits = min((tokens * order // SEGMENT_GRAMS).bit_length(), MOST_SEGMENT_BITS)
    packed = texts.mapInArrow(lambda batches: _gram_rows(batches, order, segment_bits), _PACKED).union(
        counts.mapInArrow(lambda batches: _token_gram_rows(batches, segment_bits), _PACKED)
    )
    held = written(
        packed.repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(lambda batches: _segment_rows(batches, least), _SEGMENT_ROWS)
    )
    weights = _weights(held, order, tokens, types)
    return LanguageModel(tokens, types, ends, heavy, heavy_bits, counts, held, segment_bits, weights)


def _weights(held: DataFrame, order: int, tokens: int, types: int) -> Weights:
    """Means and weights, from a few sums for each order and level."""
    names = ("grams", "total", "once")
    rows = (
        held.select(F.inline(F.arrays_zip("size", "level", *names)))
        .groupBy("size", "level")
        .agg(*[F.sum(name).alias(name) for name in names])
        .orderBy("size", "level")
        .collect()
    )
    by_kind = {(row["size"], row["level"]): [row[name] for name in names] for row in rows}
    means, mu = [np.zeros(1)], [0.0, 0.0]
    for n in range(1, order + 1):
        own = {level: numbers for (size, level), numbers in by_kind.items() if size == n}
        mean = np.zeros(max(own, default=0) + 1)
        for level, (grams, total, _) in own.items():
            mean[level] = total / grams
        means.append(mean)
        if n > 1:
            contexts = [(numbers[1] / numbers[0], numbers[1]) for (size, _), numbers in by_kind.items() if size == n - 1]
            mu.append(_prior_weight(contexts, sum(numbers[2] for numbers in own.values()), tokens))
    alone = [numbers for (size, _), numbers in by_kind.items() if size == 1]
    # The begin is held with the words, and is none.
    held_types = min(sum(numbers[0] for numbers in alone), types)
    held_tokens = min(sum(numbers[1] for numbers in alone), tokens)
    rest = (tokens - held_tokens) / (types - held_types) if types > held_types else 0.0
    return Weights(means, mu, tokens, types, rest)


def _keys_asked(tokens: Tokens, n: int, segment_bits: int) -> np.ndarray:
    """Keys of the n-grams of one order, where there are any; the begin ends those of order 1."""
    if n == 1:
        return _keys(_one_gram(np.append(tokens.hashes, _BEGIN)), segment_bits)
    return _keys(tokens.grams(n)[tokens.place >= n - 2], segment_bits)


def _distinct_keys(slices: list[Tokens], n: int, segment_bits: int) -> np.ndarray:
    """The sorted keys of one order that a block asks for, each once."""
    return _distinct(np.concatenate([_distinct(_keys_asked(tokens, n, segment_bits)) for tokens in slices]))


def _texts_of(table: pa.Table) -> pa.Array:
    # Offsets of 64 bits, so that the parts of a column fit together.
    return pa.concat_arrays([chunk.cast(pa.large_string()) for chunk in table.column("text").chunks])


_ASKED = "segment int, block int, size int, data binary"


def _asked(table: pa.Table, order: int, segment_bits: int) -> pa.Table:
    """The distinct n-grams of a block, a row for each order and segment."""
    block = table.column("block")[0].as_py()
    slices = [tokens_of(words) for words in words_of(_texts_of(table), TOKEN_BYTES)]
    rows = []
    for n in range(1, order + 1):
        keys = _distinct_keys(slices, n, segment_bits)
        present, cuts = _segment_cuts(keys)
        rows.append(
            pa.table(
                {
                    "segment": pa.array(present, pa.int32()),
                    "block": pa.array(np.full(len(present), block), pa.int32()),
                    "size": pa.array(np.full(len(present), n), pa.int32()),
                    "data": _binaries(_codes(keys), cuts),
                }
            )
        )
    return pa.concat_tables(rows)


def _looked_up(batches, most: int):
    """Levels of what was asked; the rows come sorted by segment, with its words first."""
    current, words = None, np.zeros(0, np.uint64)
    for batch in batches:
        segments, blocks = (batch.column(name).to_numpy() for name in ("segment", "block"))
        cuts = np.append(np.flatnonzero(np.diff(segments, prepend=-1)), len(segments)).tolist()
        for first, last in zip(cuts, cuts[1:]):
            segment = int(segments[first])
            if segment != current:
                current, words = segment, np.zeros(0, np.uint64)
            if blocks[first] < 0:
                words = np.frombuffer(batch.column("data")[first].as_buffer(), "<u8")
                first += 1
            if first == last:
                continue
            asked = batch.slice(first, last - first)
            data = asked.column("data")
            ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
            codes = np.frombuffer(data.buffers()[2], np.uint8)[ends[0] : ends[-1]].view("<u4")
            levels = _binaries(_levels(words, _keys_of(codes, segment), most).astype(np.uint8), (ends - ends[0]) // 4)
            yield pa.RecordBatch.from_arrays(
                [asked.column("block"), asked.column("size"), asked.column("segment"), levels],
                ["block", "size", "part", "levels"],
            )


def _rare_of(names: list[pa.Array], frequent: pa.Table) -> pa.Array:
    """The distinct words that are not frequent, sorted."""
    distinct = pc.unique(pa.chunked_array(names, pa.large_string()))
    rare = distinct.filter(pc.invert(pc.is_in(distinct, frequent["token"])))
    return rare.take(pc.sort_indices(rare))


def _rare_rows(table: pa.Table, heavy: Broadcast) -> pa.Table:
    names = [words.numbered()[1] for words in words_of(_texts_of(table), TOKEN_BYTES)]
    rare, block = _rare_of(names, heavy.value), table.column("block")[0].as_py()
    return pa.table(
        {
            "block": pa.array(np.full(len(rare), block), pa.int32()),
            "part": pa.array(np.arange(len(rare)), pa.int32()),
            "token": rare.cast(pa.string()),
        }
    )


def _base_scores(
    texts: pa.Array, answers: pa.Table, weights: Weights, frequent: pa.Table, ends: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[Tokens]]:
    """Tokens, known ones and base score of each text of a block; the tokens of its slices."""
    rows, slices, counted, names = len(texts), [], [], []
    for words in words_of(texts, TOKEN_BYTES):
        number, distinct = words.numbered()
        slices.append(tokens_of(words))
        counted.append((words.first_row, words.counts, number.astype(np.int32)))
        names.append(distinct)
    rare = _rare_of(names, frequent)
    joined = answers.filter(pc.equal(answers["size"], 0))
    times = np.zeros(len(rare), np.int64)
    times[joined["part"].to_numpy()] = joined["n"].to_numpy()
    # Of each word, frequent or rare; no word is both.
    held = pa.concat_arrays([*(chunk for chunk in frequent["token"].chunks), rare])
    times = np.append(frequent["n"].to_numpy(), times)
    n_tokens, known = np.zeros(rows, np.int64), np.full(rows, int(ends > 0), np.int64)
    base = np.zeros(rows)
    # All slices at once, since the words held are hashed for each call.
    times = times[pc.index_in(pa.concat_arrays(names), held).to_numpy()]
    cuts = np.cumsum([0, *map(len, names)])
    for (first, sizes, number), begin, end in zip(counted, cuts, cuts[1:]):
        counts = times[begin:end][number]
        row, these = np.repeat(np.arange(len(sizes)), sizes), slice(first, first + len(sizes))
        n_tokens[these] = sizes + 1
        known[these] += np.bincount(row[counts > 0], minlength=len(sizes))
        base[these] = np.bincount(row, np.log10(counts + 1.0), minlength=len(sizes))
    base += math.log10(ends + 1) - math.log10(weights.tokens + weights.types + 1) * n_tokens
    return n_tokens, known, base, slices


def _scored(table: pa.Table, answers: pa.Table, weights: Weights, segment_bits: int, heavy: Broadcast, ends: int) -> pa.Table:
    """The scores of a block's texts, from the levels and counts of what was asked.

    Besides the block's tokens and distinct n-grams, only one slice of its texts is held
    in numbers at a time.
    """
    texts = _texts_of(table)
    n_tokens, known, base, slices = _base_scores(texts, answers, weights, heavy.value, ends)
    asked, levels = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for n in range(1, weights.order + 1):
        asked.append(_distinct_keys(slices, n, segment_bits))
        own_levels = answers.filter(pc.equal(answers["size"], n)).sort_by("part")["levels"]
        levels.append(np.frombuffer(b"".join(own_levels.to_pylist()), np.uint8))
        if len(levels[n]) != len(asked[n]):
            raise ValueError(f"{len(asked[n])} n-grams were asked for, but {len(levels[n])} levels came back")
    score, first = np.zeros(len(texts)), 0
    for tokens in slices:
        counts, begin = [np.zeros(0)], 0.0
        for n in range(1, weights.order + 1):
            # Sorted keys are found faster.
            distinct, at = np.unique(_keys_asked(tokens, n, segment_bits), return_inverse=True)
            found = weights.counts(levels[n][np.searchsorted(asked[n], distinct)], n)[at]
            if n == 1:
                counts.append(found[:-1])
                begin = found[-1]
            else:
                counts.append(np.zeros(len(tokens.row)))
                counts[n][tokens.place >= n - 2] = found
        logs = weights.log_probabilities(tokens, counts, begin)
        # Every row has a token at least: its end.
        rows = int(tokens.row[-1]) + 1
        score[first : first + rows] = np.bincount(tokens.row, logs, minlength=rows)
        first += rows
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "n_tokens": pa.array(n_tokens),
            "n_known": pa.array(known),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
    )


def score_texts(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row, from its whole text.

    ``base_score`` is exact: the sum over the text's words and its end of log10((c + 1) /
    (N + V + 1)). ``score`` is the log10 probability of the text by the filter's counts.
    Null and empty texts have only an end. Rows that repeat an id are scored by themselves;
    other columns are ignored. A model of no texts knows no token and gives every one the
    same probability. Rows of one id and text are in one block, so all of them have to fit
    a task.
    """
    heavy = docs.sparkSession.sparkContext.broadcast(
        pa.table(
            {
                "token": pa.array(model.heavy.keys(), pa.large_string()),
                "n": pa.array(model.heavy.values(), pa.int64()),
            }
        )
    )
    order, bits, ends, weights = model.weights.order, model.segment_bits, model.ends, model.weights
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint") + 64).alias("n")).first()["n"] or 0
    # Blocks follow from the rows alone, so what is asked and what is scored is the same.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK_BYTES + 1)).cast("int")
    blocks = rows.select(block.alias("block"), "doc_id", "text").repartition("block")
    asked = blocks.groupBy("block").applyInArrow(lambda table: _asked(table, order, bits), _ASKED)
    words = model.segments.select("segment", F.lit(-1).alias("block"), F.lit(0).alias("size"), F.col("words").alias("data"))
    levels = (
        words.union(asked)
        .repartition("segment")
        .sortWithinPartitions("segment", "block")
        .mapInArrow(lambda batches: _looked_up(batches, weights.most), "block int, size int, part int, levels binary")
    )
    # What is not among them has no count.
    others = model.counts.filter(F.col("n") <= model.tokens >> model.heavy_bits)
    rare = (
        blocks.groupBy("block")
        .applyInArrow(lambda table: _rare_rows(table, heavy), "block int, part int, token string")
        .join(others, "token")
        .select("block", F.lit(0).alias("size"), "part", "n")
    )
    answers = levels.unionByName(rare, allowMissingColumns=True)
    return written(
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            lambda table, found: _scored(table, found, weights, bits, heavy, ends),
            f"doc_id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double",
        )
    )
