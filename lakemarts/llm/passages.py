"""Substring deduplication by collinear chaining.

Seeds are five-word grams, one in six by their hash alone, so that edits around a gram
do not change whether it is a seed: edited passages keep the seeds between their edits, and
a single one starts an alignment. A seed that occurred in another document before, by doc_id, ties its place
to its first occurrence, and one that occurred in its own to the last before it; a
seed at n places makes at most 2n ties, not n squared. Long grams are tied in the same
way: parts of a passage may have stood in other documents before, whole stretches across
their joints only where the passage did. The
ties of two documents are chained: a chain runs forward in both, gains by each seed
and pays for gaps, and a Fenwick tree over the second document's positions finds the
best predecessor. Chains are then aligned word by word, within gaps and beyond their
ends, and passages that are long and similar enough are reported.

Every long gram of a passage may have stood in earlier documents that lack the passage. So
windows of as many words as a passage has at least, that no reported passage covers and
that may have occurred before, are then tied whole to their first occurrence, and
neighbouring ones joined to exact repetitions: no exact passage depends on where its parts stood.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.arrays import gram_hashes, list_array, minimizers, mix, row_slices, sliding, words_of
from lakemarts.llm.frames import discard, keyed_texts, left_join_null_safe, membership_filter, might_hold, written

SEED = 5
#: One gram in so many is a seed.
SAMPLE = 6
#: Words of a long gram, and in how many grams one is chosen: any 50 equal words share one.
LONG = 32
LONG_WINDOW = 19
#: Reported passages have at least so many words, and so much of them agrees.
LEAST_WORDS = 50
LEAST_IDENTITY = 0.8
#: Cost of each word skipped on either side of a chain, in words gained.
GAP_COST = 0.05
#: Neighbouring seeds of one passage are at most so far apart.
LONGEST_GAP = 60
#: An extension ends when it is so far below its best score: a word that agrees gains 1,
#: another costs 2.
DROP = 10
#: Where words were put in or left out, the next ones of both sides are aligned with each
#: other, if so many of them are common.
BRIDGE = 16
LEAST_COMMON = 4


def _chosen(words, seed: int, sample: int, long: int, long_window: int):
    """Grams chosen as seeds and as long grams: places among the words, hashes, and which are long."""
    hashes, left = words.hashes(), words.words_left()
    grams = gram_hashes(hashes, seed)
    at = np.flatnonzero((left >= seed) & (grams % np.uint64(sample) == 0))
    places, values = [at], [grams[at]]
    if long > seed:
        grams = gram_hashes(hashes, long)
        at = np.flatnonzero(minimizers(grams, left - long + 1, long_window))
        places.append(at)
        values.append(grams[at])
    return np.concatenate(places), np.concatenate(values), np.arange(sum(map(len, places))) >= len(places[0])


def _seeds(batches, *sizes: int):
    for batch in batches:
        for words in words_of(batch.column("text")):
            # One value per slice and seed says little about repeats: count them here.
            values, counts = np.unique(_chosen(words, *sizes)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], ["seed", "n"]
            )


def _places(batches, known: np.ndarray, *sizes: int):
    for batch in batches:
        for words in words_of(batch.column("text")):
            at, grams, long = _chosen(words, *sizes)
            kept = might_hold(known, grams)
            at, grams, long = at[kept], grams[kept], long[kept]
            row = words.row_of_word()[at]
            rows = pa.array(words.first_row + row)
            place = (at - words.word_offsets[row]).astype(np.int32)
            order = np.lexsort((at, grams, row))
            again = np.zeros(len(at), bool)
            again[1:] = (np.diff(row[order]) == 0) & (grams[order][1:] == grams[order][:-1])
            previous = np.full(len(at), -1, np.int32)
            previous[order[again]] = place[order[np.flatnonzero(again) - 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(grams.view(np.int64)),
                    pa.array(place),
                    pa.array(previous),
                    pa.array(long),
                ],
                ["doc_id", "text_hash", "seed", "place", "previous", "long"],
            )


def _word_rows(batches, known: np.ndarray):
    for batch in batches:
        hit = might_hold(known, batch.column("text_hash").to_numpy())
        batch = batch.filter(pa.array(hit))
        for words in words_of(batch.column("text")):
            rows = slice(words.first_row, words.first_row + words.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text_hash")[rows],
                    list_array(
                        pa.array(words.hashes().view(np.int64).astype(np.int32)), words.counts
                    ),
                ],
                ["text_hash", "words"],
            )


def chains(
    x: list[int], y: list[int], seed: int = SEED, gap_cost: float = GAP_COST, longest_gap: int = LONGEST_GAP
) -> list[list[int]]:
    """Chains of ties (``x`` ascending), best first; every tie is in one chain at most."""
    ranks = {value: rank + 1 for rank, value in enumerate(sorted(set(y)))}
    size = len(ranks) + 1
    best, best_at = [float("-inf")] * size, [-1] * size
    score, before = [0.0] * len(x), [-1] * len(x)
    first = 0
    for index in range(len(x)):
        # Ties of one place in the first document cannot follow each other.
        if index and x[index] != x[first]:
            for done in range(first, index):
                value, at = score[done] + gap_cost * (x[done] + y[done]), ranks[y[done]]
                while at < size:
                    if value > best[at]:
                        best[at], best_at[at] = value, done
                    at += at & -at
            first = index
        at, value, previous = ranks[y[index]] - 1, float("-inf"), -1
        while at:
            if best[at] > value:
                value, previous = best[at], best_at[at]
            at -= at & -at
        gain = value - gap_cost * (x[index] + y[index])
        if gain > 0:
            score[index], before[index] = seed + gain, previous
        else:
            score[index] = seed
    used, found = [False] * len(x), []
    for last in sorted(range(len(x)), key=lambda index: -score[index]):
        chain = []
        at = last
        while at >= 0 and not used[at]:
            if chain and max(x[chain[-1]] - x[at], y[chain[-1]] - y[at]) > longest_gap + seed:
                break
            used[at] = True
            chain.append(at)
            at = before[at]
        if chain:
            found.append(chain[::-1])
    return found


def _chained(batches, seed: int):
    """Chains of each pair of documents; the rows come sorted by pair."""
    names = ["doc_id", "text_hash", "doc_id0", "text_hash0"]
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        x, y = table.column("place").to_numpy(), table.column("place0").to_numpy()
        pairs = [table.column(name).combine_chunks() for name in names]
        change = np.ones(len(x), bool)
        for column in pairs:
            codes = column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            change[1:] &= codes[1:] == codes[:-1]
        change[1:] = ~change[1:]
        bounds = [*np.flatnonzero(change).tolist(), len(x)]
        rows, xs, ys = [], [], []
        x, y = x.tolist(), y.tolist()
        for a, b in zip(bounds, bounds[1:]):
            own_x, own_y = x[a:b], y[a:b]
            if b - a == 1:
                rows.append(a)
                xs.append(own_x)
                ys.append(own_y)
                continue
            low = own_x[0]
            covered = bytearray(own_x[-1] - low + seed)
            for chain in chains(own_x, own_y, seed):
                # What lies within a better chain would be aligned to the same passage again.
                begin, end = own_x[chain[0]] - low, own_x[chain[-1]] - low + seed
                if covered[begin] and covered[end - 1]:
                    continue
                covered[begin:end] = bytes([1]) * (end - begin)
                rows.append(a)
                xs.append([own_x[i] for i in chain])
                ys.append([own_y[i] for i in chain])
        taken = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*[column.take(taken) for column in pairs], pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32()))],
            [*names, "xs", "ys"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        row = batch.num_rows - 1
        last = [batch.column(name)[row] for name in names]
        first = [held[0].column(name)[0] for name in names]
        if last == first:
            continue  # one pair fills all that is held; its size is that of a document
        start = row
        while start and all(batch.column(name)[start - 1] == value for name, value in zip(names, last)):
            start -= 1
        yield work(pa.Table.from_batches([*held[:-1], batch.slice(0, start)]))
        held = [batch.slice(start)]
    if held:
        yield work(pa.Table.from_batches(held))


#: Stand for words beyond the end of a sequence; equal to no word and not to each other.
_NO_WORD, _NO_WORD0 = 1 << 40, 1 << 41
#: Words of a run looked at first; most runs end within them.
FIRST_LOOK = 24
#: Sequences aligned at a time, which bounds the memory.
BLOCK = 4096


class _Sides:
    """Many pairs of word sequences, each read from a place on, in one direction."""

    def __init__(self, a, at, left, b, at0, left0, step):
        self.a, self.at, self.left, self.b, self.at0, self.left0, self.step = a, at, left, b, at0, left0, step

    def take(self, rows) -> _Sides:
        return _Sides(
            self.a, self.at[rows], self.left[rows], self.b, self.at0[rows], self.left0[rows], self.step[rows]
        )

    def on(self, x, y) -> _Sides:
        """The sequences after their first ``x`` and ``y`` words."""
        return _Sides(
            self.a, self.at + self.step * x, self.left - x, self.b, self.at0 + self.step * y, self.left0 - y, self.step
        )

    def first(self, n: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables of the first words of both sides, a sequence per row."""
        return (
            self._words(self.a, self.at, self.left, n, _NO_WORD),
            self._words(self.b, self.at0, self.left0, n0, _NO_WORD0),
        )

    def _words(self, values, at, left, n: int, none: int) -> np.ndarray:
        column = np.arange(n)
        inside = column < left[:, None]
        if not len(values):
            return np.full(inside.shape, none, np.int64)
        places = np.clip(at[:, None] + self.step[:, None] * column, 0, len(values) - 1)
        return np.where(inside, values[places].astype(np.int64), none)


def _gap_matches(sides: _Sides) -> np.ndarray:
    """Words that a best alignment of two gaps keeps."""
    out = np.zeros(len(sides.at), np.int64)
    order = np.lexsort((sides.left0, sides.left))
    order = order[(sides.left[order] > 0) & (sides.left0[order] > 0)]
    for begin in range(0, len(order), BLOCK):
        rows = order[begin : begin + BLOCK]
        part = sides.take(rows)
        a, b = part.first(int(part.left.max()), int(part.left0.max()))
        n = min(a.shape[1], b.shape[1])
        out[rows] = (a[:, :n] == b[:, :n]).sum(axis=1)
        hard = np.flatnonzero((part.left != part.left0) | (out[rows] * 2 < part.left))
        a, b = a[hard], b[hard]
        row = np.zeros((len(hard), b.shape[1] + 1), np.int32)
        for i in range(a.shape[1] if len(hard) else 0):
            kept = np.maximum(row[:, 1:], row[:, :-1] + (b == a[:, i, None]))
            np.maximum.accumulate(kept, axis=1, out=row[:, 1:])
        out[rows[hard]] = row[:, -1]
    return out


def _extensions(sides: _Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far the sequences of each pair go on alike, in each of them, and how many words agree.

    Words may be replaced anywhere; where they cease to agree, the sequences go on beside
    each other if a few words were put in or left out.
    """
    n = len(sides.at)
    # Score, words on either side and words that agree: where the alignment stands, and at best.
    now, best = np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)
    for begin in range(0, n, BLOCK):
        rows = np.arange(begin, min(begin + BLOCK, n))
        while len(rows):
            rest = sides.take(rows).on(now[rows, 1], now[rows, 2])
            length, same = _runs(rest)
            now[rows] += np.stack([3 * same - 2 * length, length, length, same], axis=1)
            old, new = best[rows], now[rows]
            better, tied = np.zeros(len(rows), bool), np.ones(len(rows), bool)
            for column in range(4):
                better |= tied & (new[:, column] > old[:, column])
                tied &= new[:, column] == old[:, column]
            best[rows[better]] = new[better]
            rest = rest.on(length, length)
            gain, i, j = _bridges(rest)
            going = np.flatnonzero((i > 0) & (now[rows, 0] + gain >= best[rows, 0] - DROP))
            rows, rest = rows[going], rest.take(going)
            gain, i, j = gain[going], i[going], j[going]
            rest.left, rest.left0 = i, j
            now[rows] += np.stack([gain, i, j, _gap_matches(rest)], axis=1)
    return best[:, 1], best[:, 2], best[:, 3]


def _runs(sides: _Sides) -> tuple[np.ndarray, np.ndarray]:
    """Length of the best common run with replaced words, and how many words agree."""
    n = np.minimum(sides.left, sides.left0)
    length, same = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    rows, width = np.flatnonzero(n > 0), FIRST_LOOK
    while len(rows):
        width = min(width, int(n[rows].max()))
        a, b = sides.take(rows).first(width, width)
        score = np.cumsum(np.where(a == b, 1, -2), axis=1)
        ended = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > DROP
        ended |= np.arange(width) >= n[rows, None]
        stop = np.where(ended.any(axis=1), ended.argmax(axis=1), width)
        score = np.where(np.arange(width) < stop[:, None], score, -1)
        last = score.argmax(axis=1)
        most = score[np.arange(len(rows)), last]
        length[rows] = np.where(most > 0, last + 1, 0)
        same[rows] = np.where(most > 0, (most + 2 * (last + 1)) // 3, 0)
        rows = rows[(stop == width) & (n[rows] > width)]
        width *= 8
    return length, same


def _bridges(sides: _Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of the best alignment from the start of two short sequences, and where it ends.

    It ends with a word that agrees; of equal scores the longest counts. Zeros where
    hardly any word agrees.
    """
    gain, x, y = np.zeros((3, len(sides.at)), np.int64)
    rows = np.flatnonzero(np.minimum(sides.left, sides.left0) >= LEAST_COMMON)
    a, b = sides.take(rows).first(BRIDGE, BRIDGE)
    common = np.zeros(len(rows), np.int64)
    for i in range(BRIDGE):
        common += (b == a[:, i, None]).any(axis=1)
    some = common >= LEAST_COMMON
    rows, a, b = rows[some], a[some], b[some]
    cost, column = 2 * np.arange(BRIDGE + 1), np.arange(1, BRIDGE + 1)

    def ranked(score, i, j):
        """One number that orders by score, then by length, then by place."""
        return (((score + 4 * BRIDGE) * 4 * BRIDGE + i + j) * 2 * BRIDGE + i) * 2 * BRIDGE + j

    row = np.repeat(-cost[None], len(rows), axis=0)
    best = np.full(len(rows), ranked(-DROP, 0, 0))
    for i in range(1, BRIDGE + 1):
        same = b == a[:, i - 1, None]
        across = row[:, :-1] + np.where(same, 1, -2)
        row = row - 2
        np.maximum(row[:, 1:], across, out=row[:, 1:])
        row = np.maximum.accumulate(row + cost, axis=1) - cost
        ends = same & (across == row[:, 1:])
        np.maximum(best, np.where(ends, ranked(across, i, column), 0).max(axis=1), out=best)
    gain[rows] = best // (16 * BRIDGE**3) - 4 * BRIDGE
    x[rows], y[rows] = best // (2 * BRIDGE) % (2 * BRIDGE), best % (2 * BRIDGE)
    return gain, x, y


def alignments(
    a: np.ndarray, bounds: np.ndarray, b: np.ndarray, bounds0: np.ndarray,
    xs: np.ndarray, ys: np.ndarray, ties: np.ndarray, seed: int = SEED,
) -> tuple[np.ndarray, ...]:
    """Like :func:`align` for many chains at once, with numpy over all of them.

    Chain ``i`` has the ties from ``ties[i]`` to ``ties[i + 1]``; its words lie in ``a`` from
    ``bounds[i]`` to ``bounds[i + 1]`` and likewise in ``b``, and its ties are counted from there.
    """
    n = len(ties) - 1
    chain = np.repeat(np.arange(n), np.diff(ties))
    x, y = xs + bounds[chain], ys + bounds0[chain]
    follows = np.flatnonzero(chain[1:] == chain[:-1])
    gap, gap0 = x[follows + 1] - x[follows] - seed, y[follows + 1] - y[follows] - seed
    apart = (gap >= 0) & (gap0 >= 0)
    # A tie that overlaps the one before adds only what is new on both sides.
    gain = np.where(apart, seed, np.minimum(gap, gap0) + seed)
    at = follows[apart]
    ones = np.ones(len(at), np.int64)
    gain[apart] += _gap_matches(_Sides(a, x[at] + seed, gap[apart], b, y[at] + seed, gap0[apart], ones))
    agree = seed + np.bincount(chain[follows], gain, n).astype(np.int64)
    first, last, first0, last0 = x[ties[:-1]], x[ties[1:] - 1] + seed, y[ties[:-1]], y[ties[1:] - 1] + seed
    left, left0, left_agree = _extensions(
        _Sides(a, first - 1, first - bounds[:-1], b, first0 - 1, first0 - bounds0[:-1], np.full(n, -1))
    )
    right, right0, right_agree = _extensions(
        _Sides(a, last, bounds[1:] - last, b, last0, bounds0[1:] - last0, np.ones(n, np.int64))
    )
    return (
        first - left - bounds[:-1], last + right - bounds[:-1],
        first0 - left0 - bounds0[:-1], last0 + right0 - bounds0[:-1],
        agree + left_agree + right_agree,
    )


def align(
    a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray, seed: int = SEED
) -> tuple[int, int, int, int, int]:
    """(start, end) in ``a`` and in ``b`` of an aligned chain, and the words that agree."""
    ends = np.array([0, len(a)]), np.array([0, len(b)])
    out = alignments(a, ends[0], b, ends[1], xs, ys, np.array([0, len(xs)]), seed)
    return tuple(int(value[0]) for value in out)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and where each list begins among them."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(), offsets - offsets[0]


def _aligned(batches, seed: int, least_words: int, least_identity: float):
    for batch in batches:
        (a, bounds), (b, bounds0), (xs, ties), (ys, _) = (
            _flat(batch.column(name)) for name in ("words", "words0", "xs", "ys")
        )
        shift, shift0 = batch.column("from").to_numpy(), batch.column("from0").to_numpy()
        counts = np.diff(ties)
        start, end, start0, end0, agree = alignments(
            a, bounds, b, bounds0, xs - np.repeat(shift, counts), ys - np.repeat(shift0, counts), ties, seed
        )
        identity = agree / np.maximum(end - start, end0 - start0)
        rows = np.flatnonzero((end - start >= least_words) & (identity >= least_identity))
        taken = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name).take(taken) for name in ("doc_id", "text_hash", "doc_id0", "text_hash0")],
                *[
                    pa.array((value + moved)[rows].astype(np.int32))
                    for value, moved in ((start, shift), (end, shift), (start0, shift0), (end0, shift0))
                ],
                pa.array(identity[rows]),
            ],
            ["doc_id", "text_hash", "doc_id0", "text_hash0", "start", "end", "start0", "end0", "identity"],
        )


#: Slots of windows, or words, that are taken together; a longer document is taken by itself.
SLICE_WORDS = 1_000_000
#: Stands where no long gram begins.
_NO_GRAM = np.uint64(2**64 - 1)


def _open_windows(batches, span: int):
    """Windows whose least long gram has stood before: ranges of their first words, by document.

    A window has ``span`` places for a long gram. The least one among them is chosen wherever the
    window occurs; where that is its first place, the window has not occurred before.
    """
    for batch in batches:
        marks = batch.column("marks")
        bounds = marks.offsets.to_numpy().astype(np.int64)
        place, gram, first = (part.to_numpy(zero_copy_only=False) for part in marks.flatten().flatten())
        bounds -= bounds[0]
        if not len(place):
            continue
        most = np.maximum.reduceat(place, bounds[:-1]).astype(np.int64)
        offsets = np.append(0, np.cumsum(most + 1 + span))
        for a, b in row_slices(offsets, SLICE_WORDS):
            base = offsets[a : b + 1] - offsets[a]
            own = slice(bounds[a], bounds[b])
            slot = place[own] + np.repeat(base[:-1], np.diff(bounds[a : b + 1]))
            least = np.full((2, base[-1]), _NO_GRAM)
            least[first[own].astype(int), slot] = gram[own].view(np.uint64)
            least = sliding(np.minimum, least, span)
            still = (least[0] <= least[1]) & (least[0] != _NO_GRAM)
            # Behind the last mark of a document the next one would be looked into.
            still &= np.arange(base[-1]) - np.repeat(base[:-1], np.diff(base)) <= np.repeat(most[a:b], np.diff(base))
            edge = np.diff(still.astype(np.int8), prepend=0, append=0)
            low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            row = np.searchsorted(base, low, "right") - 1
            counts = np.bincount(row, minlength=b - a)
            some = np.flatnonzero(counts)
            taken = pa.array(some + a)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("text_hash").take(taken),
                    *[list_array(pa.array((ends - base[row]).astype(np.int32)), counts[some]) for ends in (low, high)],
                ],
                ["doc_id", "text_hash", "lows", "highs"],
            )


def _held(batches, known: np.ndarray):
    """Rows whose text may be wanted, so that the join behind shuffles few others."""
    for batch in batches:
        yield batch.filter(pa.array(might_hold(known, batch.column("text_hash").to_numpy())))


def _uncovered(batches, least_words: int):
    """First words of the windows that lie in no reported passage."""
    for batch in batches:
        rows, places = [], []
        columns = [batch.column(name) for name in ("lows", "highs", "starts", "ends")]
        for row in range(batch.num_rows):
            lows, highs = (columns[i][row].values.to_numpy() for i in (0, 1))
            change = np.zeros(highs[-1] + 1, np.int32)
            change[lows] = 1
            change[highs] = -1
            inside = np.cumsum(change[:-1]) > 0
            if columns[2][row].is_valid:
                starts, ends = (columns[i][row].values.to_numpy() for i in (2, 3))
                change[:] = 0
                np.add.at(change, np.minimum(starts, highs[-1]), 1)
                np.add.at(change, np.minimum(ends - least_words + 1, highs[-1]), -1)
                inside &= np.cumsum(change[:-1]) == 0
            if inside.any():
                rows.append(row)
                places.append(np.flatnonzero(inside).astype(np.int32))
        taken = pa.array(rows, pa.int64())
        values = pa.array(np.concatenate(places) if places else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(taken),
                batch.column("text_hash").take(taken),
                list_array(values, np.array([len(part) for part in places], np.int64)),
            ],
            ["doc_id", "text_hash", "places"],
        )


def _window_slices(batch: pa.RecordBatch, least_words: int):
    """Slices of rows: the first one, bounds of each row's words, and the hash of the window from each word."""
    words, bounds = _flat(batch.column("words"))
    for a, b in row_slices(bounds, SLICE_WORDS):
        own = words[bounds[a] : bounds[b]].astype(np.int64).view(np.uint64)
        yield a, bounds[a : b + 1] - bounds[a], gram_hashes(mix(own), least_words).view(np.int64)


def _late_windows(batches, least_words: int):
    """Hashes of the windows at ``places``."""
    for batch in batches:
        places, each = _flat(batch.column("places"))
        for a, base, grams in _window_slices(batch, least_words):
            n = len(base) - 1
            row = np.repeat(np.arange(n), np.diff(each[a : a + n + 1]))
            place = places[each[a] : each[a + n]]
            at = base[row] + place
            whole = at + least_words <= base[row + 1]
            taken = pa.array(row[whole] + a)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("text_hash").take(taken),
                    pa.array(grams[at[whole]]),
                    pa.array(place[whole]),
                ],
                ["doc_id", "text_hash", "gram", "place"],
            )


def _all_windows(batches, known: np.ndarray, least_words: int):
    """Hashes of all windows that may be among the known ones."""
    for batch in batches:
        for a, base, grams in _window_slices(batch, least_words):
            row = np.repeat(np.arange(len(base) - 1), np.diff(base))
            at = np.flatnonzero(np.arange(len(row)) + least_words <= base[row + 1])
            at = at[might_hold(known, grams[at])]
            taken = pa.array(row[at] + a)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("text_hash").take(taken),
                    pa.array(grams[at]),
                    pa.array((at - base[row[at]]).astype(np.int32)),
                ],
                ["doc_id", "text_hash", "gram", "place"],
            )


def repeated_passages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    sample: int = SAMPLE,
    least_words: int = LEAST_WORDS,
    least_identity: float = LEAST_IDENTITY,
) -> DataFrame:
    """Passages that occurred before, in the order of doc_id, text hash and position.

    Returns ``doc_id, text_hash, start, end`` of the repetition, ``doc_id0, text_hash0, start0,
    end0`` of an earlier occurrence, all in words with exclusive ends, and ``identity``, the
    share of words that agree. A passage may repeat one of its own document. Null and
    empty texts have no words. A null doc_id is the least. Rows that repeat both doc_id
    and text are one document here. Every window of ``least_words`` words that occurred before,
    word for word, lies in a reported passage, wherever its parts stood. Of edited passages
    only those are found that a seed or long gram ties to its first occurrence.
    """
    texts = keyed_texts(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    key, key0 = ["doc_id", "text_hash"], ["doc_id0", "text_hash0"]
    long = max(seed, min(LONG, least_words))
    sizes = (seed, sample, long, max(1, min(LONG_WINDOW, least_words - long + 1)))
    seeds = texts.select("text").mapInArrow(
        lambda batches: _seeds(batches, *sizes), "seed bigint, n bigint"
    )
    repeated = written(seeds.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1").select("seed"))
    known = membership_filter(repeated, "seed", sized=True)
    discard(repeated)
    places = written(
        texts.mapInArrow(
            lambda batches: _places(batches, known.value, *sizes),
            f"doc_id {id_type}, text_hash bigint, seed bigint, place int, previous int, long boolean",
        )
    )
    order = F.struct(*key, "place")
    # Written before the join, so that a seed in very many texts can be split there.
    firsts = written(
        places.groupBy("seed")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"), F.bool_or("long").alias("is_long"))
        .filter("first < last")
        .select(
            "seed",
            F.col("first.doc_id").alias("doc_id0"),
            F.col("first.text_hash").alias("text_hash0"),
            F.col("first.place").alias("place0"),
            "is_long",
        )
    )
    same_doc = F.col("doc_id").eqNullSafe(F.col("doc_id0")) & (F.col("text_hash") == F.col("text_hash0"))
    elsewhere = places.join(firsts, "seed").filter(~same_doc).select(*key, *key0, "place", "place0", "long")
    # Within a document a seed is tied to the one before, so text that repeats itself at
    # a short distance makes one long chain.
    within = places.filter("previous >= 0").select(
        *key,
        F.col("doc_id").alias("doc_id0"),
        F.col("text_hash").alias("text_hash0"),
        "place",
        F.col("previous").alias("place0"),
        "long",
    )
    # A long gram counts as the seeds at both its ends.
    ends = F.explode(F.when(F.col("long"), F.array(F.lit(0), F.lit(long - seed))).otherwise(F.array(F.lit(0))))
    ties = (
        elsewhere.union(within)
        .withColumn("end", ends)
        .select(*key, *key0, (F.col("place") + F.col("end")).alias("place"), (F.col("place0") + F.col("end")).alias("place0"))
        .repartition(*key, *key0)
        .distinct()  # needs no further shuffle
        .sortWithinPartitions(*key, *key0, "place", "place0")
    )
    found = written(
        ties.mapInArrow(
            lambda batches: _chained(batches, seed),
            f"doc_id {id_type}, text_hash bigint, doc_id0 {id_type}, text_hash0 bigint, "
            "xs array<int>, ys array<int>",
        )
    )
    marks = (
        places.filter("long")
        .join(firsts.filter("is_long"), "seed")
        .select(*key, "place", F.col("seed").alias("gram"), (same_doc & (F.col("place") == F.col("place0"))).alias("first"))
        .repartition(*key)
        .distinct()  # needs no further shuffle, nor does the grouping
        .groupBy(*key)
        .agg(F.collect_list(F.struct("place", "gram", "first")).alias("marks"))
    )
    opened = written(
        marks.mapInArrow(
            lambda batches: _open_windows(batches, sizes[3]),
            f"doc_id {id_type}, text_hash bigint, lows array<int>, highs array<int>",
        )
    )
    discard(places, firsts)
    # Every text with a repeated long gram is among them, and the first document that has it.
    sides = F.explode(F.array(F.struct(*key), F.struct(*[F.col(a).alias(b) for a, b in zip(key0, key)])))
    named = written(
        found.select(sides.alias("side"))
        .groupBy("side.text_hash")
        .agg(F.min(F.struct("side.doc_id")).alias("doc"))
    )
    wanted = membership_filter(named, "text_hash", sized=True)
    words = written(
        texts.mapInArrow(
            lambda batches: _word_rows(batches, wanted.value), "text_hash bigint, words array<int>"
        )
        .join(named, "text_hash")
        .dropDuplicates(["text_hash"])
        .select("text_hash", "doc.doc_id", "words")
    )
    discard(named)

    def part(rows: DataFrame, hash_col: str, ends: str, to: str, shift: str) -> DataFrame:
        """The words of one side of each chain, and some on either end of it."""
        source = words.select(F.col("text_hash").alias("__hash"), F.col("words").alias("whole"))
        margin = 4 * least_words
        low = F.greatest(F.element_at(ends, 1) - margin, F.lit(0))
        high = F.element_at(ends, -1) + seed + margin
        # Both sides read ``source`` under the same names, so that it is shuffled once.
        return (
            rows.join(source, rows[hash_col] == source["__hash"])
            .withColumn(shift, low)
            .withColumn(to, F.slice("whole", low + 1, high - low))
            .drop("whole", "__hash")
        )

    both = part(part(found, "text_hash", "xs", "words", "from"), "text_hash0", "ys", "words0", "from0")
    aligned = written(
        both.mapInArrow(
            lambda batches: _aligned(batches, seed, least_words, least_identity),
            f"doc_id {id_type}, text_hash bigint, doc_id0 {id_type}, text_hash0 bigint, "
            "start int, end int, start0 int, end0 int, identity double",
        )
    )
    discard(found)
    return aligned.unionByName(_exact_rest(aligned, opened, words, id_type, least_words))


def _exact_rest(
    aligned: DataFrame, opened: DataFrame, words: DataFrame, id_type: str, least_words: int
) -> DataFrame:
    """Exact repetitions of open windows that lie in no aligned passage."""
    key, key0 = ["doc_id", "text_hash"], ["doc_id0", "text_hash0"]
    window = f"doc_id {id_type}, text_hash bigint, gram bigint, place int"
    covers = aligned.groupBy(*key).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    rest = left_join_null_safe(opened, covers, *key).mapInArrow(
        lambda batches: _uncovered(batches, least_words), f"doc_id {id_type}, text_hash bigint, places array<int>"
    )
    rest = written(rest)
    wanted = membership_filter(rest, "text_hash", sized=True)
    named = words.select("text_hash", "words").mapInArrow(
        lambda batches: _held(batches, wanted.value), "text_hash bigint, words array<int>"
    )
    late = written(
        rest.join(named, "text_hash")
        .select(*key, "places", "words")
        .mapInArrow(lambda batches: _late_windows(batches, least_words), window)
    )
    known = membership_filter(late, "gram", sized=True)
    # Written before the join, so that a window in very many texts can be split there.
    firsts = written(
        words.mapInArrow(lambda batches: _all_windows(batches, known.value, least_words), window)
        .groupBy("gram")
        .agg(F.min(F.struct(*key, "place")).alias("first"))
    )
    again = (
        late.join(firsts, "gram")
        .filter(F.col("first") < F.struct(*key, "place"))
        .select(
            *key,
            F.col("first.doc_id").alias("doc_id0"),
            F.col("first.text_hash").alias("text_hash0"),
            "place",
            (F.col("first.place") - F.col("place")).alias("shift"),
        )
    )
    along = Window.partitionBy(*key, *key0, "shift").orderBy("place")
    first, end = F.min("place"), F.max("place") + least_words
    return (
        again.withColumn("run", F.col("place") - F.row_number().over(along))
        .groupBy(*key, *key0, "shift", "run")
        .agg(first.alias("start"), end.alias("end"))
        .select(
            *key,
            *key0,
            "start",
            "end",
            (F.col("start") + F.col("shift")).alias("start0"),
            (F.col("end") + F.col("shift")).alias("end0"),
            F.lit(1.0).alias("identity"),
        )
    )
