"""Whole Arrow batches of texts as numpy arrays: words, hashes, grams, minimizers.

A word is a maximal run of ASCII letters and digits and of any character beyond
ASCII, with A-Z lowered. Every such character is one or more whole UTF-8 bytes,
so words are found on bytes, for all texts of a slice at once, without a Python
loop over documents or words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are taken together up to this many bytes; a longer text is one slice. A task holds
#: some hundred bytes for each of them.
SLICE_BYTES = 1 << 19

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Values of the bytes for two hashes that are independent of each other.
_BYTE_VALUES = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_OTHER_VALUES = np.random.default_rng(8).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        inverse = pow(_BASE, -1, 2**64)

        def table(base: int) -> np.ndarray:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        _powers = table(_BASE), table(inverse)
    return _powers[0][:n], _powers[1]


def run_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False
) -> np.ndarray:
    """64-bit hash of each byte run, equal for equal bytes wherever they stand.

    With ``other`` a second one, so that both together have 128 bits.
    """
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = _OTHER_VALUES if other else _BYTE_VALUES
    np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """The words of some consecutive rows."""

    first_row: int
    data: np.ndarray  # lowered bytes of the rows
    offsets: np.ndarray  # of each row in data
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    word_offsets: np.ndarray  # of each row among the words
    inside: np.ndarray  # which bytes of data belong to words

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def words_left(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return np.repeat(self.word_offsets[1:], self.counts) - np.arange(len(self.starts))

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words only, and the word of each number."""
        offsets = np.append(0, np.cumsum(self.ends - self.starts))
        values = pa.LargeStringArray.from_buffers(
            len(self.starts), pa.py_buffer(offsets), pa.py_buffer(self.data[self.inside])
        ).dictionary_encode()
        return values.indices.to_numpy().astype(np.int64), values.dictionary

    def text(self, first: int, n: int) -> str:
        """``n`` words from word ``first`` on, with single spaces."""
        raw = self.data.data
        return b" ".join(
            raw[a:b] for a, b in zip(self.starts[first : first + n], self.ends[first : first + n])
        ).decode("utf-8")


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``most`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def words_of(column: pa.Array, word_bytes: np.ndarray = WORD_BYTES) -> Iterator[Words]:
    """Slices of the column, each with the words of its texts.

    A word is a maximal run of the bytes that ``word_bytes`` marks.
    """
    raw, offsets = text_bytes(column)
    for first, last in row_slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        data = LOWER[raw[offsets[first] : offsets[last]]]
        inside = word_bytes[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        full = own[1:] > own[:-1]
        at = own[:-1][full]
        begins[at] = inside[at]
        at = own[1:][full] - 1
        stops[at] = inside[at]
        starts = np.flatnonzero(begins)
        yield Words(
            first, data, own, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, own), inside
        )


#: Grams of more words are hashed by running sums.
SHORT_GRAM = 10


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on; the last ``n - 1`` mean nothing."""
    total = np.zeros(len(hashes), np.uint64)
    if n > SHORT_GRAM and len(hashes) >= n:
        # The same sums, as differences of running ones.
        powers, inverses = _power_tables(len(hashes) + 2)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers[1:-1], out=sums[1:])
        whole = len(hashes) - n + 1
        total[:whole] = (sums[n:] - sums[:whole]) * inverses[:whole]
        return mix(total + np.uint64(n))
    for i in range(min(n, len(hashes))):
        factor = np.uint64(pow(_BASE, i + 1, 2**64))
        total[: len(hashes) - i] += hashes[i:] * factor
    return mix(total + np.uint64(n))


def minimizers(grams: np.ndarray, grams_left: np.ndarray, window: int) -> np.ndarray:
    """Which grams are the least of some window of consecutive grams of one row.

    Ties all count, so the choice depends on the text of the window alone, and two
    rows that share a window share the gram chosen in it.
    """
    least = sliding(np.minimum, grams, window)
    # A gram is the least of some window if the greatest of their least ones is no less.
    full = grams_left >= window
    least[~full] = 0
    inside = sliding(np.maximum, full[::-1], window)[::-1]
    return inside & (sliding(np.maximum, least[::-1], window)[::-1] == grams)


def sliding(pick: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of up to ``window`` values from each on, along the last axis."""
    out, width = values.copy(), 1
    while width < window:
        # Of twice as many values, or the last ones so far that are needed.
        step = min(width, window - width)
        longer = out.copy()
        pick(out[..., :-step], out[..., step:], out=longer[..., :-step])
        out, width = longer, width + step
    return out


#: Rows that :func:`added_rows` holds before it adds up equal ones.
HELD_ROWS = 1 << 20


def added_rows(
    batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]
) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys added up, as far as a bounded number of rows reaches."""

    def added(rows: list[pa.RecordBatch]) -> pa.Table:
        sums = pa.Table.from_batches(rows).group_by(keys).aggregate([(name, "sum") for name in values])
        return sums.rename_columns([*keys, *values])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(part.num_rows for part in held) > HELD_ROWS:
            rows = added(held)
            held = rows.to_batches()
            # Where few keys repeat, holding them on does not pay.
            if rows.num_rows > HELD_ROWS // 2:
                yield from held
                held = []
    if held:
        yield from added(held).to_batches()


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """``values`` cut into consecutive lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
