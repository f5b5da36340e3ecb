"""Words, hashes and minimizers of whole batches against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemarts.llm import arrays

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str | None) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


texts = st.lists(
    st.none() | st.text(st.sampled_from("aAzZ09 .-\né漢\x7f"), max_size=30) | st.text(max_size=20),
    max_size=8,
)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(batch):
    found = []
    for words in arrays.words_of(pa.array(batch, pa.string())):
        for row in range(words.rows):
            first, last = words.word_offsets[row], words.word_offsets[row + 1]
            found.append([words.text(i, 1) for i in range(first, last)])
    assert found == [plain_words(text) for text in batch]


def test_a_sliced_column_and_small_slices(monkeypatch):
    column = pa.array(["x", "one two", None, "", "three"]).slice(1)
    whole = [words.counts.tolist() for words in arrays.words_of(column)]
    assert whole == [[2, 0, 0, 1]]
    parts = list(arrays.row_slices(np.array([0, 5, 5, 9, 30]), 6))
    assert parts == [(0, 2), (2, 3), (3, 4)]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    (words,) = arrays.words_of(pa.array(["a bb a", "xx bb", "bb"]))
    h = words.hashes()
    assert h[0] == h[2] and h[1] == h[4] == h[5] and len(set(h.tolist())) == 3


def test_shared_windows_share_a_minimizer():
    random = np.random.default_rng(1)
    shared = random.integers(0, 2**63, 30).astype(np.uint64)
    for _ in range(20):
        chosen = []
        for _ in range(2):
            around = [random.integers(0, 2**63, 25).astype(np.uint64) for _ in range(2)]
            h = np.concatenate([around[0], shared, around[1]])
            left = len(h) - np.arange(len(h))
            at = np.flatnonzero(arrays.minimizers(h, left, 10))
            chosen.append({int(v) for v in h[at[(at >= 25) & (at < 55)]]})
        assert chosen[0] & chosen[1]


def test_rows_shorter_than_a_window_have_no_minimizer():
    h = np.arange(5, dtype=np.uint64)
    assert not arrays.minimizers(h, np.array([2, 1, 3, 2, 1]), 4).any()
    assert not arrays.minimizers(h[:0], np.zeros(0, int), 4).any()
