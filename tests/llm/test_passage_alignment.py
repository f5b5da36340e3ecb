"""Alignment of many chains at once against each by itself, and gaps against brute force."""

from __future__ import annotations

import numpy as np

from lakemarts.llm.passages import _gap_matches, _Sides, align, alignments


def common_words(a: list[int], b: list[int]) -> int:
    row = [0] * (len(b) + 1)
    for word in a:
        before, row = row, [0]
        for j, other in enumerate(b):
            row.append(max(before[j] + (word == other), before[j + 1], row[j]))
    return row[-1]


def lists(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(values), np.append(0, np.cumsum([len(value) for value in values]))


def test_gaps_by_brute_force():
    rng = np.random.default_rng(2)
    one = [rng.integers(0, 4, rng.integers(0, 30)).astype(np.int32) for _ in range(200)]
    other = [rng.integers(0, 4, rng.integers(0, 30)).astype(np.int32) for _ in range(200)]
    (a, bounds), (b, bounds0) = lists(one), lists(other)
    steps = np.ones(200, np.int64)
    found = _gap_matches(_Sides(a, bounds[:-1], np.diff(bounds), b, bounds0[:-1], np.diff(bounds0), steps))
    for x, y, kept in zip(one, other, found.tolist()):
        plain = int((x == y).sum()) if len(x) == len(y) else 0
        assert kept == (plain if plain and plain * 2 >= len(x) else common_words(x.tolist(), y.tolist()))


def test_many_alignments_are_those_of_each():
    rng = np.random.default_rng(5)
    chains = []
    for _ in range(300):
        a = rng.integers(0, 60, rng.integers(20, 300)).astype(np.int32)
        kept = rng.random(len(a)) > 0.04
        b = np.where(rng.random(len(a)) > 0.06, a, -1)[kept].astype(np.int32)
        n = rng.integers(1, 5)
        xs, ys = (np.sort(rng.choice(len(side) - 5, n, replace=False)) for side in (a, b))
        chains.append((a, b, xs, ys))
    one, other, xs, ys = zip(*chains)
    (a, bounds), (b, bounds0), (x, ties), (y, _) = lists(one), lists(other), lists(xs), lists(ys)
    found = list(zip(*(values.tolist() for values in alignments(a, bounds, b, bounds0, x, y, ties))))
    assert found == [align(*chain) for chain in chains]
    assert all(len(values) == 0 for values in alignments(a, bounds[:1], b, bounds0[:1], x[:0], y[:0], ties[:1]))
