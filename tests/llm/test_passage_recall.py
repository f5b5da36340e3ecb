"""Edited passages against brute-force local alignment."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lakemarts.llm.passages import LEAST_IDENTITY, LEAST_WORDS, repeated_passages

DOC = "doc_id bigint, text string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def edited(rng: random.Random, passage: list[str], identity: float, replaced_only: bool) -> list[str]:
    out = [[word] for word in passage]
    for place in rng.sample(range(len(passage)), round(len(passage) * (1 - identity))):
        kind = 0 if replaced_only else rng.randrange(3)
        out[place] = [words(rng, 1), [passage[place], *words(rng, 1)], []][kind]
    return [word for part in out for word in part]


def best_alignment(a: list[str], b: list[str]) -> tuple[int, float]:
    """Words and identity of the best local alignment: 1 for a word that agrees, -2 for others."""
    numbers: dict[str, int] = {}
    x, y = (np.array([numbers.setdefault(w, len(numbers)) for w in side]) for side in (a, b))
    score = np.zeros((len(x) + 1, len(y) + 1), int)
    ramp = 2 * np.arange(len(y) + 1)
    for i, word in enumerate(x):
        row = np.maximum(score[i] - 2, 0)
        row[1:] = np.maximum(row[1:], score[i, :-1] + np.where(y == word, 1, -2))
        score[i + 1] = np.maximum.accumulate(row + ramp) - ramp
    i, j = map(int, np.unravel_index(score.argmax(), score.shape))
    end, end0, agree = i, j, 0
    while score[i, j] > 0:
        if i and j and score[i, j] == score[i - 1, j - 1] + (1 if x[i - 1] == y[j - 1] else -2):
            agree += int(x[i - 1] == y[j - 1])
            i, j = i - 1, j - 1
        elif i and score[i, j] == score[i - 1, j] - 2:
            i -= 1
        else:
            j -= 1
    return end - i, agree / max(end - i, end0 - j, 1)


def planted(spark, lengths, identities, replaced_only: bool, each: int, seed: int = 3):
    """(length, identity, qualifies by brute force, found) of planted passages."""
    rng = random.Random(seed)
    rows, cases = [], []
    for length in lengths:
        for identity in identities:
            for _ in range(each):
                passage = words(rng, length)
                one = words(rng, 40) + passage + words(rng, 40)
                other = words(rng, 30) + edited(rng, passage, identity, replaced_only) + words(rng, 50)
                rows += [(len(rows), " ".join(one)), (len(rows) + 1, " ".join(other))]
                size, share = best_alignment(other, one)
                cases.append((length, identity, size >= LEAST_WORDS and share >= LEAST_IDENTITY, len(rows) - 1))
    found = {row["doc_id"] for row in repeated_passages(spark.createDataFrame(rows, DOC)).collect()}
    assert found <= {doc_id for *_, doc_id in cases}
    return [(length, identity, due, doc_id in found) for length, identity, due, doc_id in cases]


@pytest.mark.parametrize("replaced_only", [True, False])
def test_edited_passages_are_found(spark, replaced_only):
    cases = planted(spark, [50, 60, 80, 120], [0.8, 0.85, 0.9, 0.95], replaced_only, 25)
    for identity in (0.8, 0.85, 0.9, 0.95):
        due = [found for _, one, due, found in cases if due and one == identity]
        assert len(due) >= 30 and np.mean(due) >= 0.9, (identity, np.mean(due))


def test_alignment_by_hand():
    assert best_alignment(list("abcdefgh"), list("xxabcdefghyy")) == (8, 1.0)
    size, share = best_alignment(list("abcdXfghij"), list("abcdYfghij"))
    assert (size, share) == (10, 0.9)
