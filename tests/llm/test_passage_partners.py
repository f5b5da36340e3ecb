"""Exact passages whose parts all stood in earlier documents that lack the passage."""

from __future__ import annotations

import random

from lakemarts.llm.passages import LEAST_WORDS, repeated_passages

DOC = "doc_id bigint, text string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def passages(spark, rows: list[tuple[int | None, list[str]]], **options) -> list:
    docs = spark.createDataFrame([(doc_id, " ".join(text)) for doc_id, text in rows], DOC)
    return repeated_passages(docs, **options).collect()


def missed(rows: list[tuple[int | None, list[str]]], found: list, size: int = LEAST_WORDS) -> list[tuple[int | None, int]]:
    """Windows that occurred before, in the order of doc_id and place, but lie in no passage found."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda row: -1 if row[0] is None else row[0]):
        spans = [(row["start"], row["end"]) for row in found if row["doc_id"] == doc_id]
        for p in range(len(text) - size + 1):
            window = tuple(text[p : p + size])
            if window in seen and not any(start <= p and p + size <= end for start, end in spans):
                out.append((doc_id, p))
            seen.add(window)
    return out


def test_overlapping_parts_stood_before(spark):
    """Each 32 words of a passage are in an earlier document, 50 of them in none but one."""
    rng = random.Random(11)
    rows, want = [], {}
    for case, (size, own) in enumerate([(60, 46), (50, 49), (90, 49), (70, 45)] * 3):
        passage, base = words(rng, size), 100 * case
        parts = [passage[at : at + own] for at in range(0, size - 31, 8)]
        rows += [(base + i, words(rng, 20) + part + words(rng, 20)) for i, part in enumerate(parts)]
        rows += [(base + i, words(rng, 9) + passage + words(rng, 30)) for i in (50, 51, 52)]
        want |= {base + i: (9, 9 + size, base + 50, 9, 1.0) for i in (51, 52)}
    found = passages(spark, rows)
    exact = {
        row["doc_id"]: (row["start"], row["end"], row["doc_id0"], row["start0"], row["identity"]) for row in found
    }
    assert exact == want and not missed(rows, found)


def test_every_repeated_window_by_brute_force(spark):
    """Texts patched together from shared pieces of all lengths, copies and a null doc_id among them."""
    rng = random.Random(12)
    pool = words(rng, 600)
    rows = []
    for i in range(150):
        text = words(rng, rng.randrange(5))
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(pool))
            text += pool[at : at + rng.randrange(20, 90)] + words(rng, rng.randrange(3))
        rows.append((None if i == 0 else 3 * i, text))
    rows += [(3 * i + 1, rows[i][1]) for i in range(1, 150, 7)]
    rows += [(1000, rows[5][1] + rows[5][1]), (1001, pool + words(rng, 40) + pool[100:300])]
    found = passages(spark, rows)
    assert not missed(rows, found)
    texts = dict(rows)
    for row in found:
        one = texts[row["doc_id"]][row["start"] : row["end"]]
        other = texts[row["doc_id0"]][row["start0"] : row["end0"]]
        assert len(one) >= LEAST_WORDS and (row["identity"] < 1.0 or one == other)
    small = passages(spark, rows[:40], least_words=20)
    assert not missed(rows[:40], small, 20)
