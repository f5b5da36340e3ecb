"""Line, document, vector and passage deduplication on small tables, by brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemarts.llm import near_dedup
from lakemarts.llm.components import connected_components
from lakemarts.llm.embedding_dedup import band_shape, near_vectors
from lakemarts.llm.line_dedup import repeated_runs, without_repeated_lines
from lakemarts.llm.near_dedup import dart_signatures, near_duplicates, without_near_duplicates
from lakemarts.llm.passages import align, chains, repeated_passages
from tests.llm.test_words import plain_words

DOC = "doc_id bigint, text string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (7, 7), (1, 2), (2, 1)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    rows = {row["node"]: row["component"] for row in found.collect()}
    assert rows == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys((100, 101, 102), 100)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_lines(spark):
    docs = spark.createDataFrame(
        [
            (1, "a\nb\n\nc\nd", "x"),
            (2, "q\na\nb\nc\nz", "y"),  # a b c again, over a blank line
            (3, "a\nb", "y"),  # shorter than a run, equal to nothing
            (4, "only", None),
            (5, "only", None),
            (6, None, None),
            (7, "", None),
            (8, "r\nr\nr\nr\nr", None),  # overlaps itself
            (None, "n1\nn2\nn3", None),
            (9, "n1\nn2\nn3", None),
        ],
        "doc_id bigint, text string, cuts string",
    )
    left = {row["doc_id"]: row["text"] for row in without_repeated_lines(docs).collect()}
    assert left == {
        1: "a\nb\n\nc\nd", 2: "q\nz", 3: "a\nb", 4: "only", 5: "", 6: None, 7: "",
        8: "r\nr\nr", None: "n1\nn2\nn3", 9: "",
    }
    dropped = without_repeated_lines(docs, drop_emptied=True)
    assert dropped.columns == docs.columns and dropped.count() == 8
    counts = {row["doc_id"]: row["n_removed"] for row in repeated_runs(docs).collect()}
    assert counts[2] == 3 and counts[8] == 2 and counts[6] == 0
    assert without_repeated_lines(docs.limit(0)).count() == 0


def test_runs_of_lines_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 9)))) for i in range(60)]
    seen, want = {}, {}
    for i, text in rows:
        lines = [line for line in text.split("\n") if line.strip()]
        gone = set()
        size = min(3, len(lines))
        for p in range(len(lines) - size + 1 if lines else 0):
            content = (size < 3 and len(lines), tuple(lines[p : p + size]))
            if content in seen:
                i0, p0 = seen[content]
                gone.update(range(max(p, p0 + size) if i0 == i else p, p + size))
            else:
                seen[content] = (i, p)
        want[i] = len(gone)
    found = repeated_runs(spark.createDataFrame(rows, DOC)).collect()
    assert {row["doc_id"]: row["n_removed"] for row in found} == want


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(5)
    units = rng.integers(0, 2**63, 1200).astype(np.uint64)
    row = np.repeat([0, 1], 800)
    signature = dart_signatures(row, np.concatenate([units[:800], units[400:]]), 3, 4000)
    agree = (signature[0] == signature[1]).mean()
    assert abs(agree - 400 / 1200) < 0.04
    assert not signature[2].any()
    tiny = dart_signatures(np.array([0]), units[:1], 1, 300)
    assert len(set(tiny[0].tolist())) == 300


def brute_components(rows, similarity=0.8):
    sets = []
    for _, text in rows:
        w = plain_words(text)
        sets.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = sum((sets[a] & sets[b]).values())
            total = sum((sets[a] | sets[b]).values())
            if (rows[a][1] or "") == (rows[b][1] or "") or total and common / total >= similarity:
                parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: least[root(i)] for i, (doc_id, _) in enumerate(rows)}


def near_rows():
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (3, "..."), (4, "!!!"), (5, "one two"), (6, "One, two!")]
    for group in range(4):
        base = sentence(rng, 90).split()
        for copy in range(12):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = sentence(rng, 1)
            rows.append((100 * group + copy + 10, " ".join(words)))
    return rows


@pytest.mark.parametrize("hub_rounds", [0, 3])
def test_near_duplicates_by_brute_force(spark, monkeypatch, hub_rounds):
    """Hub rounds or not, and in small blocks, the components are the same."""
    rows = near_rows()
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    real = near_dedup.near_links
    monkeypatch.setattr(near_dedup, "near_links", lambda t, **k: real(t, **k, hub_rounds=hub_rounds))
    found = near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == brute_components(rows)


def test_one_document_of_each_group_stays(spark):
    long = sentence(random.Random(1), 300)
    rows = [(2, long, "a"), (1, long + " end", "b"), (3, "else", "c"), (3, "else", "c"), (None, "else", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, uid string")
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((row["doc_id"] or 0, row["uid"]) for row in kept.collect()) == [(0, "d"), (1, "b"), (3, "c")]
    assert without_near_duplicates(docs.limit(0)).count() == 0


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(150):
        v = rng.standard_normal(16)
        rows.append((i, v.tolist(), i % 3))
        for _ in range(rng.integers(0, 3)):
            noise = rng.standard_normal(16) * rng.choice([0, 0.2, 0.35, 0.5])
            rows.append((len(rows) + 1000, (v + noise).tolist(), i % 3))
    rows += [
        (5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, rows[0][1], None),
        (5004, [1.0, 2.0], 1), (5005, [2.0, 4.0], 1), (5006, [], 1), (5007, [1.0, None], 1),
        (5008, [1e-200, 2e-200], 1), (5009, [1e200, 2e200], 1),
    ]
    want = {}
    vectors = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v) / np.abs(v).max()
            vectors[i] = (label, u / np.linalg.norm(u))
    links = defaultdict(set)
    for a in vectors:
        for b in vectors:
            la, x = vectors[a]
            lb, y = vectors[b]
            if a != b and la == lb and len(x) == len(y) and x @ y >= 0.93:
                links[a].add(b)
    for i, _, _ in rows:
        group, todo = {i}, [i]
        while todo:
            for other in links[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        want[i] = (len(links[i]), min(group))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = near_vectors(frame).collect()
    assert {row["vec_id"]: (row["n_links"], row["component_id"]) for row in found} == want
    assert all(row["kept"] == (row["vec_id"] == row["component_id"]) for row in found)
    assert near_vectors(frame.limit(0)).count() == 0
    assert sum(n for n, _ in want.values()) > 50


def test_bands_grow_with_the_label():
    assert band_shape(10)[0] < band_shape(10**6)[0] <= 30
    bits, bands = band_shape(5000)
    assert (1 - 0.8802**bits) ** bands < 2e-6


def test_chains_run_forward_on_both_sides():
    assert chains([0, 10, 20], [5, 15, 25]) == [[0, 1, 2]]
    assert sorted(map(sorted, chains([0, 10, 20], [25, 15, 5]))) == [[0], [1], [2]]
    assert sorted(map(sorted, chains([0, 500], [0, 500]))) == [[0], [1]]


def test_alignment_counts_edits():
    a = np.arange(100)
    b = np.concatenate([np.arange(40), [900, 901], np.arange(40, 100)])
    start, end, start0, end0, agree = align(a, b, np.array([10, 60]), np.array([10, 62]))
    assert (start, end, start0, end0, agree) == (0, 100, 0, 102, 100)


def test_passages(spark):
    rng = random.Random(8)
    passage = sentence(rng, 80)
    edited = passage.split()
    edited[30] = "changed"
    del edited[55]
    rows = [
        (1, sentence(rng, 60) + " " + passage + " " + sentence(rng, 60)),
        (2, sentence(rng, 10) + " " + passage.upper()),
        (3, " ".join(edited) + " " + sentence(rng, 90)),
        (4, sentence(rng, 200)),
        (5, " ".join(passage.split()[:30]) + " " + sentence(rng, 100)),  # too short
        (6, None), (7, ""), (8, "same " * 400),
    ]
    found = {row["doc_id"]: row for row in repeated_passages(spark.createDataFrame(rows, DOC)).collect()}
    assert set(found) == {2, 3, 8}
    assert (found[2]["start"], found[2]["end"], found[2]["doc_id0"], found[2]["start0"]) == (10, 90, 1, 60)
    assert (found[3]["start"], found[3]["end"]) == (0, 79) and found[3]["identity"] > 0.95
    assert found[8]["doc_id0"] == 8
    assert repeated_passages(spark.createDataFrame([], DOC)).count() == 0


def test_passages_whose_parts_stood_elsewhere(spark):
    """The parts of a passage are in earlier documents, the whole in one later than those."""
    rng = random.Random(10)
    rows, want = [], {}
    for case, parts in enumerate([(30, 30), (40, 40), (30, 30, 30), (25, 25), (45, 20)] * 4):
        pieces = [sentence(rng, n) for n in parts]
        base = 100 * case
        rows += [(base + i, f"{sentence(rng, 40)} {piece} {sentence(rng, 40)}") for i, piece in enumerate(pieces)]
        rows += [(base + i, f"{sentence(rng, 15)} {' '.join(pieces)} {sentence(rng, 25)}") for i in (50, 51)]
        want[base + 51] = (15, 15 + sum(parts), base + 50)
    found = repeated_passages(spark.createDataFrame(rows, DOC)).collect()
    assert {row["doc_id"]: (row["start"], row["end"], row["doc_id0"]) for row in found} == want
