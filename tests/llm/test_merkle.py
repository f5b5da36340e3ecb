"""The Merkle manifest against a plain recursive one."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lakemarts.llm.merkle import manifest, tampered

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def plain_hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    return plain_hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def plain_levels(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([plain_hash("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def plain_path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    sides = []
    for level in levels[:-1]:
        first = at - at % 3
        run = level[first : first + 3]
        sides.append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        at //= 3
    return sides


def plain_manifest(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    ordered = {
        name: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for name, own in groups.items()
    }
    trees = {name: plain_levels([plain_leaf(row) for row in own]) for name, own in ordered.items()}
    top = plain_levels([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for at, row in enumerate(ordered[name]):
            sides = plain_path(trees[name], at) + plain_path(top, place)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = plain_leaf((*row[:4], text))
            for left, right in sides:
                node = plain_hash(left + node + right)
            found.append(
                (row[0], plain_leaf(row), trees[name][-1][0], top[-1][0], "".join(a + b for a, b in sides), node, node == top[-1][0])
            )
    return found


def check(spark, rows):
    docs = spark.createDataFrame(rows, COLUMNS + ", key string, digest string")
    found = manifest(docs, changed={"text": tampered(F.col("doc_id"), F.col("text"))})
    names = ["doc_id", "leaf", "subroot", "root", "siblings", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, found.select(names).collect()))) == sorted(map(repr, plain_manifest(rows)))


def row(i, source, text="a\nb"):
    return (i, source, "en", 3, text, "k", "d")


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2, 3, 4], [81, 82, 243, 244, 1], [900, 27], [1] * 100])
def test_trees_of_many_sizes(spark, sizes):
    rows = [row(10_000 * g + i, f"s{g}", f"text {i}\n{g}") for g, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    check(spark, rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [row(None, None), row(None, "", "x"), row(5, None, None), (6, "é", None, None, "漢\n", None, None)]
    rows += [row(7, "=", "")] * 5 + [row(7, "=", "other")] * 3 + [row(8, "\U0001f600"), row(9, "￿")]
    rows.append(row(10, "=", "x\n" * 1_000_000))
    check(spark, rows)


def test_no_rows(spark):
    assert manifest(spark.createDataFrame([], COLUMNS)).count() == 0


def test_few_levels_are_stored(spark):
    """Four levels of 900 leaves are regenerated; a stored table follows for the rest."""
    from lakemarts.llm.merkle import positioned, stored_tree

    digest = F.sha2(F.col("id").cast("string"), 256).alias("digest")
    leaves = spark.range(900).select(F.lit("=a").alias("key"), "id", digest)
    stored = stored_tree(positioned(leaves, ["id"]), ["id"])
    assert [table.select(F.explode("nodes")).count() for table in stored] == [900, 12]
