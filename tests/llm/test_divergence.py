"""The divergence audit against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemarts.llm import divergence
from lakemarts.llm.divergence import share, shares, source_divergence, term_counts

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id bigint, text string, lang string, source string"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, least: int = 3, top: int = 200) -> list[tuple]:
    langs: dict = {}
    for _, text, lang, source in rows:
        langs.setdefault(lang or "", []).append((source or "", terms_of(text)))
    found = []
    for lang, docs in langs.items():
        in_docs = Counter(term for _, terms in docs for term in set(terms))
        kept = [term for term, n in in_docs.items() if n >= least]
        counts = {source: Counter() for source, _ in docs}
        for source, terms in docs:
            counts[source].update(term for term in terms if in_docs[term] >= least)
        whole = sum(counts.values(), Counter())

        def p(count: Counter, kept=kept) -> dict:
            total = sum(count.values()) + len(kept)
            return {term: 1 + 10**9 * (count[term] + 1) // total for term in kept}

        q_lang, of_source = p(whole), {source: p(count) for source, count in counts.items()}
        for source, own in of_source.items():
            pairs = [
                (sum((own[t] - q[t]) ** 2 // q[t] for t in kept), other) for other, q in of_source.items() if other != source
            ]
            terms = [((own[t] - q_lang[t]) ** 2 // q_lang[t], t) for t in counts[source] if own[t] > q_lang[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                ordered = sorted(values, key=lambda v: (-v[0], v[1].encode()))
                ordered = ordered if part == "pair" else ordered[:top]
                found += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(found)


def random_rows(n: int, seed: int = 1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé漢Z") for _ in range(rng.randint(1, 20))) for _ in range(60)]
    words += ["prefix" * k + "x" for k in range(1, 9)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["s1", "s1", "s2", "s3", "", None, "é"])
        rows.append((i // 2, " ".join(rng.choice(words[: 20 + 8 * (i % 7)]) for _ in range(rng.randint(0, 30))), lang, source))
    return rows


@pytest.mark.parametrize("first_prefix", [1, 4])
def test_by_brute_force(spark, monkeypatch, first_prefix):
    rows = random_rows(150)
    rows += [(900, None, "en", "s9"), (901, "", "fr", "s1"), (902, "rare words", "fr", "s2"), (None, "1 2 3", None, None)]
    rows += [rows[3]] * 4 + [(903, "word " * 50_000 + "long" * 100_000, "en", source) for source in ("s1", "s2", "s3")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", term string, value int")
    found = source_divergence(docs, first_prefix=first_prefix)
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_blocks_and_parts_change_nothing(spark, monkeypatch):
    rows = random_rows(120, seed=2)
    docs = spark.createDataFrame(rows, COLUMNS)
    monkeypatch.setattr(divergence, "BLOCK_PAIRS", 9)
    found = source_divergence(docs, block_counts=7, least_documents=2, top_terms=5)
    assert sorted(map(tuple, found.collect())) == plain(rows, least=2, top=5)


def test_refinement_drops_what_is_rare(spark):
    rows = [(i, f"shared{'x' * 30} rare{i:03d}" .replace("0", "q").replace("1", "w"), "en", "s") for i in range(3)]
    kept = term_counts(spark.createDataFrame(rows, COLUMNS)).collect()
    assert [(r["term"], r["occurrences"]) for r in kept if r["term"].startswith("shared")] == [("shared" + "x" * 30, 3)]


def test_no_rows(spark):
    assert source_divergence(spark.createDataFrame([], COLUMNS)).count() == 0


def test_shares_are_exact_beyond_64_bit_products(spark):
    counts = [0, 1, 10**12, 8 * 10**15 - 1, 123456789012]
    totals = [1, 3, 8 * 10**15, 8 * 10**15, 987654321987]
    want = [1 + 10**9 * (c + 1) // t for c, t in zip(counts, totals)]
    assert shares(np.array(counts), np.array(totals)).tolist() == want
    frame = spark.createDataFrame(list(zip(counts, totals)), "c bigint, t bigint")
    assert [r[0] for r in frame.select(share(F.col("c"), F.col("t"))).collect()] == want
