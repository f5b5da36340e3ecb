"""The language model against exact counts."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from lakemarts.llm.arrays import words_of
from lakemarts.llm.language_model import (
    BEGIN,
    BITS_PER_ENTRY,
    END,
    TOKEN_BYTES,
    Weights,
    _asked,
    _rare_rows,
    _scored,
    score_texts,
    tokens_of,
    train_language_model,
)
from lakemarts.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA_DIR = "/root/testdata/sf0.001"


def plain_tokens(text: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [END]


def plain_base(train, texts):
    counts = Counter(t for text in train for t in plain_tokens(text))
    total, scale = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    return [
        (len(own := plain_tokens(text)), sum(t in counts for t in own), sum(math.log10(counts[t] + 1) - scale for t in own))
        for text in texts
    ], total


def plain_score(train, text, mu, order):
    """The same model with exact counts."""
    counts: Counter = Counter()
    for one in train:
        tokens = [BEGIN, *plain_tokens(one)]
        for n in range(1, order + 1):
            counts.update(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
    words = {gram[0] for gram in counts if len(gram) == 1} - {BEGIN}
    total = sum(counts[(word,)] for word in words)
    tokens, log = [BEGIN, *plain_tokens(text)], 0.0
    for i in range(1, len(tokens)):
        p = (counts[(tokens[i],)] + 1) / (total + len(words) + 1)
        for n in range(2, order + 1):
            if i - n + 1 < 0:
                break
            gram = tuple(tokens[i - n + 1 : i + 1])
            if counts[gram[:-1]]:
                p = (counts[gram] + mu[n] * p) / (counts[gram[:-1]] + mu[n])
        log += math.log10(p)
    return log


def random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abAé漢1.,") for _ in range(rng.randint(1, 4))) for _ in range(200)]
    # Every word is followed by few others.
    return ["".join(words[(start := rng.randrange(50)) + rng.choice([0, 50, 51]) + k % 3] + rng.choice([" ", "\n", "\x0b "]) for k in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize(("order", "heavy_bits"), [(2, 18), (3, 4)])
def test_scores_by_brute_force(spark, order, heavy_bits):
    train, texts = random_texts(300, 1), [*random_texts(60, 2), None, "", "unknown words\there", "  x", "a " * 200_000]
    schema = "doc_id bigint, text string, token string, score string, row int"
    frame = spark.createDataFrame([(i // 2, t, "x", "y", 1) for i, t in enumerate(train)], schema)
    model = train_language_model(frame.select("text"), order=order, heavy_bits=heavy_bits)
    found = score_texts(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(texts)], schema), model).collect()
    base, total = plain_base(train, texts)
    assert model.tokens == total and len(found) == len(texts)
    for row in found:
        n, known, score = base[row["doc_id"]]
        assert (row["n_tokens"], row["n_known"]) == (n, known)
        assert row["base_score"] == pytest.approx(score, rel=1e-9)
    # Quantised counts: close to the model with exact ones.
    exact = [plain_score(train, text, model.filter.mu, order) for text in texts]
    got = {row["doc_id"]: row["score"] for row in found}
    assert all(got[i] <= 0 for i in got)
    assert sum(abs(got[i] - e) for i, e in enumerate(exact)) <= 0.05 * abs(sum(exact))


def test_levels_are_never_too_low_and_seldom_too_high(spark):
    train = random_texts(500, 3)
    model = train_language_model(spark.createDataFrame([(t,) for t in train], "text string")).filter
    counts: Counter = Counter()
    for words in words_of(pa.array(train), TOKEN_BYTES):
        counts.update(tokens_of(words).grams(2).tolist())
    grams = np.array(list(counts), np.uint64)
    true = np.floor(np.log2(np.array(list(counts.values())))).astype(int) + 1
    levels = model.levels(grams)
    assert (levels >= true).all() and (levels > true).mean() < 0.02
    absent = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    assert (model.levels(absent) > 0).mean() < 0.02


def test_the_filter_has_a_bound(spark):
    """With a bound below the corpus only n-grams of a large enough share are held."""
    train = random_texts(500, 4)
    texts = spark.createDataFrame([(t,) for t in train], "text string")
    whole, small = (train_language_model(texts, share_bits=bits) for bits in (26, 6))
    assert small.tokens == whole.tokens > 2**12
    # Fewer than 2 ** 6 of each order, with a level for each doubling.
    assert 64 * small.filter.sizes.sum() < 2 * 2**6 * 7 * BITS_PER_ENTRY < 64 * whole.filter.sizes.sum()
    docs = spark.createDataFrame(list(enumerate(random_texts(50, 5))), "doc_id int, text string")
    sums = [score_texts(docs, model).agg({"score": "sum", "base_score": "sum"}).first() for model in (whole, small)]
    assert sums[0]["sum(base_score)"] == pytest.approx(sums[1]["sum(base_score)"])
    assert sums[1]["sum(score)"] == pytest.approx(sums[0]["sum(score)"], rel=0.2)


def test_every_ngram_is_held_whatever_the_size(spark):
    """With more than 2 ** 26 tokens n-grams that occur once are held as well."""
    texts = spark.range(100).selectExpr("repeat('a ', 700000) AS text").union(spark.createDataFrame([("b c d",)], "text string"))
    model = train_language_model(texts)
    assert model.tokens > 2**26
    for words in words_of(pa.array(["b c d"]), TOKEN_BYTES):
        assert (model.filter.levels(tokens_of(words).grams(2)[:3]) > 0).all()
    docs = spark.createDataFrame([(1, "b c d"), (2, "d c b")], "doc_id int, text string")
    scores = {row["doc_id"]: row["score"] for row in score_texts(docs, model).collect()}
    assert scores[1] > scores[2] + 1


def test_blocks_and_segments_change_no_score(spark, monkeypatch):
    from lakemarts.llm import language_model

    texts = spark.createDataFrame([(t,) for t in random_texts(300, 6)], "text string")
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate([*random_texts(90, 7), None, "", "x"])], "doc_id int, text string")

    def scored():
        model = train_language_model(texts)
        return sorted(tuple(row) for row in score_texts(docs, model).collect()), model.segment_bits

    one, bits = scored()
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 300)
    many, _ = scored()
    assert [row[:3] for row in many] == [row[:3] for row in one] and len(many) == 93
    for row, other in zip(many, one):
        assert row[3:] == pytest.approx(other[3:], rel=1e-9)
    monkeypatch.setattr(language_model, "SEGMENT_GRAMS", 200)
    cut, more_bits = scored()
    assert more_bits > bits + 3 and [row[:3] for row in cut] == [row[:3] for row in one]
    # Other places in the filter: now and then a level is one too high.
    assert sum(row[4] for row in cut) == pytest.approx(sum(row[4] for row in one), rel=0.01)


def test_a_block_is_scored_in_little_memory():
    """A task holds a block's tokens and distinct n-grams, and one slice of it in numbers."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 2000) % 100_000) for _ in range(1000)]
    block = pa.table({"doc_id": np.arange(1000), "text": texts, "block": pa.array(np.zeros(1000), pa.int32())})
    size = sum(map(len, texts))
    heavy = SimpleNamespace(value=pa.table({"token": pa.array(["w1"], pa.large_string()), "n": [9]}))
    weights = Weights([np.zeros(1), np.array([0.0, 1.0]), np.array([0.0, 1.0])], [0.0, 0.0, 2.0], 10**6, 10**5, 0.0)

    def peak(work):
        tracemalloc.start()
        found = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found, most / size

    peak(lambda: _asked(block.slice(0, 10), 2, 4))  # the tables of powers
    asked, most = peak(lambda: _asked(block, 2, 4))
    assert most < 8
    rare = _rare_rows(block, heavy)
    levels = [np.ones(len(one) // 4, np.uint8).tobytes() for one in asked["data"].to_pylist()]
    answers = pa.concat_tables(
        [
            pa.table({"size": asked["size"], "part": asked["segment"], "levels": levels}),
            pa.table({"size": pa.array(np.zeros(len(rare)), pa.int32()), "part": rare["part"], "n": np.full(len(rare), 3)}),
        ],
        promote_options="default",
    )
    scored, most = peak(lambda: _scored(block, answers, weights, 4, heavy, 1000))
    assert most < 10
    assert scored["n_tokens"].to_pylist() == scored["n_known"].to_pylist() == [2001] * 1000


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    model = train_language_model(empty)
    assert score_texts(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    rows = {r["doc_id"]: tuple(r)[1:] for r in score_texts(docs, model).collect()}
    assert rows == {1: (3, 0, 0.0, 0.0), 2: (1, 0, 0.0, 0.0)}


def test_the_query(spark):
    docs = spark.read.parquet(f"{DATA_DIR}/documents.parquet").collect()
    out = [zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs]
    base, total = plain_base([d["text"] for d, o in zip(docs, out) if not o], [d["text"] for d in docs])
    found = {r["doc_id"]: r for r in LLM_QUERIES["op13_language_model"](spark, DATA_DIR).collect()}
    for d, o, (n, known, score) in zip(docs, out, base):
        row = found[d["doc_id"]]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (o, n, known, total)
        assert row["base_score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
