"""Packing, tokens, secrets, language, toxicity, decontamination and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakemarts.llm.decontaminate import contamination, decontaminated
from lakemarts.llm.language_id import documents_with_language, in_known_languages, pages_with_language
from lakemarts.llm.packing import configurations, pack, plan_packing
from lakemarts.llm.queries import LLM_QUERIES
from lakemarts.llm.secrets import (
    ACCESS,
    ACCESS_LEAST,
    ASSIGN,
    ASSIGN_LEAST,
    base_spans,
    find_secrets,
    joined,
    score_limits,
)
from lakemarts.llm.token_counts import line_sections, section_token_counts
from lakemarts.llm.tokens import encoder, vocabulary
from lakemarts.llm.toxicity import held_out, score_toxicity, train_toxicity

DATA_DIR = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def odd_texts(n: int) -> list[str]:
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "1", "!", "漢", "<|endoftext|>", "😀", "don't"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_ids_and_offsets_are_those_of_the_library(reference_tokenizer):
    coder = encoder(vocabulary())
    for text in odd_texts(1500):
        coded = reference_tokenizer.encode(text, add_special_tokens=False)
        assert coder.ids(text).tolist() == coded.ids
        first, last = coder.characters(text)
        assert list(zip(first.tolist(), (last + 1).tolist())) == coded.offsets


@pytest.mark.parametrize("unit", [" ", "\n", "\t", "\u00a0", "a", "!"])
def test_very_long_runs_have_the_ids_of_the_library(reference_tokenizer, unit):
    text = "start " + unit * 2_000_000 + "end of it"
    coded = reference_tokenizer.encode(text, add_special_tokens=False)
    coder = encoder(vocabulary())
    assert coder.ids(text).tolist() == coded.ids
    first, last = coder.characters(text)
    assert list(zip(first.tolist(), (last + 1).tolist())) == coded.offsets


def test_very_long_runs_are_packed_and_counted(spark):
    rows = [(1, " " * 2_000_000), (2, "a" * 2_000_000), (3, "\n" * 1_100_000 + "x"), (4, "x")]
    docs = spark.createDataFrame(rows, DOC)
    lengths = {r["doc_id"]: r["n"] for r in pack(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    counts = section_token_counts(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
    assert lengths == {r["doc_id"]: r["n"] + 1 for r in counts.collect()} and lengths[1] == 2_000_001


def test_lines_and_given_sections(spark):
    for text in odd_texts(200):
        starts, ends = line_sections(text)
        assert "".join(text[a:b] for a, b in zip(starts, ends)) == text
    rows = [(1, "one two\nthree", [(0, 5), (7, 8)]), (2, None, None), (3, "x", [(0, 0)]), (4, "ab", [None])]
    docs = spark.createDataFrame(rows, DOC + ", parts array<struct<start: int, end: int>>")
    lines = section_token_counts(docs).collect()
    assert [(r["section"], r["start"], r["end"], r["n_tokens"]) for r in lines if r["doc_id"] == 1] == [
        (0, 0, 8, 3), (1, 8, 13, 1),
    ]
    given = section_token_counts(docs, sections_col="parts").collect()
    # " two" starts in the first section and ends beyond it; "three" starts in none.
    assert [tuple(r)[1:] for r in given if r["doc_id"] == 1] == [
        (0, 0, 5, 2, 1), (1, 7, 8, 1, 0), (-1, None, None, 1, 0),
    ]
    assert section_token_counts(docs.limit(0)).count() == 0


def test_nested_sections_by_brute_force(spark, reference_tokenizer):
    rng = random.Random(12)
    schema = DOC + ", parts array<struct<start: int, end: int>>, section int, tokens string"
    rows = [(0, "one two three four five six", [(0, 27), (4, 7)], 1, "x")]
    rows += [(None, None, [(0, 1)], 1, "x"), (None, "", None, 1, "x")]
    for i in range(1, 150):
        text = "".join(rng.choice(["a", " the", "\n", "é漢", "!", " word"]) for _ in range(rng.randint(0, 25)))
        parts = [sorted(rng.choices(range(len(text) + 3), k=2)) for _ in range(rng.randint(0, 6))]
        rows.append((i, text, [tuple(part) for part in parts], 1, "x"))
    rows += [rows[5]] * 3
    want: Counter = Counter()
    for doc_id, text, parts, *_ in rows:
        counts = Counter({(n, *part): [0, 0] for n, part in enumerate(parts or [])})
        for a, b in reference_tokenizer.encode(text or "", add_special_tokens=False).offsets:
            over = [(start, -end, n) for n, (start, end) in enumerate(parts or []) if start <= a < end]
            start, end, n = max(over, default=(None, None, -1))
            own = counts.setdefault((n, start, None if end is None else -end), [0, 0])
            own[0] += 1
            own[1] += n >= 0 and max(b, a + 1) > -end
        for (n, start, end), (tokens, crossing) in counts.items():
            want[doc_id, n, start, end, tokens, crossing] += 1
    found = section_token_counts(spark.createDataFrame(rows, schema), sections_col="parts")
    assert Counter(map(tuple, found.collect())) == want


def check_packing(spark, rows, capacity, reference):
    docs = spark.createDataFrame(rows, DOC + ", piece string, bucket int")
    packed = pack(docs, capacity=capacity).toPandas()
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        for index, (a, b) in enumerate(zip([0, *cuts], cuts)):
            want[doc_id, index, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, packed[columns].itertuples(index=False))) == want
    for _, sequence in packed.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == [0, *sequence.length.cumsum()[:-1]]
        assert sequence.length.sum() <= capacity
    return packed


def test_pack_by_brute_force(spark, reference_tokenizer):
    rng = random.Random(2)
    rows = [(i, "word " * rng.randint(0, 150), "x", 1) for i in range(300)]
    rows += [(7, "same text", "x", 1)] * 40 + [(1000, None, None, None), (1001, "", None, None)]
    packed = check_packing(spark, rows, 64, reference_tokenizer)
    assert packed.sequence_id.nunique() <= 1.02 * packed.length.sum() / 64 + 2
    assert pack(spark.createDataFrame([], DOC)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 500, 40_000, 10**9])
def test_plans_hold_everything_and_waste_little(n):
    rng = np.random.default_rng(3)
    drawn = np.clip(np.exp(rng.normal(6.6, 0.9, min(n, 40_000))).astype(int), 1, 2048)
    counts = {length: k * max(n // 40_000, 1) for length, k in Counter(drawn.tolist()).items()}
    plan = plan_packing(counts)
    assert plan.sequences <= 1.004 * sum(a * b for a, b in counts.items()) / 2048 + 2
    assert len(plan.length) < 30_000
    for length in counts:
        ranks = plan.rank[plan.length == length]
        assert ranks[0] == 0 and len(set(ranks.tolist())) == len(ranks)


def test_configurations_reach_a_known_optimum():
    found = configurations([60, 40], [30, 30], 100)
    assert sum(often for _, often in found) == pytest.approx(30)


def test_windows_in_texts(spark):
    item = "One two three four five six seven eight nine TEN eleven"
    benchmark = spark.createDataFrame(
        [(1, item), (2, "short item"), (3, None), (4, ""), (5, item), (None, "lone id")], "item_id int, text string"
    )
    rows = [
        (1, "x " + item.lower().replace(" ", ", ") + " y"),
        (2, "two three four five six seven eight nine ten"),  # nine words
        (3, "a short item, a short  ITEM"),
        (4, None), (5, ""), (6, "lone id"), (1, "clean"), (None, item),
    ]
    found = contamination(spark.createDataFrame(rows, DOC + ""), benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["item_ids"]) for r in found) == [
        (0, 11, 11, ["1", "5"]), (1, 1, 0, []), (1, 13, 11, ["1", "5"]), (2, 9, 0, []),
        (3, 6, 4, ["2"]), (4, 0, 0, []), (5, 0, 0, []), (6, 2, 2, []),
    ]
    docs = spark.createDataFrame([(*r, "w") for r in rows], DOC + ", words string")
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == ["", "", "clean", rows[1][1]]
    assert contamination(docs, benchmark.limit(0)).filter("contaminated").count() == 0
    assert contamination(docs.limit(0), benchmark).count() == 0


def test_small_filter_changes_nothing(spark):
    """With a full membership filter the join alone decides."""
    docs = spark.createDataFrame([(i, f"w{i} " * 3 + "a b c d e f g h i j") for i in range(20)], DOC)
    benchmark = spark.createDataFrame([(i, f"q{i} a b c d e f g h i j k{i}") for i in range(40)], "item_id int, text string")
    few = contamination(docs, benchmark, filter_bits=6).filter("n_hit = 10 and n_items = 40")
    assert few.count() == 20


def plain_base(text: str) -> str:
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_by_brute_force(spark):
    rng = random.Random(9)
    parts = ["password", "SECRET", "api_key", "apikey", "=", ": ", "'", "AKIA", "0123456789abcdef", "ABCD", "é", " ", "xY9/", "token: ", "\n", "ſecret"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(600)] + [(9999, None)]
    found = find_secrets(spark.createDataFrame(rows, DOC)).select("doc_id", joined("base").alias("base"))
    assert {r["doc_id"]: r["base"] for r in found.collect()} == {i: plain_base(t or "") for i, t in rows}
    assert base_spans("") == [] and ASSIGN_LEAST == 12 and ACCESS_LEAST == 18
    assert ASSIGN.search("password=a") and ACCESS.search("AKIA9")


def test_random_strings_stand_out(spark):
    rng = random.Random(3)
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(20, 31))) for _ in range(2400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 6])) for i in range(400)]
    rows += [(1000 + i, "id " + "".join(rng.choice(symbols) for _ in range(30)) + " end") for i in range(40)]
    found = find_secrets(spark.createDataFrame(rows, DOC)).filter("size(spans) > 0").collect()
    assert {r["doc_id"] for r in found} == set(range(1000, 1040))
    assert all((s["start"], s["kind"], s["end"]) == (3, 3, 33) for r in found for s in r["spans"])


@pytest.mark.parametrize("length", [22, 28, 40, 60, 100, 200])
def test_keys_stand_out_without_long_words(spark, length):
    """Texts of short words only, few keys of one class, one of them without digits."""
    rng = random.Random(length)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(30))) for i in range(60)]
    rows += [(100 + i, "some-ordinary-words-joined-" + "-and-others" * (length // 11)) for i in range(5)]
    keys = ["".join(rng.choice(letters + "0123456789") for _ in range(length)) for _ in range(11)]
    keys.append("".join(rng.choice(letters) for _ in range(length)))
    rows += [(1000 + i, f"id {key} end") for i, key in enumerate(keys)]
    found = find_secrets(spark.createDataFrame(rows, DOC)).filter("size(spans) > 0").collect()
    reported = {r["doc_id"] for r in found}
    assert reported <= set(range(1000, 1012)) and len(reported) >= (9 if length < 25 else 11)
    assert all((s["start"], s["kind"], s["end"]) == (3, 3, 3 + length) for r in found for s in r["spans"])


def test_limits_beyond_the_best_word():
    # Nothing reaches step 40 but keys, however few the words or keys; no word at all says nothing.
    assert score_limits([(0, 10, 990, 300), (0, 20, 10, 0), (0, 60, 0, 1)]) == {0: 60}
    assert score_limits([(0, 60, 0, 50)]) == {}


def test_limits_hold_the_rate():
    # 1000 words; 5 reach score 3. 100 others, 50 of them there.
    assert score_limits([(0, 1, 995, 50), (0, 3, 5, 50)], rate=0.02) == {0: 3}
    assert score_limits([(0, 1, 995, 50), (0, 3, 5, 50)], rate=0.01) == {}


def test_query_digests(spark):
    rows = {r["doc_id"]: r for r in LLM_QUERIES["op8_secrets"](spark, DATA_DIR).collect()}
    for doc in spark.read.parquet(f"{DATA_DIR}/documents.parquet").collect():
        base = plain_base(doc["text"] or "")
        assert rows[doc["doc_id"]]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert rows[doc["doc_id"]]["n_hex"] == base.count("hex:")


def test_language_of_documents_and_pages(spark):
    docs = spark.read.parquet(f"{DATA_DIR}/documents.parquet")
    found = documents_with_language(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.filter("language = lang and accepted").count() >= 0.97 * docs.count()
    pages = spark.read.parquet(f"{DATA_DIR}/pages.parquet")
    fused = pages_with_language(pages, docs)
    assert fused.count() == pages.count() and fused.filter("accepted").count() > 0.9 * pages.count()


def test_evidence_is_weighed(spark):
    docs = spark.read.parquet(f"{DATA_DIR}/documents.parquet").select("doc_id", "text", "lang", "source")
    text = docs.filter("lang = 'de' and length(text) > 800").first()["text"]
    extra = [(-1, text, "fr", "src1"), (-2, None, "en", None), (-3, "123 !?", "de", "src1"), (-4, text, None, None)]
    found = {
        r["doc_id"]: (r["language"], r["accepted"])
        for r in documents_with_language(docs.union(spark.createDataFrame(extra, docs.schema))).filter("doc_id < 0").collect()
    }
    assert found == {-1: ("de", True), -2: ("und", False), -3: ("und", False), -4: ("de", True)}
    assert in_known_languages(docs).count() == docs.count()
    assert documents_with_language(docs.limit(0)).count() == 0


def test_languages_come_from_the_tags(spark):
    """A language that rows declare is known, and one that hardly any declares is not."""
    rng = random.Random(4)
    syllables = {"it": ["zo", "gli", "che", "qua"], "nl": ["ij", "oe", "aa", "sch"], "xx": ["wq", "kv"]}
    rows = []
    for lang, parts in syllables.items():
        for i in range(40 if lang != "xx" else 3):
            text = " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(60))
            rows.append((len(rows), text, lang, None if i % 3 else f"www{i % 2}.{lang}"))
    rows += [rows[0], (None, rows[0][1], None, None), (900, None, "it", None)]
    schema = "doc_id bigint, text string, lang string, source string, suffix string, host string"
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], schema)
    found = documents_with_language(docs).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc_id, _, lang, _ in rows[:80]:
        assert by_id[doc_id]["language"] == lang and by_id[doc_id]["accepted"]
    assert by_id[None]["language"] == "it" and not by_id[900]["accepted"]
    kept = in_known_languages(docs)
    assert kept.columns == docs.columns and kept.filter("lang in ('it', 'nl')").count() == 81


def test_posterior_by_brute_force(spark):
    """Text evidence, tag likelihood and the smoothed host prior, each once."""
    import math

    from lakemarts.llm.language_id import PRIOR_ROWS, fuse_languages

    model = np.full((3, 1 << 16), -1.0, np.float32)
    model[2] = -9.0
    rows = [(i, "aaa" if i % 4 else "bbb", "de" if i % 3 else "fr", f"h{i % 2}.x.org" if i % 5 else None) for i in range(60)]
    # The text alone says the first language, by a little.
    model[1] = -1.2
    frame = spark.createDataFrame(rows, "n int, text string, declared string, host string")
    found = {r["n"]: r for r in fuse_languages(frame, model, ["de", "fr"]).collect()}
    votes = [(declared, host) for _, _, declared, host in rows]  # all for "de"
    hosted = [host for _, host in votes if host]
    every = [(len(rows) * (i == 0) + PRIOR_ROWS / 3) / (len(rows) + PRIOR_ROWS) for i in range(3)]

    def drawn(n, parent):
        return [(n * (i == 0) + PRIOR_ROWS * p) / (n + PRIOR_ROWS) for i, p in enumerate(parent)]

    domain = drawn(len(hosted), drawn(len(hosted), every))
    priors = {host: drawn(hosted.count(host), domain) for host in set(hosted)}
    for n, text, declared, host in rows:
        text_score = [0.2 * float(model[i, 0]) for i in range(3)]  # one gram
        text_score = [max(t - max(text_score), -60.0) for t in text_score]
        same = sum(d == declared for d, _ in votes)
        tag = [math.log((same * (i == 0) + 1) / (len(rows) * (i == 0) + 3)) for i in range(3)]
        prior = [math.log(p) for p in priors[host]] if host else [0.0] * 3
        score = [a + b + c for a, b, c in zip(text_score, tag, prior)]
        want = 1 / sum(math.exp(s - max(score)) for s in score)
        assert found[n]["language"] == "de"
        assert found[n]["probability"] == pytest.approx(want, abs=1e-6), (n, host)


def toxic_rows():
    rng = random.Random(5)
    clean = ["".join(rng.choice(["th", "er", "on", "an", "re", "ing"]) for _ in range(3)) for _ in range(400)]
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(clean) for _ in range(40)]
        if i % 4 == 0:
            words.insert(rng.randrange(40), rng.choice(["blorgface", "snurfwit", "grumpleton"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    rows, labels = toxic_rows()
    extra = [(1000, "th an b-l-o-r-g-f-a-c-e"), (1001, "s n u r f w i t"), (1002, "grumpleeton"), (1003, None), (1004, "")]
    docs = spark.createDataFrame(rows + extra, DOC)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    model = train_toxicity(docs, marks.filter(~held_out(marks["doc_id"])))
    found = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    out = [(i, toxic) for i, toxic in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(found[i]["predicted"] == toxic for i, toxic in out) >= 0.97 * len(out)
    assert [found[i]["predicted"] for i in range(1000, 1005)] == [1, 1, 1, 0, 0]
    assert score_toxicity(docs.limit(0), model).count() == 0


def test_an_insult_at_every_place_of_a_long_run(spark):
    rows, labels = toxic_rows()
    rng = random.Random(8)
    run = "".join(rng.choice(["th", "er", "on", "an", "re", "ing"]) for _ in range(50))
    hidden = [(2000 + i, run[:i] + "snurfwit" + run[i:]) for i in range(0, 90)]
    wide = [(3000, "th an\u00a0snurfwit\u00a0on"), (3001, "th\u3000snurfwit\u2003an"), (3002, run), (3003, run * 2000)]
    docs = spark.createDataFrame([(*r, "x", 0.0) for r in rows + hidden + wide], DOC + ", words string, score double")
    model = train_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    found = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs, model).collect()}
    assert np.mean([found[i] for i, _ in hidden]) >= 0.95
    assert [found[i] for i in (3000, 3001, 3002, 3003)] == [1, 1, 0, 0]


def test_ties_of_labels_have_one_result(spark):
    """Ids with both labels and texts under both are toxic, in whatever order they come."""
    rows, labels = toxic_rows()
    rows += [(600 + i, rows[4 * i][1]) for i in range(30)]
    labels += [(600 + i, 0) for i in range(30)] + [(i, 0) for i in range(0, 80, 4)]
    scores = []
    for turn in (1, 5):
        docs = spark.createDataFrame(rows[::turn] if turn == 1 else rows[::-1], DOC)
        marks = spark.createDataFrame(labels[::-1] if turn == 5 else labels, "doc_id bigint, toxic int")
        found = score_toxicity(docs, train_toxicity(docs.repartition(turn), marks.repartition(turn))).collect()
        scores.append({r["doc_id"]: r["score"] for r in found})
        assert all(r["predicted"] for r in found if r["doc_id"] % 4 == 0 and r["doc_id"] < 500)
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_no_labels_of_one_class(spark):
    docs = spark.createDataFrame([(1, "a b c")], DOC)
    model = train_toxicity(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int"))
    assert score_toxicity(docs, model).first()["predicted"] == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA_DIR}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA_DIR).columns == names, name
    packed = corpus_pipeline.run(spark, DATA_DIR)
    assert 0 < packed.select("doc_id").distinct().count() <= docs.count()
    benchmark = spark.read.parquet(f"{DATA_DIR}/benchmark.parquet")
    hit = contamination(docs, benchmark).filter("contaminated").select("doc_id")
    left = packed.select("doc_id").distinct()
    # A contaminated document stays only where line dedup has cut the passage out.
    assert left.join(hit, "doc_id").count() < hit.count()
