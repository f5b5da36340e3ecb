"""Secret scans: fixed patterns, and a test battery for random-looking strings.

Patterns find assignments to password-like names, access keys and long hexadecimal
runs. Beyond these, every long run of key characters is read in the narrowest encoding
that fits it, and three tests ask whether it looks drawn at random from that alphabet:
a chi-squared test of uniform symbols, a runs test of ups and downs around the middle,
and the serial correlation of neighbours. Ordinary words of the corpus, joined until
they are as long as a class asks, tell how often such a score comes up by chance; so
every class has a yardstick, also where no word is that long. The false discovery
rate is then controlled within each class of length.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.frames import keyed_texts, written

# The kinds in the order that breaks ties, their patterns and lengths.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

#: Runs that the battery looks at.
LEAST_RANDOM = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RANDOM)
#: Of the spans reported in a class of length, at most this share is expected to be words.
FALSE_DISCOVERIES = 0.01
#: Scores are kept to this many steps per unit, rounded down, so towards "word".
STEPS = 20
#: Upper bounds of the length classes.
LENGTHS = (24, 32, 48, 64, 128)
#: Joined words per class of length, in expectation; larger corpora have one of some class for each text.
CHANCE_WORDS = 1000
#: Beyond the best of them their scores are taken to thin out by e each so many steps, or more slowly.
LEAST_TAIL = 5

_KEY = "A-Za-z0-9+/_=-"
#: Words and short numbers that stand alone.
_ORDINARY = re.compile(rf"(?<![{_KEY}])(?:[A-Za-z]?[a-z]+|[A-Z]{{2,8}}|[0-9]{{1,4}})(?![{_KEY}])")
#: For texts that have none.
_PLAIN_WORDS = tuple("the of and to in is that it for was on are with from have this which people number water".split())
_POOL = 40


@dataclass(frozen=True)
class Encoding:
    name: str
    symbols: str

    def codes(self, token: str) -> np.ndarray:
        place = {symbol: number for number, symbol in enumerate(self.symbols)}
        return np.array([place[symbol] for symbol in token])


_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SMALL = _UPPER.lower()
#: Narrowest first.
ENCODINGS = tuple(
    Encoding(name, symbols)
    for name, symbols in (
        ("decimal", _DIGITS),
        ("hex", _DIGITS + "abcdef"),
        ("upper_hex", _DIGITS + "ABCDEF"),
        ("base32", _UPPER + "234567"),
        ("lower", _SMALL),
        ("base36", _DIGITS + _SMALL),
        ("upper36", _DIGITS + _UPPER),
        ("base62", _DIGITS + _UPPER + _SMALL),
        ("base64", _DIGITS + _UPPER + _SMALL + "+/"),
        ("base64url", _DIGITS + _UPPER + _SMALL + "-_"),
        ("any", _DIGITS + _UPPER + _SMALL + "+/-_="),
    )
)
_SETS = [(encoding, frozenset(encoding.symbols)) for encoding in ENCODINGS]


def encoding_of(token: str) -> Encoding:
    """The narrowest encoding that holds the token, padding aside."""
    used = set(token.rstrip("="))
    return next(encoding for encoding, symbols in _SETS if used <= symbols)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[float, float, float]:
    """p-values of uniform symbols, runs and serial correlation, if drawn at random."""
    encoding = encoding_of(token)
    codes = encoding.codes(token.rstrip("=") if encoding.name != "any" else token)
    n, size = len(codes), len(encoding.symbols)
    if n < 4:
        return 0.0, 0.0, 0.0
    expected = n / size
    chi = float(((np.bincount(codes, minlength=size) - expected) ** 2).sum() / expected)
    # Wilson and Hilferty's cube root, one-sided: too uneven.
    free = size - 1
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = codes >= size / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n1 and n0:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n1 * n0 / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        run = _normal_tail((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        run = 2.0 ** (1 - n)
    centred = codes - codes.mean()
    power = float((centred**2).sum())
    if power == 0:
        return uniform, run, 0.0
    correlation = float((centred[1:] * centred[:-1]).sum()) / power
    serial = _normal_tail((correlation + 1 / n) * math.sqrt(n))
    return uniform, run, serial


def randomness(token: str) -> float:
    """Evidence for a random token: bits of its encoding less what the tests hold against it.

    Changes between digits and letters and from small letters to capitals count for it, and
    each test takes off its surprise. Separators are read over, and a capital before small
    letters is how words begin. Only tokens that mix kinds of characters can score high.
    """
    encoding = encoding_of(token)
    kinds = sum(
        any(symbol in kind for symbol in token) for kind in (_DIGITS, _UPPER, _SMALL)
    )
    if kinds < 2 and encoding.name not in ("hex", "upper_hex"):
        return -1.0
    order = [kind for kind in map(_kind, token) if kind < 3]
    switches = sum(a != b and (a, b) != (1, 2) for a, b in zip(order, order[1:]))
    surprise = -sum(math.log(max(p, 1e-12)) for p in battery(token))
    return 10.0 * switches / (len(token) - 1) - surprise / math.sqrt(len(token))


def _kind(symbol: str) -> int:
    return 0 if symbol in _DIGITS else 1 if symbol in _UPPER else 2 if symbol in _SMALL else 3


def length_class(n: int) -> int:
    return sum(n > bound for bound in LENGTHS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find, in code points."""
    spans = [
        (found.start(), 0, found.end())
        for found in ASSIGN.finditer(text)
        if found.end(2) - found.start(2) >= ASSIGN_LEAST
    ]
    if "AKIA" in text:
        spans += [
            (found.start(), 1, found.end())
            for found in ACCESS.finditer(text)
            if found.end() - found.start() >= ACCESS_LEAST
        ]
    spans += [(found.start(), 2, found.end()) for found in HEX.finditer(text)]
    return sorted(spans)


def chance_words(text: str, n: int, seed: int) -> list[str]:
    """``n`` joins of the text's ordinary words, of all classes of length in turn."""
    rng = random.Random(seed)
    at = rng.randrange(len(text)) if text else 0
    pool = [found.group() for found in islice(_ORDINARY.finditer(text, at), _POOL)]
    if len(pool) < _POOL:
        pool += [found.group() for found in islice(_ORDINARY.finditer(text), _POOL - len(pool))]
    pool = pool or _PLAIN_WORDS
    lows, highs = (LEAST_RANDOM, *(bound + 1 for bound in LENGTHS)), (*LENGTHS, 2 * LENGTHS[-1])
    out, first = [], rng.randrange(len(lows))
    for number in range(n):
        size = (first + number) % len(lows)
        length, style = rng.randint(lows[size], highs[size]), rng.randrange(5)
        parts, so_far, between = [], 0, ("", "", "-", "_", "/")[style]
        while so_far < length + len(between):
            word = rng.choice(pool)
            parts.append(word.capitalize() if style == 0 else word)
            so_far += len(word) + len(between)
        out.append(between.join(parts)[:length])
    return out


def _scanned(batches, by_chance: int):
    kind = pa.struct(
        [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]
    )
    candidate = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("score", pa.int32()), ("word", pa.bool_())]
    )
    for batch in batches:
        base, others = [], []
        for text, text_hash in zip(batch.column("text").to_pylist(), batch.column("text_hash").to_pylist()):
            spans = base_spans(text)
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            own = []
            for found in CANDIDATE.finditer(text):
                a, b, token = found.start(), found.end(), found.group()
                if any(x < b and a < y for x, _, y in spans):
                    continue
                own.append(
                    {
                        "start": a, "end": b, "size": length_class(b - a),
                        "score": math.floor(STEPS * randomness(token)), "word": False,
                    }
                )
            own += [
                {
                    "start": 0, "end": 0, "size": length_class(len(word)),
                    "score": math.floor(STEPS * randomness(word)), "word": True,
                }
                for word in chance_words(text, by_chance, text_hash)
            ]
            others.append(own)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(base, pa.list_(kind)),
                pa.array(others, pa.list_(candidate)),
            ],
            ["doc_id", "text_hash", "base", "candidates"],
        )


def _tail(words: list[tuple[int, int]]) -> tuple[int, float]:
    """The best score, and by how much the best hundredth of the words exceeds its least.

    ``words`` has (score, words), best first.
    """
    if not words:
        return 0, float(LEAST_TAIL)
    enough, n, total = max(10, sum(count for _, count in words) / 100), 0, 0
    for score, count in words:
        n += count
        total += count * score
        if n >= enough:
            break
    return words[0][0], max(float(LEAST_TAIL), total / n - score)


def score_limits(counts: list[tuple[int, int, int, int]], rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Least score reported in each class of length.

    ``counts`` has (class, score, words, others). The words say how often a word reaches a
    score; the share of others that words would explain there must not exceed ``rate``.
    Beyond the best word the chance falls off exponentially, by the words' own tail.
    """
    limits = {}
    for size in {row[0] for row in counts}:
        own = sorted((row for row in counts if row[0] == size), key=lambda row: -row[1])
        words, others = sum(row[2] for row in own), sum(row[3] for row in own)
        best, tail = _tail([(row[1], row[2]) for row in own if row[2]])
        above_words = above_others = 0
        for _, score, n_words, n_others in own:
            above_words += n_words
            above_others += n_others
            chance = (above_words + 1) / (words + 1)
            if words and not above_words:
                chance *= math.exp((best - score) / tail)
            if score >= 0 and above_others and chance * others / above_others <= rate:
                limits[size] = score
    return limits


def find_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = FALSE_DISCOVERIES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``base`` and ``spans``.

    Both are arrays of (start, kind, end): code points, end exclusive, by start and then
    kind (a number in :data:`KINDS`). ``spans`` holds the base spans and the random ones that
    overlap none. Null text counts as empty and has none. Runs of fewer than
    :data:`LEAST_RANDOM` characters, and those of one kind (digits, capitals or small letters
    alone), are never reported as random.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = keyed_texts(docs, id_col, text_col)
    by_chance = -(-CHANCE_WORDS * (len(LENGTHS) + 1) // max(texts.count(), 1))
    found = written(
        texts.mapInArrow(
            lambda batches: _scanned(batches, by_chance),
            f"doc_id {id_type}, text_hash bigint, base array<struct<start: int, kind: int, end: int>>, "
            "candidates array<struct<start: int, end: int, size: int, score: int, word: boolean>>",
        )
    )
    # One row for each class and step of the score, whatever the corpus.
    counts = (
        found.select(F.inline("candidates"))
        .groupBy("size", "score")
        .agg(F.count_if("word").alias("words"), F.count_if(~F.col("word")).alias("others"))
        .collect()
    )
    limits = score_limits([tuple(row) for row in counts], rate)

    def reported(one):
        reached = F.lit(False)
        for size, score in limits.items():
            reached = reached | ((one["size"] == size) & (one["score"] >= score))
        return reached & ~one["word"]

    extra = F.transform(
        F.filter("candidates", reported),
        lambda one: F.struct(one["start"].alias("start"), F.lit(3).alias("kind"), one["end"].alias("end")),
    )
    return found.select(
        "doc_id", "text_hash", "base", F.array_sort(F.concat("base", extra)).alias("spans")
    )


def joined(spans: str):
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda one: F.concat_ws(
                ":", F.element_at(names, one["kind"] + 1), one["start"].cast("string"), one["end"].cast("string")
            ),
        ),
        ",",
    )
