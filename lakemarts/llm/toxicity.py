"""Toxicity by a subsequence string-kernel machine with Nyström landmarks.

The kernel of two words counts the subsequences of four characters that they share;
each may skip up to two characters and then weighs less. So a word with inserted or
left-out characters stays close to the one it imitates. Punctuation inside a word is
skipped at no cost, and letters that stand alone are read as one word.

A squared-hinge machine is trained on features of the kernel with landmark words.
Its decision is a weighted sum of kernels with the landmarks, and so a fixed weight
for each subsequence: scoring a text is a table lookup for each of its subsequences.
A sentence or document is as toxic as its most toxic word.
"""

from __future__ import annotations

import pickle
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.arrays import LOWER, row_slices, text_bytes
from lakemarts.llm.frames import written

LENGTH = 4
#: Characters that a subsequence may span, and the weight of each skipped one.
SPAN = 6
DECAY = 0.5
TABLE_BITS = 20
#: A longer word is scored in parts that overlap, so that it cannot dilute what it holds:
#: whatever has up to ``PART - STEP + 1`` bytes lies whole in one of them.
LONGEST_WORD = 24
PART = 10
STEP = 2
#: Labelled training texts per class, in expectation, and words and landmarks used.
TRAINING_TEXTS = 4000
TRAINING_WORDS = 6000
LANDMARKS = 512
RIDGE = 1e-3
#: Fits; before each but the first the worst words of clean texts are added.
ROUNDS = 4

_SKIPS = [
    (places, DECAY ** (places[-1] - LENGTH + 1))
    for places in ((0, *rest) for rest in combinations(range(1, SPAN), LENGTH - 1))
]
_SPACE = np.uint8(0x20)
_KIND = np.zeros(256, np.uint8)  # 0: skipped, 1: part of a word, 2: white space
_KIND[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = 2


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; the no-break and other wide spaces of Unicode are white space."""
    kind = _KIND[data]
    for first in np.flatnonzero((data[:-1] == 0xC2) & (data[1:] == 0xA0)):
        kind[first : first + 2] = 2
    third = data[2:]
    wide = (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (((third >= 0x80) & (third <= 0x8A)) | (third == 0xAF))
    wide |= (data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (third == 0x80)
    for first in np.flatnonzero(wide):
        kind[first : first + 3] = 2
    return kind


@dataclass
class _Units:
    """Words of some rows as one stream; each word stands between two spaces."""

    stream: np.ndarray
    starts: np.ndarray  # of each word's leading space
    ends: np.ndarray  # after its trailing space
    row: np.ndarray

    def subsequences(self):
        """(position, table slot, weight) of all subsequences that stay in one word."""
        n = len(self.stream)
        last = np.zeros(n, np.int64)
        last[self.starts] = np.diff(np.append(0, self.ends))
        limit = np.cumsum(last) if n else last
        codes = self.stream.astype(np.uint32)
        for places, weight in _SKIPS:
            reach = n - places[-1]
            if reach <= 0:
                continue
            code = codes[:reach]
            for place in places[1:]:
                code = (code << np.uint32(8)) | codes[place : place + reach]
            slot = (code * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)
            inside = np.flatnonzero(np.arange(reach) + places[-1] < limit[:reach])
            yield inside, slot[inside], weight


def _units(column: pa.Array):
    """Slices of rows: first row, rows, their words."""
    raw, offsets = text_bytes(column)
    for first, last in row_slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        data = LOWER[raw[offsets[first] : offsets[last]]]
        kind = _kinds(data)
        row = np.repeat(np.arange(last - first), np.diff(own))
        keep = kind > 0
        data, kind, row = data[keep], kind[keep], row[keep]
        letter = kind == 1
        at = np.flatnonzero(letter)
        if not len(at):
            yield first, last - first, _Units(data[:0], at, at, at)
            continue
        breaks = np.ones(len(at), bool)
        breaks[1:] = (np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]])
        start = np.flatnonzero(breaks)
        size = np.diff(np.append(start, len(at)))
        # Single characters in a row are one word that was spaced out.
        joined = np.zeros(len(start), bool)
        joined[1:] = (size[1:] == 1) & (size[:-1] == 1) & (row[at[start[1:]]] == row[at[start[:-1]]])
        start = start[~joined]
        size = np.diff(np.append(start, len(at)))
        parts = np.where(size > LONGEST_WORD, -(-(size - PART) // STEP) + 1, 1)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        end = np.repeat(start + size, parts)
        cut = np.repeat(size > LONGEST_WORD, parts)
        start = np.repeat(start, parts) + part * STEP
        size = np.where(cut, np.minimum(end - start, PART), end - start)
        out_start = np.cumsum(size + 2) - (size + 2)
        stream = np.full(int((size + 2).sum()), _SPACE)
        place = np.arange(size.sum())
        letters = place + np.repeat(start - (np.cumsum(size) - size), size)
        stream[place + np.repeat(2 * np.arange(len(start)) + 1, size)] = data[at[letters]]
        yield first, last - first, _Units(stream, out_start, out_start + size + 2, row[at[start]])


def _word_scores(units: _Units, table: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's subsequences over their norm."""
    total = np.zeros(len(units.stream))
    norm = np.zeros(len(units.stream))
    for at, slot, weight in units.subsequences():
        total[at] += table[slot] * weight
        norm[at] += weight * weight
    if not len(units.starts):
        return total[:0]
    norms = np.add.reduceat(norm, units.starts)
    return np.add.reduceat(total, units.starts) / np.sqrt(np.maximum(norms, 1e-9))


@dataclass
class ToxicityModel:
    """A weight per subsequence, the bias, and the slope and offset to a probability."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, column: pa.Array) -> np.ndarray:
        """Largest word margin of each text; that of no word where there is none."""
        best = np.full(len(column), self.bias)
        for first, rows, units in _units(column):
            scores = _word_scores(units, self.table) + self.bias
            some, at = np.unique(units.row, return_index=True)
            if len(some):
                best[first + some] = np.maximum(self.bias, np.maximum.reduceat(scores, at))
        return best

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def _features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots and normalised weights of each word's subsequences."""
    found = []
    for word in words:
        for _, _, units in _units(pa.array([word])):
            slots, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, slot, weight in units.subsequences():
                slots.append(slot.astype(np.int64))
                weights.append(np.full(len(slot), weight))
            slot, weight = np.concatenate(slots), np.concatenate(weights)
            found.append((slot, weight / np.sqrt(max((weight**2).sum(), 1e-9))))
            break
        else:
            found.append((np.zeros(0, np.int64), np.zeros(0)))
    return found


def fit_machine(
    toxic_words: dict[str, float], clean_words: dict[str, float], landmarks: int = LANDMARKS
) -> ToxicityModel:
    """Squared-hinge machine on Nyström features, from words and their weights.

    The landmarks are the words of largest weight, half of each class.
    """
    classes = [
        sorted(words.items(), key=lambda item: (-item[1], item[0])) for words in (toxic_words, clean_words)
    ]
    words = [word for own in classes for word, _ in own]
    labels = np.repeat([1.0, -1.0], [len(own) for own in classes])
    cost = np.concatenate(
        [0.5 * np.array([n for _, n in own]) / sum(n for _, n in own) for own in classes]
    )
    features = _features(words)
    first = len(classes[0])
    chosen = [*range(min(first, landmarks // 2)), *range(first, min(len(words), first + landmarks // 2))]
    slots = np.unique(np.concatenate([features[index][0] for index in chosen]))
    basis = np.zeros((len(slots) + 1, len(chosen)))
    for column, index in enumerate(chosen):
        np.add.at(basis[:, column], np.searchsorted(slots, features[index][0]), features[index][1])
    kernel = np.zeros((len(words), len(chosen)))
    for index, (slot, weight) in enumerate(features):
        place = np.minimum(np.searchsorted(slots, slot), len(slots) - 1)
        place = np.where(slots[place] == slot, place, len(slots))
        kernel[index] = np.einsum("i,ij->j", weight, basis[place])
    values, vectors = np.linalg.eigh(kernel[chosen])
    kept = values > 1e-8 * values.max()
    to_features = vectors[:, kept] / np.sqrt(values[kept])
    z = np.hstack([kernel @ to_features, np.ones((len(words), 1))])
    w = np.zeros(z.shape[1])
    penalty = RIDGE * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9
    for _ in range(50):
        active = labels * (z @ w) < 1
        weighted = z[active] * cost[active, None]
        new = np.linalg.solve(penalty + weighted.T @ z[active], weighted.T @ labels[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    alpha = to_features @ w[:-1]
    table = np.zeros(1 << TABLE_BITS)
    table[slots] = basis[:-1] @ alpha
    return ToxicityModel(table, float(w[-1]))


def _platt(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through smoothed labels."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w[0] * margins + w[1], -30, 30)))
        off, weight = p - target, p * (1 - p)
        gradient = np.array([(margins * off).sum(), off.sum()]) + 1e-4 * w
        a, b, c = (weight * margins**2).sum() + 1e-4, (weight * margins).sum(), weight.sum() + 1e-4
        step = np.array([c * gradient[0] - b * gradient[1], a * gradient[1] - b * gradient[0]]) / (a * c - b * b)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _word_rows(batches):
    """Words of each text, each with the word before it."""
    for batch in batches:
        for first, rows, units in _units(batch.column("text")):
            raw = units.stream.tobytes()
            words = [
                raw[a + 1 : b - 1].decode("utf-8", "ignore")
                for a, b in zip(units.starts.tolist(), units.ends.tolist())
            ]
            found: list[set[tuple[str, str]]] = [set() for _ in range(rows)]
            for row, word, before in zip(units.row.tolist(), words, ["", *words]):
                found[row].add((word, before))
            kind = pa.list_(pa.struct([("word", pa.string()), ("before", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("number").slice(first, rows),
                    batch.column("toxic").slice(first, rows),
                    pa.array([[{"word": w, "before": p} for w, p in sorted(own)] for own in found], kind),
                ],
                ["number", "toxic", "words"],
            )


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    training_texts: int = TRAINING_TEXTS,
    training_words: int = TRAINING_WORDS,
    landmarks: int = LANDMARKS,
) -> ToxicityModel:
    """A model from whole texts of ``docs`` with a label 0 or 1 in ``labels``.

    At most about ``training_texts`` of each class are used, chosen by a hash of the
    id, equal texts once. An id with both labels, and a text that stands under both,
    is toxic. The toxic words are those that tell the classes apart best
    in each toxic text; clean words are drawn by hash, by frequency, and in each round
    by margin. Rows without a label or text are left out;
    without texts of both classes every text scores 0. Texts are read in tasks: the driver
    gets words and margins, a few for each training text.
    """
    labelled = (
        labels.select(
            labels[label_id_col].alias("id"), labels[label_col].cast("int").alias("toxic")
        )
        .filter("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {row["toxic"]: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    nothing = ToxicityModel(np.zeros(1 << TABLE_BITS), -1.0, 1.0, -500.0)
    if not totals.get(0) or not totals.get(1):
        return nothing
    million = 1_000_000
    share = F.when(F.col("toxic") == 1, int(million * min(1.0, training_texts / totals[1]))).otherwise(
        int(million * min(1.0, training_texts / totals[0]))
    )
    drawn = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(million)) < share)
    text = docs[text_col].cast("string")
    sample = written(
        docs.select(docs[id_col].alias("id"), text.alias("text"))
        .filter("text is not null")
        .join(F.broadcast(drawn), "id")  # at most about twice ``training_texts`` rows
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("number", F.xxhash64("text"))
    )
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return nothing
    toxic_words, clean_words = _first_words(sample, sizes, training_words)
    if not toxic_words or not clean_words:
        return nothing
    for round_ in range(ROUNDS):
        model = _fitted(sample, toxic_words, clean_words, landmarks)
        if round_ == ROUNDS - 1:
            break
        worst = _largest(sample, model)
        clean_words.update({word: n for word, n in worst.items() if word not in toxic_words})
    margins = _margins(sample, model)
    model.slope, model.offset = _platt(*margins)
    return model


def _first_words(
    sample: DataFrame, sizes: dict[int, int], training_words: int
) -> tuple[dict[str, float], Counter[str]]:
    """A first guess of the toxic words, and clean ones, with their weights."""
    lists = sample.mapInArrow(
        _word_rows, "number bigint, toxic int, words array<struct<word: string, before: string>>"
    )
    words = lists.select(
        "number", "toxic", F.inline("words")
    ).withColumn("before", F.hash("before"))
    # A toxic word counts once for each toxic text, and for each word it follows: copies
    # of one text repeat both, while an insult turns up in many places.
    toxic_only = {name: F.when(F.col("toxic") == 1, F.col(name)) for name in ("before", "number")}
    counted = written(
        words.groupBy("word").agg(
            # Sets as large as the training texts at most.
            F.least(*[F.size(F.collect_set(name)) for name in toxic_only.values()]).alias("n1"),
            F.count_if(F.col("toxic") == 0).alias("n0"),
        )
    )
    n1, n0 = F.lit(float(sizes[1])), F.lit(float(sizes[0]))
    odds = F.log((F.col("n1") + 0.1) / (n1 + 0.2)) - F.log((F.col("n0") + 0.1) / (n0 + 0.2))
    # Rare words say little: shrink by how often the word was seen.
    worth = odds * F.col("n1") / (F.col("n1") + 3.0)
    worths = (
        words.filter("toxic = 1")
        .select("number", "word")
        .distinct()
        .join(counted.select("word", worth.alias("worth")), "word")
    )
    most = worths.groupBy("number").agg(F.max("worth").alias("most"))
    telling = worths.join(most, "number").filter("worth > 0 and worth >= 0.6 * most")
    toxic_words = {row["word"]: row["count"] for row in telling.groupBy("word").count().collect()}
    clean = (
        counted.filter("n0 > 0 and length(word) > 1")
        .orderBy(F.xxhash64("word"), "word")
        .limit(training_words)
        .collect()
    )
    common = (
        counted.filter("n0 > 0").orderBy(F.desc("n0"), "word").limit(training_words // 4).collect()
    )
    return toxic_words, Counter({row["word"] for row in [*clean, *common]} - set(toxic_words))


def _fitted(
    sample: DataFrame, toxic_words: dict[str, float], clean_words: dict[str, float], landmarks: int
) -> ToxicityModel:
    """The machine, fitted in a task: there the BLAS has one thread.

    In a driver that has started a JVM its threads can block for ever.
    """
    job = sample.sparkSession.createDataFrame([(pickle.dumps((toxic_words, clean_words, landmarks)),)], "job binary")

    def fit(batches):
        for batch in batches:
            for one in batch.column("job").to_pylist():
                model = fit_machine(*pickle.loads(one))
                table = model.table.astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([table]), pa.array([model.bias])], ["table", "bias"])

    row = job.coalesce(1).mapInArrow(fit, "table binary, bias double").first()
    return ToxicityModel(np.frombuffer(row["table"], "<f8"), row["bias"])


def _largest(sample: DataFrame, model: ToxicityModel) -> dict[str, int]:
    """The words of largest margin in some clean text, and in how many."""
    shared = sample.sparkSession.sparkContext.broadcast(model.table)

    def largest(batches):
        for batch in batches:
            words = []
            for _, _, units in _units(batch.column("text")):
                scores = _word_scores(units, shared.value)
                raw = units.stream.tobytes()
                begins = [*np.unique(units.row, return_index=True)[1].tolist(), len(units.row)]
                for a, b in zip(begins, begins[1:]):
                    word = a + int(scores[a:b].argmax())
                    words.append(raw[units.starts[word] + 1 : units.ends[word] - 1].decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], ["word"])

    # A word for each training text at most.
    clean = sample.filter("toxic = 0").select("text")
    found = clean.mapInArrow(largest, "word string").groupBy("word").count().orderBy("word")
    return {row["word"]: row["count"] for row in found.collect()}


def _margins(sample: DataFrame, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    """The margin of each training text, and whether it is toxic."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            margins = pa.array(shared.value.margins(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [margins, batch.column("toxic"), batch.column("number")], ["margin", "toxic", "number"]
            )

    found = sample.mapInArrow(scan, "margin double, toxic int, number bigint").orderBy("number").toArrow()
    return found["margin"].to_numpy(), found["toxic"].to_numpy() == 1


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` of every row, from its whole text alone.

    Null and empty texts have no word and get the score of a text without any evidence. Ids
    may be null or repeat; texts may have any length; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            score = shared.value.probabilities(shared.value.margins(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")
    ).mapInArrow(
        scan, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int"
    )


def held_out(id_column: Column) -> Column:
    """True for a fifth of all ids, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
