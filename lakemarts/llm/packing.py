"""Best-fit packing of tokenised documents into fixed-length sequences.

The plan is made from the histogram of piece lengths, which has at most one row for
each length up to the sequence length, so its size does not depend on the corpus:

1. Large pieces, sorted by length, are cut into groups of equal size, and all
   lengths of a group count as its largest (linear grouping).
2. For these few sizes the least number of sequences is a linear program over
   configurations, solved by column generation; whole parts are used.
3. Actual pieces take the places of their group, which leaves real gaps.
4. What is left, mainly the small pieces, goes to the tightest gap, longest first.

A plan is a list of runs: pieces of one length, with ranks from a to b, go to
consecutive sequences at one offset. Ranks within a length are given by Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.frames import keyed_texts, written
from lakemarts.llm.tokens import encoder, vocabulary

SEQUENCE = 2048
#: Pieces above this share of a sequence are large.
LARGE_SHARE = 0.34
GROUPS = 256
LEAST_IN_GROUP = 8
#: Rows of one length that are ranked in one task.
RANKED_TOGETHER = 1000


@dataclass
class Plan:
    """Runs sorted by length and first rank, and the number of sequences."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def _closer_inverse(inverse: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """One Newton step, which squares the error of a nearly right inverse.

    Only ``einsum`` on arrays of this size: threads of a BLAS cost more than they save,
    and can block for ever in a driver that has started a JVM.
    """
    wrong = np.eye(len(basis)) - np.einsum("ij,jk->ik", basis, inverse)
    return inverse + np.einsum("ij,jk->ik", inverse, wrong)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Best mix of configurations for few sizes: (pieces of each size, how often).

    The linear program's optimum by column generation: the basis starts with one
    size per configuration, and the best knapsack under the current prices enters.
    """
    count = len(sizes)
    basis = np.diag([float(capacity // size) for size in sizes])
    need = np.array(demand, float)
    inverse = np.diag(1.0 / np.diag(basis))
    for turn in range(20 * count):
        if turn % 50 == 49:
            inverse = _closer_inverse(inverse, basis)
        prices = inverse.sum(axis=0)
        best, taken = np.zeros(capacity + 1), np.zeros((count, capacity + 1), np.int64)
        for index, (size, price) in enumerate(zip(sizes, prices)):
            if price <= 0:
                continue
            before = best.copy()
            for copies in range(1, capacity // size + 1):
                worth = before[: capacity + 1 - copies * size] + copies * price
                target = best[copies * size :]
                better = worth > target + 1e-12
                target[better] = worth[better]
                taken[index, copies * size :][better] = copies
        # The optimum is at least value / best: stop when no more can be gained.
        value = float((prices * need).sum())
        if value - value / max(best[capacity], 1.0) < max(0.5, 1e-4 * value):
            break
        column, room = np.zeros(count), capacity
        for index in range(count - 1, -1, -1):
            column[index] = taken[index, room]
            room -= int(column[index]) * sizes[index]
        level, step = np.einsum("ij,jk->ki", inverse, np.stack([need, column], axis=1))
        ratio = np.full(count, np.inf)
        ratio[step > 1e-9] = np.maximum(level[step > 1e-9], 0) / step[step > 1e-9]
        leaves = int(ratio.argmin())
        basis[:, leaves] = column
        pivot = inverse[leaves] / step[leaves]
        inverse -= np.outer(step, pivot)
        inverse[leaves] = pivot
    level = np.einsum("ij,j->i", _closer_inverse(inverse, basis), need)
    return [
        ([int(round(n)) for n in basis[:, index]], float(level[index])) for index in range(count)
    ]


class _Stock:
    """Pieces by length with their next rank, taken off in runs."""

    def __init__(self, counts: Mapping[int, int]):
        self.left = dict(counts)
        self.next = dict.fromkeys(counts, 0)

    def take(self, length: int, n: int) -> int:
        rank = self.next[length]
        self.next[length] += n
        self.left[length] -= n
        return rank


def plan_packing(
    counts: Mapping[int, int],
    capacity: int = SEQUENCE,
    large_share: float = LARGE_SHARE,
    groups: int = GROUPS,
) -> Plan:
    """Where pieces go; ``counts`` has the number of pieces of each length."""
    stock = _Stock({length: n for length, n in counts.items() if n})
    runs: list[tuple[int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # by gap: (first sequence, sequences)
    gaps: list[int] = []
    sequences = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, stock.take(length, n), sequence, offset))

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in free:
                free[gap] = []
                insort(gaps, gap)
            free[gap].append((first, n))

    large = sorted((length for length in stock.left if length > large_share * capacity), reverse=True)
    total = sum(stock.left[length] for length in large)
    if total:
        each = max(-(-total // groups), LEAST_IN_GROUP)
        members: dict[int, list[list[int]]] = {}  # by rounded size: [length, pieces]
        room = 0
        for length in large:
            n = stock.left[length]
            while n:
                if room == 0:
                    size, room = length, each
                part = min(n, room)
                members.setdefault(size, []).append([length, part])
                n, room = n - part, room - part
        sizes = sorted(members, reverse=True)
        demand = [sum(n for _, n in members[size]) for size in sizes]
        for pattern, often in configurations(sizes, demand, capacity):
            n = int(often + 1e-6)
            slots = [size for size, copies in zip(sizes, pattern) for _ in range(copies)]
            for size in set(slots):
                n = min(n, sum(left for _, left in members[size]) // slots.count(size))
            used = [(sequences, n, 0)] if n > 0 else []  # first sequence, sequences, filled
            sequences += max(n, 0)
            for size in slots:
                after = []
                for first, run, filled in used:
                    while run:
                        segment = members[size][0]
                        part = min(run, segment[1])
                        place(segment[0], part, first, filled)
                        after.append((first, part, filled + segment[0]))
                        segment[1] -= part
                        if not segment[1]:
                            members[size].pop(0)
                        first, run = first + part, run - part
                used = after
            for first, run, filled in used:
                leave(capacity - filled, first, run)
    for length in sorted(stock.left, reverse=True):
        while n := stock.left[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                copies = min(capacity // length, n)
                fresh = n // copies
                for copy in range(copies):
                    place(length, fresh, sequences, copy * length)
                leave(capacity - copies * length, sequences, fresh)
                sequences += fresh
                continue
            gap = gaps[at]
            first, run = free[gap].pop()
            part = min(run, n)
            if part < run:
                free[gap].append((first + part, run - part))
            if not free[gap]:
                del free[gap], gaps[at]
            place(length, part, first, capacity - gap)
            leave(gap - length, first, part)
    ordered = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return Plan(ordered[:, 0], ordered[:, 1], ordered[:, 2], ordered[:, 3], sequences)


def _pieces(batches, path: str, capacity: int):
    for batch in batches:
        coder = encoder(path)
        rows, piece, start, length, crc = [], [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            ids = coder.ids(text).tobytes() + b"\0\0\0\0"
            n = len(ids) // 4
            cuts = [0, *range(n - (n - 1) // capacity * capacity, n + 1, capacity)]
            for index, (first, last) in enumerate(zip(cuts, cuts[1:])):
                rows.append(row)
                piece.append(index)
                start.append(first)
                length.append(last - first)
                crc.append(zlib.crc32(ids[4 * first : 4 * last]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def token_pieces(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_file: str | None = None,
    capacity: int = SEQUENCE,
) -> DataFrame:
    """Each document's ids and a closing 0, cut to at most ``capacity`` tokens.

    Longer documents give whole pieces of ``capacity``; the first may be shorter.
    Null text counts as empty and gives one piece of one token. Rows that repeat a
    doc_id are documents of their own.
    """
    path = tokenizer_file or vocabulary()
    return keyed_texts(docs, id_col, text_col).select("doc_id", "text").mapInArrow(
        lambda batches: _pieces(batches, path, capacity),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start bigint, "
        "length bigint, ids_crc32 bigint",
    )


def _assigned(batches, plan: Plan):
    keys = plan.length * (1 << 44) + plan.rank
    for batch in batches:
        length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
        run = np.searchsorted(keys, length * (1 << 44) + rank, "right") - 1
        sequence = plan.sequence[run] + rank - plan.rank[run]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")],
                pa.array(sequence, pa.int64()),
                pa.array(plan.offset[run], pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_file: str | None = None,
    capacity: int = SEQUENCE,
    large_share: float = LARGE_SHARE,
    groups: int = GROUPS,
) -> DataFrame:
    """All pieces of all documents with their sequence and offset.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; no
    rows for no documents. Other columns of ``docs`` are ignored. See
    :func:`token_pieces` for nulls, empty texts and repeated rows.
    """
    spark = docs.sparkSession
    pieces = written(
        token_pieces(
            docs, id_col=id_col, text_col=text_col, tokenizer_file=tokenizer_file, capacity=capacity
        )
    )
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {row["length"]: row["count"] for row in histogram}
    plan = spark.sparkContext.broadcast(plan_packing(counts, capacity, large_share, groups))
    # Ranks within a length: rows are numbered in buckets of about RANKED_TOGETHER,
    # so a frequent length is ranked by many tasks.
    buckets = spark.createDataFrame(
        [(length, -(-n // RANKED_TOGETHER)) for length, n in counts.items()],
        "length bigint, buckets bigint",
    )
    rows = (
        pieces.withColumn("row", F.monotonically_increasing_id())
        .join(F.broadcast(buckets), "length")
        .withColumn("bucket", F.expr("pmod(xxhash64(row), buckets)"))
        .drop("buckets")
    )
    local = Window.partitionBy("length", "bucket").orderBy("row")
    before = (
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = (
        rows.groupBy("length", "bucket")
        .count()
        .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    ranked = (
        rows.withColumn("number", F.row_number().over(local) - 1)
        .join(first, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("number"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )
    return ranked.mapInArrow(
        lambda batches: _assigned(batches, plan.value),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start bigint, "
        "length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
