"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole, so no section changes how its neighbour is cut.
Each token has a span of characters; the spans are joined with the sections' intervals,
and a token that crosses a boundary belongs to the section that holds its first
character. So the counts of sections without gaps add up to the document's.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.tokens import encoder, vocabulary

#: Number of the rows for tokens that start in no section.
OUTSIDE = -1


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines in code points, each with its line break."""
    lines = text.split("\n")
    ends = np.cumsum([len(line) + 1 for line in lines])
    ends[-1] -= 1
    starts = np.append(0, ends[:-1])
    return (starts, ends) if len(lines[-1]) or len(lines) == 1 else (starts[:-1], ends[:-1])


def owned_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the elementary intervals between all section borders, and their owners.

    An interval belongs to the section that covers it and starts last; of those to the one
    that ends first, and of those to the last given. -1 is the owner where none covers it.
    """
    if (starts[1:] >= ends[:-1]).all() and (ends >= starts).all():
        # Sorted and apart: each section, and the gap behind it.
        bounds = np.stack([starts, ends], axis=1).ravel()
        owners = np.stack([np.arange(len(starts)), np.full(len(starts), OUTSIDE)], axis=1).ravel()
        last = np.append(bounds[1:] > bounds[:-1], True)
        return bounds[last], owners[last]
    bounds = np.unique(np.concatenate([starts, ends]))
    order = np.argsort(starts, kind="stable")
    open_sections: list[tuple[int, int, int]] = []  # (-start, end, -number), innermost first
    owners, at = np.full(len(bounds), OUTSIDE), 0
    for place, bound in enumerate(bounds.tolist()):
        while at < len(order) and starts[order[at]] <= bound:
            number = int(order[at])
            heapq.heappush(open_sections, (-int(starts[number]), int(ends[number]), -number))
            at += 1
        while open_sections and open_sections[0][1] <= bound:
            heapq.heappop(open_sections)
        if open_sections:
            owners[place] = -open_sections[0][2]
    return bounds, owners


def attribute(
    first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each section, how many of them end beyond it, and tokens outside.

    ``first`` and ``last`` are the first and last character of each token. Sections may come
    in any order, nest and overlap, see :func:`owned_intervals`.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), len(first)
    bounds, owners = owned_intervals(starts, ends)
    interval = np.searchsorted(bounds, first, "right") - 1
    section = np.where(interval >= 0, owners[interval], OUTSIDE)
    inside = section >= 0
    held, reach = section[inside], last[inside]
    count = np.bincount(held, minlength=len(starts))
    crossing = np.bincount(held[reach >= ends[held]], minlength=len(starts))
    return count, crossing, int((~inside).sum())


def _counted(batches, path: str, given: bool):
    for batch in batches:
        coder = encoder(path)
        rows, sections, begin, stop, tokens, crossings = [], [], [], [], [], []
        texts = batch.column("text").to_pylist()
        lists = batch.column("sections").to_pylist() if given else [None] * len(texts)
        for row, (text, own) in enumerate(zip(texts, lists)):
            if given:
                pairs = [
                    (one["start"], one["end"], number)
                    for number, one in enumerate(own or [])
                    if one and one["start"] is not None and one["end"] is not None
                ]
                starts, ends, numbers = np.array(pairs, np.int64).reshape(-1, 3).T
            else:
                starts, ends = line_sections(text)
                numbers = range(len(starts))
            first, last = coder.characters(text)
            count, crossing, outside = attribute(first, last, starts, ends)
            rows += [row] * len(starts)
            sections += list(numbers)
            begin += starts.tolist()
            stop += ends.tolist()
            tokens += count.tolist()
            crossings += crossing.tolist()
            if outside:
                rows.append(row)
                sections.append(OUTSIDE)
                begin.append(None)
                stop.append(None)
                tokens.append(outside)
                crossings.append(0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(sections, pa.int32()),
                pa.array(begin, pa.int64()),
                pa.array(stop, pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array(crossings, pa.int64()),
            ],
            ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
        )


def section_token_counts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections_col: str | None = None,
    tokenizer_file: str | None = None,
) -> DataFrame:
    """One row per section: ``doc_id, section, start, end, n_tokens, n_crossing``.

    Sections are the lines of the text, or the intervals (``start``, ``end``; code points,
    end exclusive) of ``sections_col``, numbered from 0. ``n_crossing`` counts the tokens
    that go on beyond the section's end. Sections may nest and overlap: a token belongs to
    the section that holds its first character and starts last; of those to the one that ends
    first, and of those to the last listed. Tokens that start in no section make a row with
    section -1. Null text counts as empty: one empty line. Null sections, and those with a
    null border, count as none. Texts may have any length, ids may be null, and every row of
    ``docs`` gives its own rows, also where it repeats another. Other columns are ignored.
    """
    path = tokenizer_file or vocabulary()
    columns = [docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")]
    if sections_col is not None:
        columns.append(docs[sections_col].alias("sections"))
    return docs.select(*columns).mapInArrow(
        lambda batches: _counted(batches, path, sections_col is not None),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, section int, start bigint, "
        "end bigint, n_tokens bigint, n_crossing bigint",
    )
