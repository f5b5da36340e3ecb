"""What Python workers hold besides their texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from lakemarts.llm import language_id
from lakemarts.llm.tokens import Encoder, vocabulary


def test_texts_are_scored_in_slices():
    """The languages of a batch take memory by the slice, not by the batch."""
    text = "the quick brown fox jumps over the lazy dog " * 50
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": [text] * 2000})
    model = np.random.default_rng(1).random((5, 1 << language_id.GRAM_BITS)).astype(np.float32)
    tracemalloc.start()
    (scored,) = language_id._scored([batch], model)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scored.num_rows == 2000
    assert most < 40_000_000


def test_the_library_is_loaded_when_a_text_needs_it():
    coder = Encoder(vocabulary())
    assert len(coder.ids("ordinary text")) and "_tokenizer" not in vars(coder)
    assert len(coder.ids(" " * 60_000 + "x")) and "_tokenizer" in vars(coder)
