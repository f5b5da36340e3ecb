"""Byte-level BPE ids of whole texts.

The vocabulary file is that of the ``tokenizers`` library. Where its ids follow the
order of its merges, as in byte-level vocabularies, ordinary text is encoded by
``tiktoken`` from the same file, which gives the same ids several times faster.
Texts that hold an added token or a very long run without a break, and other vocabularies,
go to ``tokenizers``. There is no limit to the length of a text.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

# Fixed value: the units of the byte-level pre-tokenizer.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Longest run of white space or of other characters that ``tiktoken`` gets: its
#: pattern keeps a place to return to for each space of a run, and has a limit for them.
LONGEST_RUN = 50_000
_RUN = re.compile(r"\s+|\S+")


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {
        chr(256 + index): byte for index, byte in enumerate(others)
    }


class Encoder:
    """One vocabulary, ready in a Python worker."""

    def __init__(self, path: str):
        self._path = path
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        self._added = [token["content"] for token in kind.get("added_tokens", [])]
        self._plain = self._by_ranks(kind)

    @cached_property
    def _tokenizer(self):
        """The library's own encoder; most workers never need it, and it takes memory."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    def _by_ranks(self, kind: dict):
        """Encoder of ordinary text where ids follow the order of merges, else None."""
        before, model = kind.get("pre_tokenizer") or {}, kind["model"]
        plain = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and kind.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("ignore_merges")
        )
        if not plain:
            return None
        import tiktoken

        symbols, vocab = _byte_of_symbol(), model["vocab"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        merged = [vocab["".join(pair)] for pair in pairs]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        added = set(self._added)
        ranks = {
            bytes(symbols[symbol] for symbol in token): rank
            for token, rank in vocab.items()
            if token not in added
        }
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        coding = tiktoken.Encoding(
            "byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        return lambda text: coding.encode_to_numpy(text, disallowed_special=())

    def _needs_library(self, text: str) -> bool:
        if self._plain is None or any(token in text for token in self._added):
            return True
        return len(text) > LONGEST_RUN and any(
            run.end() - run.start() > LONGEST_RUN for run in _RUN.finditer(text)
        )

    def ids(self, text: str) -> np.ndarray:
        """Ids of the text as little-endian unsigned 32-bit numbers."""
        if self._needs_library(text):
            coded = self._tokenizer.encode(text, add_special_tokens=False)
            return np.array(coded.ids, "<u4")
        return self._plain(text).astype("<u4", copy=False)

    def characters(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last character of each token, in code points."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self._needs_library(text):
            spans = self._tokenizer.encode(text, add_special_tokens=False).offsets
            first, end = np.array(spans, np.int64).reshape(-1, 2).T
            return first, np.maximum(end - 1, first)
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self._bytes[self._plain(text)])
        return character[np.append(0, ends[:-1])], character[ends - 1]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(path)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
