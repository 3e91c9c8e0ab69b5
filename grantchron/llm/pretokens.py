"""Splitting a text into the pre-tokens of the byte-level vocabularies, and workers' caches of them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from tokenizers import Regex, pre_tokenizers

from grantchron.llm.hashing import give_back_memory

# The pattern of public_tokenizers for texts of the characters COMMON leaves alone: there
# Python's classes, with these six numbers moved, are those of the tokenizer libraries.
_NUMBERS = "²³¹¼½¾"
_LETTER, _NUMBER = rf"[^\W\d_{_NUMBERS}]", rf"[\d{_NUMBERS}]"
_SPACE = "\\t-\\r \x85\xa0"
_FAST = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?(?:{_LETTER}+|{_NUMBER}+|(?:[^{_SPACE}\w]|_)+)"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Characters outside Latin, Greek, Cyrillic and common punctuation, and the four separators
# that Python alone counts as space.
_UNCOMMON = re.compile("[^\x00-\x1b\x20-ԯ‐-‧‰-⁞]")

#: What a worker keeps of pre-tokens it has met; beyond either it starts anew.
CACHE_PIECES, CACHE_CHARS = 150_000, 3_000_000
#: Characters of text that a worker handles at once.
SLICE_CHARS = 700_000


@cache
def _exact():
    return pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")


def split(text: str) -> list[str]:
    """The matches of public_tokenizers.PATTERN in order; together they are the whole text."""
    if _UNCOMMON.search(text) is None:
        return _FAST.findall(text)
    return [piece for piece, _ in _exact().pre_tokenize_str(text)]


class PieceCache:
    """What `encode` gives for each pre-token met: a fixed first tier, then misses in batches."""

    def __init__(self, encode: Callable[[list[str]], Iterable], first: dict | None = None):
        self.encode, self.first = encode, first or {}
        self._reset()

    def _reset(self) -> None:
        self.known, self.chars = dict(self.first), 0

    def take_in(self, documents: list[list[str]]) -> Callable:
        """Make the pieces of the documents known; the lookup function holds until the next call."""
        if self.chars > CACHE_CHARS or len(self.known) > CACHE_PIECES + len(self.first):
            self._reset()
        new = list(set().union(*documents).difference(self.known))
        if new:
            self.known.update(zip(new, self.encode(new), strict=True))
            self.chars += sum(map(len, new))
        return self.known.__getitem__


def slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with about SLICE_CHARS of text each, a null text as an empty one."""
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(text_at).to_pylist()]
        start = chars = 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= SLICE_CHARS or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, chars = i + 1, 0
    give_back_memory()
