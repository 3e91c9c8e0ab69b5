"""Token counts (7): a broadcast table of pre-token lengths, then the cache of each worker.

No pre-token leaves its task. The first tier holds the lengths of the vocabulary's own entries,
which are the pre-tokens a byte-level vocabulary was merged from because they are frequent; its
size is bounded by the vocabulary. Others are encoded once per worker and kept there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from grantchron.llm.byte_bpe import byte_characters
from grantchron.llm.pretokens import PieceCache, slices, split


@cache
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@cache
def _special(path: str) -> re.Pattern | None:
    """Strings that the library takes as one token wherever they stand in a text."""
    with open(path) as file:
        settings = json.load(file)
    split_by = settings["pre_tokenizer"] or {}
    if settings["normalizer"] or split_by.get("type") != "ByteLevel" or split_by["add_prefix_space"]:
        raise ValueError(f"{path} is no plain byte-level vocabulary")
    added = settings["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take in what stands beside them")
    words = sorted((t["content"] for t in added), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, words))) if words else None


def _lengths(path: str, pieces: list[str]) -> list[int]:
    encoded = _tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def frequent_lengths(path: str) -> dict[str, int]:
    """Pre-token to number of tokens, for each vocabulary entry that is one whole pre-token."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    special = _special(path)
    words = []
    for entry in _tokenizer(path).get_vocab():
        if special and special.search(entry):
            continue
        try:
            word = bytes(byte_of[c] for c in entry).decode()
        except UnicodeDecodeError:
            continue  # a part of a character is no pre-token
        if split(word) == [word]:
            words.append(word)
    return dict(zip(words, _lengths(path, words), strict=True))


_CACHES: dict[str, PieceCache] = {}


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id_col, n_bytes, n_tokens, over_limit) as the library counts whole texts.

    A null text counts as empty: no bytes, no tokens, not over the limit. Every row is counted,
    also those with null or repeated ids; other columns of docs are left out.
    """
    first = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path))
    schema = StructType(
        [
            docs.schema[id_col],
            StructField("n_bytes", LongType(), False),
            StructField("n_tokens", LongType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _CACHES:
            _CACHES[path] = PieceCache(lambda pieces: _lengths(path, pieces), first.value)
        pieces, special = _CACHES[path], _special(path)
        for part, texts in slices(batches, 2):
            cut, counts = [], []
            for text in texts:
                parts = special.split(text) if special else [text]
                words = split(parts[0])
                for other in parts[1:]:
                    words += split(other)
                cut.append(words)
                counts.append(len(parts) - 1)
            lookup = pieces.take_in(cut)
            counts = [n + sum(map(lookup, c)) for n, c in zip(counts, cut, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts, pa.int64())],
                names=schema.names,
            )

    text = F.coalesce(text_col, F.lit(""))
    sized = docs.select(id_col, F.octet_length(text).cast("long").alias("n_bytes"), text)
    return sized.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
